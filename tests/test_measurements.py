"""The product, its tiling, numbering, and ids against brute force."""
import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window, functions as F

from dieflow.operators import dedup, dims, measurements as m, numbering, product

DEV = "path string, device_index long, wld_device_dmc string, bin_code string, bin_desc string, test_flag int, default_x int, default_y int"
TEST = "path string, record_index long, record_type string, test_num long, test_flg int, wtp_param_name string, values array<double>, pixel_x int, pixel_y int, units string"


def made(spark, seed, n_devices=40, n_tests=60, hot=0.6, loose=0.0):
    """Devices and tests where one file holds most rows, with repeats on purpose."""
    rng = random.Random(seed)
    path = lambda: "hot" if rng.random() < hot else rng.choice("abc")
    devices = [(path(), i, f"d{rng.randrange(6)}", "1", "PASS", rng.randrange(2), rng.randrange(3), rng.randrange(2)) for i in range(n_devices)]
    tests = []
    for i in range(n_tests):
        pixel = (None, None) if rng.random() < loose else (rng.randrange(3), rng.randrange(2))
        tests.append((path(), 1000 + i, "PTR", i, 0, f"p{rng.randrange(4)}", [float(v) for v in range(rng.randrange(1, 4))], *pixel, "V"))
    return devices, tests, spark.createDataFrame(devices, DEV), spark.createDataFrame(tests, TEST)


def brute(devices, tests, raw=False):
    seen, out = defaultdict(int), {}
    for d in sorted(devices, key=lambda d: d[1]):
        for t in sorted(tests, key=lambda t: t[1]):
            if d[0] != t[0]:
                continue
            x = t[7] if t[7] is not None else d[6]
            y = t[8] if t[8] is not None else d[7]
            for pos, value in enumerate(t[6]):
                key = (d[0], d[2], t[5], x, y, t[4] if raw else d[5])
                out[(d[1], t[1], pos)] = (x, y, value, seen[key])
                seen[key] += 1
    return out


def got(df):
    rows = df.select("device_index", "record_index", "value_pos", "wp_pos_x", "wp_pos_y", "wptm_value", "segment").collect()
    assert len({tuple(r)[:3] for r in rows}) == len(rows)
    return {tuple(r)[:3]: tuple(r)[3:] for r in rows}


@pytest.mark.parametrize("cell_rows", [1, 7, 100, 10**6])
def test_product_for_every_tiling(spark, cell_rows):
    devices, tests, dd, tt = made(spark, cell_rows)
    want = Counter((d[1], t[1], p) for d, t in itertools.product(devices, tests) if d[0] == t[0] for p in range(len(t[6])))
    rows = m.device_test_product(dd, tt, cell_rows).select("device_index", "record_index", "value_pos").collect()
    assert Counter(map(tuple, rows)) == want


def test_hot_key_is_cut_into_cells(spark):
    _, _, dd, tt = made(spark, 1, 200, 200, hot=1.0)
    grid = m.product_grid(dd, tt, "path", 1000, F.size("values")).collect()[0]
    assert grid._nl > 3 and grid._nr > 3


@pytest.mark.parametrize("loose", [0.0, 0.3, 1.0])
def test_numbered_product_equals_brute_force(spark, loose, monkeypatch):
    monkeypatch.setattr(numbering, "CHUNK", 5)
    monkeypatch.setattr(product, "CHUNK", 5)
    devices, tests, dd, tt = made(spark, 11, loose=loose)
    want = brute(devices, tests)
    assert got(m.numbered_product(dd, tt, cell_rows=50)) == want
    assert got(m.segment(m.device_test_product(dd, tt, 50))) == want


@pytest.mark.parametrize("shape", ["apart", "still", "half"])
def test_loose_tests_in_every_shape(spark, shape):
    """Devices away from all pixels; devices that keep their place; tests that miss one axis only."""
    devices, tests, _, _ = made(spark, 21, loose=0.4)
    if shape == "apart":
        devices = [(*d[:6], d[6] + 50, d[7]) for d in devices]
    elif shape == "still":
        devices = [(*d[:6], int(d[2][1:]) % 3, int(d[2][1:]) % 2) for d in devices]
    else:
        tests = [(*t[:7], t[7] if i % 3 else None, t[8], t[9]) for i, t in enumerate(tests)]
    dd, tt = spark.createDataFrame(devices, DEV), spark.createDataFrame(tests, TEST)
    assert got(m.numbered_product(dd, tt, cell_rows=50)) == brute(devices, tests)


@pytest.mark.parametrize("loose", [0.0, 0.4])
def test_duplicates_by_the_raw_flag(spark, loose):
    devices, tests, dd, _ = made(spark, 31, loose=loose)
    tests = [(*t[:4], i % 3, *t[5:]) for i, t in enumerate(tests)]
    assert got(m.numbered_product(dd, spark.createDataFrame(tests, TEST), cell_rows=50, flag="test_flg")) == brute(devices, tests, raw=True)


def test_tasks_follow_the_output(spark, monkeypatch):
    """One huge and many small files: equal shares, more tasks for more output."""
    monkeypatch.setattr(product, "LEAST_ROWS", 100)
    devices = [("huge", i, "d", "1", "PASS", 1, 0, 0) for i in range(300)] + [(f"s{k}", 1000 + k, "d", "1", "PASS", 1, 0, 0) for k in range(200)]
    tests = [("huge", i, "PTR", i, 0, "p", [1.0], 0, 0, "V") for i in range(200)]
    tests += [(f"s{k}", i, "PTR", i, 0, "p", [1.0], 0, 0, "V") for k in range(200) for i in range(20)]
    dd, tt = spark.createDataFrame(devices, DEV), spark.createDataFrame(tests, TEST)

    def shares():
        rows = m.device_test_product(dd, tt).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
        return [r["count"] for r in rows]

    found = shares()
    assert sum(found) == 64_000 and len(found) == 8 and max(found) < 1.4 * 8000
    monkeypatch.setattr(product, "TASK_ROWS", 2000)
    found = shares()
    assert sum(found) == 64_000 and 30 <= len(found) <= 32 and max(found) < 2 * 2000


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_number_within_chunks(spark, chunk, monkeypatch):
    monkeypatch.setattr(numbering, "CHUNK", chunk)
    rows = [("a" if i % 3 else "b", i * 2, i % 5) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, o long, w int").repartition(7)
    out = {r.o: (r.n, r.t) for r in numbering.number_within(df, ["k"], ["o"], "n", weight=F.col("w"), total="t").collect()}
    for k, o, _ in rows:
        mine = [x for x in rows if x[0] == k]
        assert out[o] == (sum(x[2] for x in mine if x[1] < o), sum(x[2] for x in mine))


def test_number_all_is_dense_and_ordered(spark):
    df = spark.createDataFrame([(i * 37 % 1000,) for i in range(1000)], "v long").repartition(16)
    rows = numbering.number_all(df, ["v"], "n", start=5).orderBy("v").collect()
    assert [r.n for r in rows] == list(range(5, 1005))


@pytest.mark.parametrize("partitions", [1, 9])
def test_ids_continue_and_stay(spark, partitions):
    df = spark.createDataFrame([("f1", 3, "c"), ("f1", 1, "a"), ("f0", 9, "b"), ("f2", 1, "a")], "path string, record_index long, name string").repartition(partitions)
    empty = spark.createDataFrame([], "id long, name string")
    first = dims.assign_ids(df, empty, "name", "id")
    assert {r.name: r.id for r in first.collect()} == {"b": 0, "a": 1, "c": 2}
    assert {r.name: r.id for r in dims.assign_ids(df, empty, "name", "id", start=1).collect()} == {"b": 1, "a": 2, "c": 3}
    known = spark.createDataFrame([(7, "a")], "id long, name string")
    assert {r.name: r.id for r in dims.assign_ids(df, known, "name", "id").collect()} == {"b": 8, "c": 9}
    assert dims.assign_ids(df, first, "name", "id").count() == 0


def test_equal_files_in_a_batch_load_once(spark):
    files = spark.createDataFrame([("b", b"1"), ("a", b"1"), ("c", b"2"), ("d", b"3")], "path string, content binary")
    loaded = files.filter("path = 'd'").select(F.md5("content").alias("file_hash"))
    manifest = files.select("path", F.md5("content").alias("file_hash"))
    assert sorted(r.path for r in dedup.skip_loaded_files(files, loaded, manifest).collect()) == ["a", "c"]


def test_mir_fallbacks(spark):
    rows = [("f", 5, "", "FL", "OP", "SP", "L2"), ("f", 2, None, "FL", "", "SP", "L1")]
    mir = spark.createDataFrame(rows, "path string, record_index long, FACIL_ID string, FLOOR_ID string, OPER_NAM string, SPEC_NAM string, LOT_ID string")
    for c in ("PART_TYP", "NODE_NAM", "JOB_NAM", "JOB_REV", "SBLOT_ID"):
        mir = mir.withColumn(c, F.lit(c))
    row = m.mir_context(mir.withColumn("START_T", F.lit(9))).collect()[0]
    assert (row.facility, row.operation, row.lot_name, row.equipment, row.start_time) == ("FL", "SP", "L1", "NODE_NAM", "9")


def with_half(tests):
    """Some tests lack one axis of their pixel."""
    return [(*t[:4], t[1] % 2, *t[5:7], None if i % 7 == 0 else t[7], None if i % 5 == 0 else t[8], t[9]) for i, t in enumerate(tests)]


@pytest.mark.parametrize("loose", [0.0, 0.4])
@pytest.mark.parametrize("columns", [
    ["record_type"], ["wld_device_dmc"], ["wtp_param_name", "test_flg"], ["path", "test_flag"], ["device_index", "wp_pos_x"],
    ["wld_device_dmc", "wtp_param_name", "wp_pos_x", "wp_pos_y", "test_flg"],
])
def test_counted_product_stands_for_all_rows(spark, loose, columns):
    devices, tests, dd, _ = made(spark, 3, loose=loose)
    tt = spark.createDataFrame(with_half(tests) if loose else tests, TEST)
    want = m.device_test_product(dd, tt).groupBy(*columns).count()
    counted = m.counted_product(dd, tt, columns)
    got_ = counted.groupBy(*columns).agg(F.sum("n_rows").alias("count"))
    assert Counter(map(tuple, got_.collect())) == Counter(map(tuple, want.collect()))


def test_counted_product_has_distinct_rows_only(spark):
    _, _, dd, tt = made(spark, 4, 200, 300, hot=1.0)
    assert m.counted_product(dd, tt, ["test_flag"]).count() == 2  # 200 x 300 tests make 60,000 rows and more
    assert m.counted_product(dd, tt, ["wld_device_dmc"]).count() == 6
    with pytest.raises(ValueError, match="single values"):
        m.counted_product(dd, tt, ["wptm_value"])


@pytest.mark.parametrize("loose", [0.0, 0.4])
def test_duplicates_from_one_name_of_each_kind(spark, loose):
    devices, tests, dd, _ = made(spark, 5, 60, 80, loose=loose)
    # Ten more names that are like "d0".
    twins = [(d[0], 1000 + 100 * i + d[1], f"e{i}", *d[3:]) for i in range(10) for d in devices if d[2] == "d0"]
    dd = spark.createDataFrame(devices + twins, DEV)
    tt = spark.createDataFrame(with_half(tests) if loose else tests, TEST)
    key = ["wld_device_dmc", "wtp_param_name", "wp_pos_x", "wp_pos_y", "test_flg"]
    rows = m.device_test_product(dd, tt)
    few, one = m.alike_names(dd, tt, key, 12), m.alike_names(dd, tt, key)
    assert one[0].select("wld_device_dmc").distinct().count() <= 6
    top = dedup.top_duplicates(m.counted_product(*few, key), key, 12, "n_rows")
    assert top.collect() == dedup.top_duplicates(rows, key, 12).select(*top.columns).collect()
    counted = m.counted_product(*one, [*key, "_devices_alike", "_tests_alike"]).withColumn("n_keys", F.col("_devices_alike") * F.col("_tests_alike"))
    assert dedup.duplicate_summary(counted, key, 2, "n_rows", "n_keys").collect() == dedup.duplicate_summary(rows, key, 2).collect()


def test_row_numbers_of_long_keys_equal_the_window(spark):
    rng = random.Random(6)
    pick = lambda values: rng.choice([None, *values])
    data = [(pick("ab"), pick(range(40)), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, a int, b int").repartition(7)
    got_ = numbering.number_in_order(df, ["k"], ["a", "b"], "n")
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("a", "b")).cast("bigint"))
    assert Counter(map(tuple, got_.collect())) == Counter(map(tuple, want.collect()))


def test_wafer_parts_equal_their_view(spark):
    from catalog import views

    want = views.view(spark, "/root/testdata/sf0.001", "wafer_parts")
    got_ = views.numbered_wafer_parts(spark, "/root/testdata/sf0.001")
    assert got_.schema.simpleString() == want.schema.simpleString()
    assert got_.exceptAll(want).count() == 0 and want.exceptAll(got_).count() == 0
