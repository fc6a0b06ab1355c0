"""Every device with every test of its file, spread by output size and numbered before the rows multiply."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dieflow.operators.numbering import CHUNK, number_within
from dieflow.session import materialize

# Output rows of a cell at most, rows a task should make, and rows below which a task is not worth starting.
CELL_ROWS = 250_000
TASK_ROWS, LEAST_ROWS = 1 << 20, 20_000
# Cells per task that even out what cells differ in.
CELLS = 4
MOST_TASKS = 100_000
BUCKETS = 1024


def product_tasks(df: DataFrame, rows: float) -> int:
    """Tasks for a product of so many rows: as many as the session shuffles to, fewer for few rows, more for many."""
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return int(min(max(rows / TASK_ROWS, min(usual, rows / LEAST_ROWS), 1), MOST_TASKS))


def product_grid(left: DataFrame, right: DataFrame, on: str, cell_rows: int = CELL_ROWS, right_weight: Column | None = None) -> DataFrame:
    """One row per key: into how many stripes its left and right rows are cut, and its output rows.

    The rectangle (left rows x right rows) of a key is tiled into cells of at most about
    ``cell_rows`` output rows, and of a fraction of a task's share: squares where both sides are
    long, whole rows where one is short.
    """
    weight = F.lit(1.0) if right_weight is None else right_weight.cast("double")
    sizes = materialize(
        left.groupBy(on).agg(F.count("*").cast("double").alias("_l"))
        .join(right.groupBy(on).agg(F.sum(weight).alias("_r"), F.count("*").cast("double").alias("_rn")), on)
    )
    total = sizes.agg(F.sum(F.col("_l") * F.col("_r"))).first()[0] or 0.0
    cell = max(1.0, min(float(cell_rows), total / (CELLS * product_tasks(left, total))))
    area, side = F.lit(cell), F.lit(cell ** 0.5)
    stripes_l = F.least(F.ceil(F.col("_l") / F.greatest(side, area / F.col("_r"))), F.col("_l"))
    stripes_r = F.least(F.ceil(F.col("_r") / F.greatest(side, area / F.col("_l"))), F.col("_rn"))
    return sizes.select(on, stripes_l.cast("int").alias("_nl"), stripes_r.cast("int").alias("_nr"), (F.col("_l") * F.col("_r")).alias("_rows"))


def _with_starts(grid: DataFrame, on: str) -> DataFrame:
    """Add ``_start``: the output rows of all keys before this one, in an order of hashed buckets."""
    bucketed = grid.withColumn("_bucket", F.pmod(F.xxhash64(on), F.lit(BUCKETS)))
    before = Window.partitionBy("_bucket").orderBy(on).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # At most BUCKETS rows.
    offsets = bucketed.groupBy("_bucket").agg(F.sum("_rows").alias("_size")).select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0.0)).alias("_offset"))
    local = bucketed.withColumn("_local", F.coalesce(F.sum("_rows").over(before), F.lit(0.0)))
    return local.join(F.broadcast(offsets), "_bucket").withColumn("_start", F.col("_local") + F.col("_offset")).drop("_bucket", "_local", "_offset")


def grid_join(left: DataFrame, right: DataFrame, on: str, grid: DataFrame) -> DataFrame:
    """All left rows of a key with all right rows of it, in tasks of equal output.

    A row is copied once per cell of its stripe, so one key holding most rows of both sides is cut
    into as many tasks as its output needs, while input copies grow only with the square root of
    the output. The cells of all keys, one after the other, are cut into equal shares of
    output rows; a share is a task, so many small keys go together and a large one is spread.
    """
    grid = materialize(_with_starts(grid, on))
    total = grid.agg(F.sum("_rows")).first()[0] or 0.0
    n = product_tasks(left, total)
    place = F.col("_start") + (F.col("_cl") * F.col("_nr") + F.col("_cr") + 0.5) * F.col("_rows") / (F.col("_nl") * F.col("_nr"))
    task = F.least(F.floor(place * n / F.lit(max(total, 1.0))), F.lit(n - 1)).cast("int")

    def stripe(df: DataFrame, own: str, other: str, own_name: str, other_name: str) -> DataFrame:
        cells = (
            df.join(grid, on)
            .withColumn(own_name, F.pmod(F.xxhash64(*[F.col(c) for c in _order_columns(df)]), F.col(own)).cast("int"))
            .withColumn(other_name, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        )
        return cells.withColumn("_task", task).drop("_nl", "_nr", "_rows", "_start").repartitionById(n, "_task")

    cells_l, cells_r = stripe(left, "_nl", "_nr", "_cl", "_cr"), stripe(right, "_nr", "_nl", "_cr", "_cl")
    return cells_l.hint("shuffle_merge").join(cells_r, ["_task", on, "_cl", "_cr"]).drop("_task", "_cl", "_cr")


def _order_columns(df: DataFrame) -> list[str]:
    return [c for c in ("device_index", "record_index") if c in df.columns] or df.columns


PRODUCT_COLUMNS = [
    "path", "device_index", "record_index", "value_pos", "wld_device_dmc", "wtp_param_name", "wp_pos_x", "wp_pos_y", "wptm_value",
    "test_flag", "units", "test_num", "test_flg", "record_type", "bin_code", "bin_desc",
]


def device_test_product(
    devices: DataFrame, tests: DataFrame, cell_rows: int = CELL_ROWS, keep: tuple[str, ...] = (), on: str = "path",
) -> DataFrame:
    """Every device with every prepared test of its file, one row per value.

    Carries (device_index, record_index, value_pos), the arrival order. ``keep`` names further
    columns of either side to carry along; ``on`` another key than the file, which both sides hold.
    """
    grid = product_grid(devices, tests, on, cell_rows, F.size("values"))
    joined = grid_join(devices, tests.drop("path") if on != "path" else tests, on, grid)
    rows = joined.select("*", F.posexplode("values").alias("value_pos", "wptm_value"))
    extra = [c for c in keep if c in rows.columns and c not in PRODUCT_COLUMNS]
    return rows.select(
        "path", "device_index", "record_index", "value_pos", "wld_device_dmc", "wtp_param_name",
        F.coalesce("pixel_x", "default_x").alias("wp_pos_x"),
        F.coalesce("pixel_y", "default_y").alias("wp_pos_y"),
        "wptm_value", "test_flag", "units", "test_num", "test_flg", "record_type", "bin_code", "bin_desc", *extra,
    )


def _n_values() -> Column:
    return F.coalesce(F.greatest(F.size("values"), F.lit(0)), F.lit(0))


def _read_places(devices: DataFrame, tests: DataFrame) -> DataFrame:
    """Devices of files with tests, their place emptied where every test of the file has its own."""
    reads = tests.groupBy("path").agg(F.max(F.col("pixel_x").isNull()).alias("_x"), F.max(F.col("pixel_y").isNull()).alias("_y"))
    own = {"default_x": F.when(F.col("_x"), F.col("default_x")), "default_y": F.when(F.col("_y"), F.col("default_y"))}
    return devices.join(reads, "path").withColumns(own).drop("_x", "_y")


def alike_names(devices: DataFrame, tests: DataFrame, key: list[str], n: int = 1) -> tuple[DataFrame, DataFrame]:
    """The devices and tests of the ``n`` first names of each kind, with the number of names of the kind.

    The columns of ``key`` that a side holds are its rows' name. Names are of one kind if they have equally many
    devices (values) at the same places (pixels) of the same files: any two meet the names of the other side
    equally often, so repeats of a key are the same for all names of both kinds, and keys with the ``n`` first
    names of their kinds hold the n first of equally repeated keys. Kinds are told apart by 128-bit digests.
    Adds ``_devices_alike`` and ``_tests_alike``.
    """
    devices = _read_places(devices, tests)

    def first_names(df: DataFrame, traits: list[str], weight: Column, number: str) -> DataFrame:
        names = [c for c in key if c in df.columns]
        if not names:
            return df.withColumn(number, F.lit(1).cast("bigint"))
        traits = [c for c in traits if c not in names]
        entries = df.groupBy(*names, *traits).agg(F.sum(weight).alias("_weight")).filter("_weight > 0")
        # A hash passes over NULL, so where they stand is hashed too.
        facts = [f for c in traits for f in (F.col(c).isNull(), F.col(c))]
        kind = [f"_kind{salt}" for salt in range(2)]
        digests = [F.bit_xor(F.xxhash64(F.lit(salt), *facts, "_weight")).alias(k) for salt, k in enumerate(kind)]
        kinds = materialize(entries.groupBy(*names).agg(*digests))
        place = F.row_number().over(Window.partitionBy(*kind).orderBy(*names))
        first = kinds.withColumn("_place", place).filter(F.col("_place") <= n)
        kept = first.join(kinds.groupBy(*kind).agg(F.count("*").alias(number)), kind)
        kept = kept.select(*[F.col(c).alias(f"_of_{c}") for c in names], number)
        same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in names]
        return df.join(kept, same).drop(*[f"_of_{c}" for c in names])

    return (
        first_names(devices, ["path", "default_x", "default_y"], F.lit(1), "_devices_alike"),
        first_names(tests, ["path", "pixel_x", "pixel_y"], _n_values(), "_tests_alike"),
    )


def counted_product(devices: DataFrame, tests: DataFrame, columns: list[str], cell_rows: int = CELL_ROWS) -> DataFrame:
    """The product's rows reduced to ``columns``, with ``n_rows``, how many of them a row stands for.

    Devices, and tests, of a file that are equal in what ``columns`` read make equal rows, so one of each with
    their number goes into the product. Counts over the product then cost what distinct rows cost. A combination
    may come in several rows (one per file, and per device place), so counts are sums of ``n_rows``.
    ``columns`` are any of the product's or further ones of either side, except those of single values.
    """
    if single := {"value_pos", "wptm_value"} & set(columns):
        raise ValueError(f"single values cannot be counted together: {', '.join(sorted(single))}")
    places = [(c, a, b) for c, a, b in (("wp_pos_x", "pixel_x", "default_x"), ("wp_pos_y", "pixel_y", "default_y")) if c in columns]
    of_device = list(dict.fromkeys(["path", *(c for c in columns if c in devices.columns), *(b for _, _, b in places)]))
    of_test = list(dict.fromkeys(["path", *(c for c in columns if c in tests.columns), *(a for _, a, _ in places)]))
    missing = set(columns) - set(of_device) - set(of_test) - {c for c, _, _ in places}
    if missing:
        raise ValueError(f"no such columns: {', '.join(sorted(missing))}")

    def reduced(df: DataFrame, kept: list[str], index: str, name: str, weight: Column) -> DataFrame:
        first = [] if index in kept else [F.min(index).alias(index)]
        rows = df.groupBy(*kept).agg(*first, F.sum(weight).cast("bigint").alias(name))
        # The product names its columns; those that are not read are empty.
        empty = [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns if c not in rows.columns and c != "values"]
        return rows.filter(F.col(name) > 0).select("*", *empty)

    if places:
        devices = _read_places(devices, tests)
    left = materialize(reduced(devices, of_device, "device_index", "_alike_devices", F.lit(1)))
    right = materialize(reduced(tests, of_test, "record_index", "_alike_values", _n_values()).withColumn("values", F.array(F.lit(0.0))))
    rows = device_test_product(left, right, cell_rows, ("_alike_devices", "_alike_values", *columns))
    return rows.select(*columns, (F.col("_alike_devices") * F.col("_alike_values")).alias("n_rows"))


# --- segments without shuffling the product --------------------------------------------

SEGMENT_KEY = ["path", "wld_device_dmc", "wtp_param_name", "wp_pos_x", "wp_pos_y", "test_flag"]
RAW_SEGMENT_KEY = [*SEGMENT_KEY[:-1], "test_flg"]


def segment(measurements: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Number duplicates of a measurement key from 0 in arrival order."""
    chunks = [F.col("device_index"), F.floor(F.col("record_index") / CHUNK)]
    return number_within(measurements, key or SEGMENT_KEY, ["device_index", "record_index", "value_pos"], "segment", chunks=chunks)


def numbered_product(
    devices: DataFrame, tests: DataFrame, cell_rows: int = CELL_ROWS, keep: tuple[str, ...] = (), flag: str = "test_flag",
) -> DataFrame:
    """The product with its ``segment``, numbered before the rows multiply.

    Duplicates share path, device name, parameter, position and ``flag``: the device's ``test_flag`` or the
    test's raw ``test_flg``.

    A test with its own pixel is *placed*, one without is *loose* and lands where the device is.
    Values that a device has at a place before a test are those of the placed tests there and,
    if it is the device's own place, those of the loose ones; both are prefix sums over the
    tests of a parameter in their order. Earlier devices of the same name and flag each add all
    placed values of the place, and the loose ones if they are there themselves. So ranks of
    devices and prefix sums of tests give the number, and only the two small inputs are sorted.

    Where a loose test lands on a place of placed tests of its parameter, the two lists are merged
    for that place. Parameters with tests that miss just one axis are numbered on the product.
    """
    if flag not in ("test_flag", "test_flg"):
        raise ValueError(f"unknown flag {flag!r}")
    group, param = ["path", "wld_device_dmc"], ["path", "wtp_param_name"]
    (group if flag == "test_flag" else param).append(flag)
    devices, tests = materialize(devices), materialize(tests)
    no_x, no_y = F.col("pixel_x").isNull(), F.col("pixel_y").isNull()
    n_half, n_loose = tests.agg(F.count_if(no_x != no_y), F.count_if(no_x & no_y)).first()
    out = []
    if n_half:
        half = tests.filter(no_x != no_y).select(*param).distinct()
        key = SEGMENT_KEY if flag == "test_flag" else RAW_SEGMENT_KEY
        out.append(segment(device_test_product(devices, tests.join(half, param, "left_semi"), cell_rows, keep), key))
        tests = materialize(tests.join(half, param, "left_anti"))
    devices = number_within(devices, group, ["device_index"], "_rank")
    size = F.size("values")
    placed = number_within(tests.filter(~no_x), [*param, "pixel_x", "pixel_y"], ["record_index"], "_before", weight=size, total="_total")
    if n_loose:
        out += _with_loose(devices, tests, placed, cell_rows, keep, group, param)
    else:
        out.append(_numbered(devices, placed, F.col("_rank") * F.col("_total") + F.col("_before"), cell_rows, keep))
    rows = out[0]
    for other in out[1:]:
        rows = rows.unionByName(other)
    return rows


def _numbered(devices: DataFrame, tests: DataFrame, before: Column, cell_rows: int, keep: tuple[str, ...], on: str = "path", only: Column | None = None) -> DataFrame:
    extra = ["_rank", "_rank_here", "_before", "_total", "_loose_before", "_loose_total", "_own", "_meets"]
    rows = device_test_product(devices, tests, cell_rows, (*keep, *extra, "default_x", "default_y"), on)
    rows = rows if only is None else rows.filter(only)
    rows = rows.withColumn("segment", (before + F.col("value_pos")).cast("bigint"))
    return rows.drop(*[c for c in (*extra, "default_x", "default_y") if c not in keep])


def _with_loose(
    devices: DataFrame, tests: DataFrame, placed: DataFrame, cell_rows: int, keep: tuple[str, ...], group: list[str], param: list[str],
) -> list[DataFrame]:
    """The product's parts where some tests are loose."""
    size, is_loose = F.size("values"), F.col("pixel_x").isNull()
    here = {"default_x": "pixel_x", "default_y": "pixel_y"}
    ranked = materialize(number_within(devices, [*group, *here], ["device_index"], "_rank_here"))
    # Loose values of the parameter before each test, placed or loose.
    weight = F.when(is_loose, size).otherwise(0)
    merged = number_within(tests, param, ["record_index"], "_loose_before", weight=weight, total="_loose_total")
    placed = materialize(placed.join(merged.select("path", "record_index", "_loose_before", "_loose_total"), ["path", "record_index"]))
    loose = materialize(merged.filter(is_loose))
    # Places of placed tests at which loose ones of their parameter land.
    places = placed.filter("_loose_total > 0").select(*param, "pixel_x", "pixel_y").distinct()
    at = ranked.select("path", *[F.col(a).alias(b) for a, b in here.items()]).distinct()
    shared = materialize(places.join(at, ["path", "pixel_x", "pixel_y"]))
    alone = F.col("_rank_here") * F.col("_loose_total") + F.col("_loose_before")
    by_place = F.col("_rank") * F.col("_total") + F.col("_before")
    if shared.isEmpty():
        return [_numbered(ranked, placed, by_place, cell_rows, keep), _numbered(ranked, loose, alone, cell_rows, keep)]

    # Loose tests elsewhere: a device names the parameters that meet placed tests where it is.
    meeting = shared.groupBy("path", *[F.col(b).alias(a) for a, b in here.items()]).agg(F.collect_set(F.struct(*param[1:])).alias("_meets"))
    marked = materialize(ranked.join(meeting, ["path", *here], "left"))
    apart = F.col("_meets").isNull() | ~F.array_contains("_meets", F.struct(*param[1:]))
    out = [_numbered(marked, loose, alone, cell_rows, keep, only=apart)]

    # Loose tests on a shared place: both lists of the place in one order.
    spot = F.struct("path", "pixel_x", "pixel_y").alias("spot")
    of_place = shared.select(*param, F.col("pixel_x").alias("at_x"), F.col("pixel_y").alias("at_y"))
    both = merged.join(of_place, param).filter(is_loose | ((F.col("pixel_x") == F.col("at_x")) & (F.col("pixel_y") == F.col("at_y"))))
    both = number_within(both, [*param, "at_x", "at_y"], ["record_index"], "_before", weight=F.when(is_loose, 0).otherwise(size), total="_total")
    landing = both.filter(is_loose).withColumns({"pixel_x": F.col("at_x"), "pixel_y": F.col("at_y")}).drop("at_x", "at_y")
    landing = materialize(landing.select("*", spot))
    there = marked.filter("_meets is not null").withColumn("spot", F.struct("path", *[F.col(a).alias(b) for a, b in here.items()]))
    out.append(_numbered(there, landing, by_place + alone, cell_rows, keep, on="spot"))

    # Placed tests: loose ones come before them only for devices that stand, or stood earlier, at their place.
    own = (F.col("default_x") == F.col("wp_pos_x")) & (F.col("default_y") == F.col("wp_pos_y"))
    formula = by_place + F.when(own, alone).otherwise(0)
    moving = marked.groupBy(*group).agg(F.count_distinct(*here).alias("_places")).filter("_places > 1").drop("_places")
    movers = materialize(marked.join(moving, group, "left_semi"))
    if movers.isEmpty():
        return [*out, _numbered(marked, placed, formula, cell_rows, keep)]
    flagged = materialize(placed.join(shared.withColumn("_shared", F.lit(True)), [*param, "pixel_x", "pixel_y"], "left"))
    plain, on_shared = flagged.filter("_shared is null").drop("_shared"), flagged.filter("_shared").drop("_shared")
    out.append(_numbered(marked.join(moving, group, "left_anti"), placed, formula, cell_rows, keep))
    out.append(_numbered(movers, plain, by_place, cell_rows, keep))
    # Devices of one name at several places: how many stood at each shared place of the name before.
    stands = movers.filter("_meets is not null").select(*group, *[F.col(a).alias(b) for a, b in here.items()]).distinct()
    pairs = movers.select(*group, "device_index", *here).join(stands, group)
    is_there = (F.col("default_x") == F.col("pixel_x")) & (F.col("default_y") == F.col("pixel_y"))
    stood = number_within(pairs, [*group, "pixel_x", "pixel_y"], ["device_index"], "_stood", weight=is_there.cast("int"))
    stood = stood.select("path", "device_index", F.col("pixel_x").alias("wp_pos_x"), F.col("pixel_y").alias("wp_pos_y"), "_stood")
    carried = (*keep, "_rank", "_before", "_total", "_loose_before", "_loose_total", "default_x", "default_y")
    rows = device_test_product(movers, on_shared, cell_rows, carried).join(materialize(stood), ["path", "device_index", "wp_pos_x", "wp_pos_y"], "left")
    loose_before = F.coalesce("_stood", F.lit(0)) * F.col("_loose_total") + F.when(own, F.col("_loose_before")).otherwise(0)
    rows = rows.withColumn("segment", (by_place + loose_before + F.col("value_pos")).cast("bigint"))
    return [*out, rows.drop("_stood", *[c for c in carried if c not in keep])]
