"""The data source against the walk and the decoder."""
import gzip
import os
import pickle
import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dieflow.sources import datasource as ds, decode as d, frames as fr
from dieflow.sources.datasource import register
from dieflow.sources.files import stdf_files
from fixtures.encode import datalog
from test_binary import starts_of, with_vendor_records


def made(tmp_path):
    rng = random.Random(3)
    data = with_vendor_records(3000, rng)
    (tmp_path / "a.stdf").write_bytes(data)
    (tmp_path / "b.stdf.gz").write_bytes(gzip.compress(datalog([("PTR", {"TEST_NUM": 7, "RESULT": 1.5}), ("PRR", {"PART_ID": "x"})], False)))
    (tmp_path / "c.txt").write_bytes(b"none")
    return data


@pytest.mark.parametrize("split", [1000, 1 << 20])
def test_raw_records_equal_the_walk(spark, tmp_path, split):
    data = made(tmp_path)
    register(spark)
    got = spark.read.format("stdf").option("splitBytes", split).load(str(tmp_path))
    walked = fr.stdf_frames(stdf_files(spark, str(tmp_path)))
    columns = ["rec_typ", "rec_sub", "rec_len", "little_endian", "stdf_ver", "body", "error"]
    assert got.select(*columns).exceptAll(walked.select(*columns)).count() == 0 and got.count() == walked.count()
    places = [r.record_pos for r in got.filter("path like '%a.stdf'").orderBy("record_pos").collect()]
    assert places == starts_of(data)


def test_sql_reads_the_fields_it_names(spark, tmp_path):
    made(tmp_path)
    register(spark)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW ptr_log USING stdf OPTIONS (path '{tmp_path}', types 'PTR, PRR', fields 'TEST_NUM, RESULT, PART_ID')")
    assert set(spark.table("ptr_log").columns) == {"path", "record_pos", "record_type", "PART_ID", "TEST_NUM", "RESULT", "error"}
    rows = spark.sql("SELECT TEST_NUM, RESULT FROM ptr_log WHERE record_type = 'PTR'")
    want = d.decode_ptr(fr.stdf_frames(stdf_files(spark, str(tmp_path))), ["TEST_NUM", "RESULT"]).select("TEST_NUM", "RESULT")
    assert rows.count() == 3001 and rows.exceptAll(want).count() == 0
    assert spark.sql("SELECT PART_ID FROM ptr_log WHERE record_type = 'PRR'").collect()[0].PART_ID == "x"
    paths = {r.path for r in spark.table("ptr_log").select("path").distinct().collect()}
    assert len(paths) == 2 and all(p.endswith(("a.stdf", "b.stdf.gz")) for p in paths)
    assert spark.table("ptr_log").filter(F.col("path").endswith(".gz")).count() == 2


def test_a_schema_chooses_fields_and_errors(spark, tmp_path):
    made(tmp_path)
    register(spark)
    reader = spark.read.format("stdf").option("types", "PTR")
    assert reader.schema("TEST_NUM bigint, record_pos bigint").load(str(tmp_path)).count() == 3001
    (tmp_path / "cut.stdf").write_bytes(datalog([("PTR", {"TEST_NUM": 1})])[:-2])
    (tmp_path / "text.stdf").write_bytes(b"no datalog" * 900)
    errors = spark.read.format("stdf").options(types="PTR", splitBytes=500).load(str(tmp_path)).filter("error is not null")
    assert sorted(r.error for r in errors.collect()) == sorted([fr.TRUNCATED, fr.NOT_FAR])
    with pytest.raises(Exception, match="cut off|not FAR"):
        reader.schema("TEST_NUM bigint").load(str(tmp_path)).collect()


def test_a_stream_sees_each_file_once(spark, tmp_path):
    folder, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    folder.mkdir()
    register(spark)

    def run():
        stream = spark.readStream.format("stdf").option("types", "PTR").load(str(folder))
        stream.select("path", "TEST_NUM").writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True).start(out).awaitTermination()
        return spark.read.parquet(out).count()

    (folder / "a.stdf").write_bytes(datalog([("PTR", {"TEST_NUM": i}) for i in range(5)]))
    assert run() == 5 and run() == 5
    (folder / "b.stdf").write_bytes(datalog([("PTR", {"TEST_NUM": i}) for i in range(3)]))
    later = os.stat(folder / "a.stdf").st_mtime + 5
    os.utime(folder / "b.stdf", (later, later))
    assert run() == 8


def test_many_small_files_share_tasks(spark, tmp_path):
    for i in range(1500):
        (tmp_path / f"f{i}.stdf").write_bytes(datalog([("PTR", {"TEST_NUM": i}), ("PRR", {"PART_ID": "x"})], i % 2 == 0))
    register(spark)
    rows = spark.read.format("stdf").options(types="PTR", fields="TEST_NUM").load(str(tmp_path))
    assert rows.rdd.getNumPartitions() <= 70
    got = {(r.path.rsplit("/", 1)[-1], r.TEST_NUM) for r in rows.collect()}
    assert got == {(f"f{i}.stdf", i) for i in range(1500)}
    (tmp_path / "f7.stdf").write_bytes(b"no datalog")
    with pytest.raises(Exception, match="f7.stdf: first record is not FAR"):
        spark.read.format("stdf").option("types", "PTR").schema("TEST_NUM bigint").load(str(tmp_path)).collect()


def test_the_driver_holds_little_of_each_file(tmp_path):
    """Offsets and tasks of many files: some bytes a file, in the listing and in what is sent to the JVM."""
    n = 20_000
    for i in range(n):
        (tmp_path / f"p{i}.stdf").write_bytes(b"x")
    source = ds.StdfSource({"path": f"file:{tmp_path}", "types": "PTR"})
    reader = source.streamReader(source.schema())
    tracemalloc.start()
    try:
        held = pa.total_allocated_bytes()
        end = reader.latestOffset()
        assert tracemalloc.get_traced_memory()[1] < 1 << 20
        tasks = reader.partitions(reader.initialOffset(), end)
        # The rows that are objects at a time are a fixed number.
        assert tracemalloc.get_traced_memory()[1] < 200 * n and pa.total_allocated_bytes() - held < 100 * n
    finally:
        tracemalloc.stop()
    assert len(pickle.dumps(tasks)) < 20 * n
    assert {p.path for t in tasks for p in t.parts()} == {f"file:{tmp_path}/p{i}.stdf" for i in range(n)}
    assert len(tasks) <= 70 and reader.partitions(end, end) == []


def test_files_are_told_apart_by_time_and_path(tmp_path):
    for name, at in (("b.stdf", 5), ("a.stdf", 5), ("c.stdf.gz", 3), ("none.txt", 9), ("d e%20.STDF", 7)):
        (tmp_path / name).write_bytes(b"x")
        os.utime(tmp_path / name, (at, at))
    (tmp_path / "folder.stdf").mkdir()
    (tmp_path / "gone.stdf").symlink_to(tmp_path / "nothing")
    for path, start in ((str(tmp_path), str(tmp_path)), (f"file://{tmp_path}/", f"file://{tmp_path}")):
        source = ds.StdfSource({"path": path})
        reader = source.streamReader(source.schema())
        named = lambda tasks: [p.path for t in tasks for p in t.parts()]
        assert named(source.reader(source.schema()).partitions()) == [f"{start}/{n}" for n in ("c.stdf.gz", "a.stdf", "b.stdf", "d e%20.STDF")]
        assert reader.latestOffset() == {"modified": 7 * 10**9, "path": f"{start}/d e%20.STDF"}
        assert named(reader.partitions({"modified": 5 * 10**9, "path": f"{start}/a.stdf"}, reader.latestOffset())) == [f"{start}/b.stdf", f"{start}/d e%20.STDF"]
    one = ds.StdfSource({"path": f"file:{tmp_path}/a.stdf"})
    assert [p.path for t in one.reader(one.schema()).partitions() for p in t.parts()] == [f"file:{tmp_path}/a.stdf"]
    (tmp_path / "empty").mkdir()
    empty = ds.StdfSource({"path": f"{tmp_path}/empty"})
    assert empty.reader(empty.schema()).partitions() == [] and empty.streamReader(empty.schema()).latestOffset() == {"modified": 0, "path": ""}
    with pytest.raises(FileNotFoundError):
        gone = ds.StdfSource({"path": f"{tmp_path}/missing"})
        gone.reader(gone.schema()).partitions()
