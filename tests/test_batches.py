"""Batches held in Python workers."""
from __future__ import annotations

import hashlib
import weakref

import pyarrow as pa

from dieflow.sources import files, frames
from dieflow.sources.files import file_manifest, stdf_files


def test_small_batches_are_not_held_one_by_one():
    alive, most = set(), 0

    def rows():
        nonlocal most
        for i in range(5000):
            batch = pa.RecordBatch.from_pydict({"i": [i], "text": [f"t{i}"]})
            alive.add(i)
            weakref.finalize(batch, alive.discard, i)
            most = max(most, len(alive))
            yield batch

    out = list(frames.merged(rows()))
    assert len(out) == 1 and most < 1000
    assert out[0].column("i").to_pylist() == list(range(5000))
    assert out[0].column("text")[4999].as_py() == "t4999"


def test_batches_end_at_a_number_of_rows():
    rows = lambda: (pa.RecordBatch.from_pydict({"i": [i] * 7}) for i in range(10_000))
    out = [b for b in frames.merged(rows())]
    assert [x for b in out for x in b.column("i").to_pylist()] == [i for i in range(10_000) for _ in range(7)]
    assert all(b.num_rows <= frames._BATCH_ROWS + 7 for b in out) and len(out) == 4
    assert not list(frames.merged(iter([])))


def test_manifest_reads_contents_once(spark, tmp_path):
    for i in (1, 2, 3):
        (tmp_path / f"d{i}.stdf").write_bytes(b"x" * i)
    found = file_manifest(stdf_files(spark, str(tmp_path)))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    reads = [line for line in plan.splitlines() if "Relation [" in line and "binaryFile" in line]
    # Files with content, and the large ones by path.
    assert len(reads) == 2
    assert sorted(r.length for r in found.collect()) == [1, 2, 3]
    assert {r.file_hash for r in found.collect()} == {hashlib.md5(b"x" * i).hexdigest() for i in (1, 2, 3)}


def test_a_large_folder_is_listed_as_spark_lists_it(spark, tmp_path, monkeypatch):
    """By a task, and read in few tasks: the driver keeps no entry a file."""
    for i in range(300):
        (tmp_path / f"d {i}%20.stdf").write_bytes(b"x" * (i % 50))
    (tmp_path / "big.STDF.gz").write_bytes(b"b" * 500)
    for name in ("_hidden.stdf", ".hidden.stdf", "other.txt"):
        (tmp_path / name).write_bytes(b"no")
    (tmp_path / "folder.stdf").mkdir()
    (tmp_path / "folder.stdf" / "deep.stdf").write_bytes(b"no")
    (tmp_path / "gone.stdf").symlink_to(tmp_path / "nothing.stdf")
    (tmp_path / "link.stdf").symlink_to(tmp_path / "big.STDF.gz")
    want = files.stdf_files(spark, str(tmp_path), inline_bytes=100)
    listed, plan = files.stdf_listing(spark, str(tmp_path)), lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "binaryFile" in plan(want)
    monkeypatch.setattr(files, "LISTED", 100)
    monkeypatch.setattr(files, "TASK_BYTES", 1 << 20)
    got = files.stdf_files(spark, f"file:{tmp_path}/", inline_bytes=100)
    assert "binaryFile" not in plan(got)
    rows = lambda df: sorted(df.collect(), key=lambda r: r.path)
    assert rows(got) == rows(want) and got.columns == want.columns and len(rows(got)) == 296
    assert got.filter("content is null").count() == 2
    assert rows(files.stdf_listing(spark, str(tmp_path))) == rows(listed)
    assert sorted(map(tuple, file_manifest(got).collect())) == sorted(map(tuple, file_manifest(want).collect()))
    # 300 files of 16 KB as they are counted, and two large ones.
    assert got.rdd.getNumPartitions() == 5 + 2
    assert "ArrowEvalPython" in plan(got) and "ArrowEvalPython" not in plan(got.select("path", "length"))
    (tmp_path / "day=1").mkdir()
    assert files._listing(spark, str(tmp_path), files.SUFFIXES, 100) is None
