"""Datalog files as a Spark data source, for ``spark.read``, ``spark.readStream`` and SQL.

    register(spark)
    spark.read.format("stdf").option("types", "PTR").schema("path string, TEST_NUM bigint, RESULT float").load("/data/in")
    CREATE TEMPORARY VIEW ptr USING stdf OPTIONS (path '/data/in', types 'PTR', fields 'TEST_NUM, RESULT')

Planning only lists files. A large file is read in ranges; each finds its own first record (see
``ranges``), so nothing is scanned beforehand. Small files are read many to a task; the driver holds
their listing in columns and tasks name their files packed.
"""
from __future__ import annotations

import os
import stat
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import compute as pc
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from dieflow.sources import frames as fr
from dieflow.sources.decode import merged_fields, typed_batches
from dieflow.sources.files import SUFFIXES
from dieflow.sources.ranges import LEADS, SPLIT_BYTES, byte_order, entries, exits, is_far
from dieflow.sources.registry import layout_of, record_names
from dieflow.sources.stores import StoreFile, opened

_RAW = [f for f in fr.FRAME_SCHEMA if f.name not in ("path", "record_index", "error")]
_KEYS = [T.StructField("path", T.StringType()), T.StructField("record_pos", T.LongType()), T.StructField("record_type", T.StringType())]
_ERROR = T.StructField("error", T.StringType())
# Bytes a task reads at most of small files, what opening a file costs in bytes, and tasks that few files are spread over.
_TASK_BYTES, _OPEN_BYTES, _LEAST_TASKS = 32 << 20, 64 << 10, 64
# Listed files that are Python objects at a time; all others are in columns.
_ROWS = 10_000


@dataclass
class Part:
    """Records that start from ``begin`` to ``end`` of a file of ``length`` bytes; None: all of it."""

    path: str
    length: int | None = None
    begin: int = 0
    end: int | None = None


@dataclass
class Task(InputPartition):
    """A range of a large file, or files of a folder that a task reads one after the other: their names, packed, as the driver holds all tasks."""

    part: Part | None = None
    folder: str = ""
    names: bytes = b""

    def parts(self) -> Iterator[Part]:
        if self.part is not None:
            yield self.part
            return
        for name in zlib.decompress(self.names).decode().split("\0"):
            yield Part(self.folder + name)


class StdfSource(DataSource):
    """Options: path, types and fields (lists with commas), splitBytes.

    With ``types``: typed rows with the fields of these types (only ``fields``, or those of the given
    schema, are decoded). Without: raw records. ``record_pos`` is the record's first byte in the
    (unpacked) file. Records that cannot be read are rows with ``error``; a schema
    without that column makes them fail the query.
    """

    @classmethod
    def name(cls) -> str:
        return "stdf"

    def fields(self) -> dict[str, list[str]]:
        names = _listed(self.options.get("fields"))
        return {t: [f.name for f in layout_of(t).fields if not names or f.name in names] for t in _listed(self.options.get("types"))}

    def schema(self) -> T.StructType:
        fields = self.fields()
        return T.StructType([*_KEYS, *(merged_fields(fields) if fields else _RAW), _ERROR])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return StdfReader(self, schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return StdfStreamReader(self, schema)


def _listed(text: str | None) -> list[str]:
    return [x.strip().upper() for x in (text or "").split(",") if x.strip()]


class Records:
    """Listing and reading, for both readers."""

    def __init__(self, source: StdfSource, schema: T.StructType):
        unknown = [f.name for f in schema if f.name not in source.schema().names]
        if unknown:
            raise ValueError(f"no such columns: {', '.join(unknown)}")
        self.schema, self.path = schema, source.options["path"]
        self.split = int(source.options.get("splitBytes", SPLIT_BYTES))
        self.fields = {t: [n for n in names if n in schema.names] for t, names in source.fields().items()}
        self.types = sorted(self.fields) or None

    def listed(self) -> tuple[str, Iterator[tuple[int, str, int]]]:
        """The folder, and (time, name, bytes) of its datalog files one by one, or of the one file."""
        system, base = opened(self.path)
        found = system.get_file_info(base)
        start = self.path[: self.path.index(base.lstrip("/"))] if base.lstrip("/") in self.path else ""
        one = found.type == fs.FileType.File
        folder = os.path.dirname(base) if one else base.rstrip("/")
        rows = _local(base) if not one and isinstance(system, fs.LocalFileSystem) else _stored([found] if one else system.get_file_info(fs.FileSelector(base)))
        ends = tuple("." + s for s in SUFFIXES)
        return start + (f"{folder}/" if folder else "").lstrip("/"), (r for r in rows if r[1].endswith(ends))

    def files(self, after: tuple[int, str] = (-1, ""), upto: tuple[int, str] | None = None) -> tuple[str, pa.Table]:
        """The folder and its files with a (time, path) after one and up to another, in that order: modified, name, length."""
        folder, rows = self.listed()
        batches, held = [], []
        for row in rows:
            if after < (at := (row[0], folder + row[1])) and (upto is None or at <= upto):
                held.append(row)
            if len(held) == _ROWS:
                batches.append(_columns(held))
                held = []
        table = pa.Table.from_batches([*batches, _columns(held)])
        return folder, table.take(pc.sort_indices(table, [("modified", "ascending"), ("name", "ascending")]))

    def parts(self, folder: str, files: pa.Table) -> list[Task]:
        """A task for each range of a large file and each packed file that is large; the others go together, in their order."""
        out, group, size = [], [], 0
        most = min(_TASK_BYTES, ((pc.sum(files["length"]).as_py() or 0) + files.num_rows * _OPEN_BYTES) / _LEAST_TASKS)
        together = lambda names: Task(None, folder, zlib.compress("\0".join(names).encode()))
        for batch in files.to_batches(_ROWS):
            for name, length in zip(batch.column("name").to_pylist(), batch.column("length").to_pylist()):
                if length > self.split and not name.endswith((".gz", ".bz2", ".zip")):
                    out += [Task(Part(folder + name, length, at, min(at + self.split, length))) for at in range(0, length, self.split)]
                    continue
                if group and size + length + _OPEN_BYTES > most:
                    out.append(together(group))
                    group, size = [], 0
                group.append(name)
                size += length + _OPEN_BYTES
        return [*out, together(group)] if group else out

    def rows(self, task: Task) -> Iterator[pa.RecordBatch]:
        wanted = fr.record_codes(self.types) if self.types else None
        layouts = {t: layout_of(t) for t in self.fields}
        arrow = to_arrow_schema(self.schema)
        names = record_names()
        # The decoder's name of the position, and an error whether asked for or not.
        inner = pa.schema([*(f.with_name("record_index") if f.name == "record_pos" else f for f in arrow), *([] if "error" in arrow.names else [pa.field("error", pa.string())])])
        # The frames of small files share a batch.
        for batch in fr.merged(frames for part in task.parts() for frames in _positioned(part, wanted)):
            if "error" not in arrow.names and batch.column("error").null_count < batch.num_rows:
                broken = batch.filter(batch.column("error").is_valid())
                raise ValueError(f"{broken.column('path')[0]}: {broken.column('error')[0]}")
            if self.fields:
                found = typed_batches(batch, layouts, {t: set(n) for t, n in self.fields.items()}, inner)
            else:
                found = [_with_type(batch, names)]
            for rows in found:
                columns = [rows.column("record_index" if n == "record_pos" else n) for n in arrow.names]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)


def _local(base: str) -> Iterator[tuple[int, str, int]]:
    with os.scandir(base) as entries:
        for entry in entries:
            try:
                found = entry.stat()
            except FileNotFoundError:  # removed meanwhile, or a link to nothing
                continue
            if stat.S_ISREG(found.st_mode):
                yield found.st_mtime_ns, entry.name, found.st_size


def _stored(infos: list[fs.FileInfo]) -> Iterator[tuple[int, str, int]]:
    return ((f.mtime_ns or 0, f.base_name, f.size) for f in infos if f.type == fs.FileType.File)


def _columns(rows: list[tuple[int, str, int]]) -> pa.RecordBatch:
    modified, name, length = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(modified, pa.int64()), pa.array(name, pa.string()), pa.array(length, pa.int64())], ["modified", "name", "length"])


def _with_type(batch: pa.RecordBatch, names: dict[tuple[int, int], str]) -> pa.RecordBatch:
    kinds = [None if t is None else names.get((t, s), "???") for t, s in zip(batch.column("rec_typ").to_pylist(), batch.column("rec_sub").to_pylist())]
    return batch.append_column("record_type", pa.array(kinds, pa.string()))


def _positioned(part: Part, wanted: set[int] | None) -> Iterator[pa.RecordBatch]:
    """Frames of a part whose record_index is the record's position."""
    if part.end is None:
        yield from fr.positioned(part.path, wanted)
        return
    with StoreFile(part.path) as stream:
        head = bytes(stream.read(6))
        if not is_far(head):
            if part.begin == 0:
                yield from fr.positioned(part.path, wanted)
            return
        little = byte_order(head)
        starts = []
        for lead in LEADS:
            if len(starts) != 1:
                starts = entries(stream, part.begin, part.length, little, lead)
        # Where several walks are left, only the one from the file's start can tell.
        first = int(starts[0]) if len(starts) == 1 else exits(stream, [0], part.begin, part.length, little)[0][0]
    if first < part.end:
        yield from fr.positioned(part.path, wanted, first, part.end)


class StdfReader(DataSourceReader):
    def __init__(self, source: StdfSource, schema: T.StructType):
        self.records = Records(source, schema)

    def partitions(self) -> list[Task]:
        return self.records.parts(*self.records.files())

    def read(self, partition: Task) -> Iterator[pa.RecordBatch]:
        return self.records.rows(partition)


class StdfStreamReader(DataSourceStreamReader):
    """New files by (time, path). A file that appears with a time before the last one seen is not noticed."""

    def __init__(self, source: StdfSource, schema: T.StructType):
        self.records = Records(source, schema)

    def initialOffset(self) -> dict:
        return {"modified": 0, "path": ""}

    def latestOffset(self) -> dict:
        folder, rows = self.records.listed()
        last = max(((modified, name) for modified, name, _ in rows), default=None)
        return self.initialOffset() if last is None else {"modified": last[0], "path": folder + last[1]}

    def partitions(self, start: dict, end: dict) -> list[Task]:
        return self.records.parts(*self.records.files(*((x["modified"], x["path"]) for x in (start, end))))

    def read(self, partition: Task) -> Iterator[pa.RecordBatch]:
        return self.records.rows(partition)


def register(spark: SparkSession) -> None:
    """Make the format ``stdf`` known to a session.

    Types and fields are chosen by option or schema. Filters are not pushed: Spark keeps a reader
    it has pushed filters to with the view, and later queries of the view would use it.
    """
    spark.dataSource.register(StdfSource)


__all__ = ["StdfSource", "register"]
