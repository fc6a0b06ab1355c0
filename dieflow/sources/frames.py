"""Walking the record chain of datalog files.

The walk is spread over files, and over byte ranges of large ones (``ranges``). It works on
bounded blocks, touches only the record headers in Python and hands bodies on as Arrow slices.
"""
from __future__ import annotations

import bz2
import gzip
import hashlib
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dieflow.sources.packed import PACKED, SPLIT_PACKED, MemberStream, kind_of, packed_units
from dieflow.sources.ranges import SPLIT_BYTES, byte_order, is_far, range_units
from dieflow.sources.registry import layout_of
from dieflow.sources.stores import StoreFile

FRAME_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("record_index", T.LongType()),
        T.StructField("rec_typ", T.ShortType()),
        T.StructField("rec_sub", T.ShortType()),
        T.StructField("rec_len", T.IntegerType()),
        T.StructField("little_endian", T.BooleanType()),
        T.StructField("stdf_ver", T.ShortType()),
        T.StructField("body", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]
)
_ARROW = pa.schema(
    [
        ("path", pa.string()), ("record_index", pa.int64()), ("rec_typ", pa.int16()), ("rec_sub", pa.int16()),
        ("rec_len", pa.int32()), ("little_endian", pa.bool_()), ("stdf_ver", pa.int16()), ("body", pa.binary()),
        ("error", pa.string()),
    ]
)
_CHUNK = 16 << 20
# Files up to this size are held whole while they are hashed and walked.
_WHOLE = 64 << 20
# Type and subtype of the frame that holds a file's hash; no record has them.
HASH = -1
_BATCH_ROWS = 20_000
# Small batches held one by one; so many are put together at once, as each costs more than its rows.
_HELD = 256
# Faults of a file's format.
_BROKEN = (OSError, EOFError, zipfile.BadZipFile, zlib.error, ValueError)
NOT_FAR = "first record is not FAR"
TRUNCATED = "record is cut off"


def open_path(path: str) -> StoreFile:
    """Random-access file on any store that ``stores.SCHEMES`` names."""
    return StoreFile(path)


# What parts an archive's path from a member's name.
MEMBER = "!/"


@contextmanager
def _opened(path: str, content: pa.Buffer | None) -> Iterator[Iterator[tuple[str, object]]]:
    """The datalogs of a file, unpacked by its suffix: (path, stream). Those of an archive with several members have paths of their own."""
    raw = open_path(path) if content is None else pa.BufferReader(content)
    with raw:
        if path.endswith(".gz"):
            yield iter([(path, gzip.GzipFile(fileobj=raw))])
        elif path.endswith(".bz2"):
            yield iter([(path, bz2.BZ2File(raw))])
        elif path.endswith(".zip"):
            archive = zipfile.ZipFile(raw)
            names = [m for m in archive.infolist() if not m.is_dir()]
            yield ((path if len(names) == 1 else f"{path}{MEMBER}{m.filename}", archive.open(m)) for m in names)
        else:
            yield iter([(path, raw)])


def gather(source: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate ranges of ``source``; returns the bytes and the Arrow offsets."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    index = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return source[index], offsets


def binary_array(data: np.ndarray, offsets: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    mask = None if valid is None or valid.all() else pa.array(valid).buffers()[1]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [mask, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _error_batch(path: str, index: int, typ: int | None, sub: int | None, message: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"path": path, "record_index": index, "rec_typ": typ, "rec_sub": sub, "error": message}], _ARROW)


def _blocks(stream, little: bool, size: int | None = None) -> Iterator[tuple[bytes, list[int], int]]:
    """Bounded blocks of a stream with the record starts in each and where the last one ends.

    ``size`` bounds the bytes read. The remainder of a record moves to the next block.
    """
    low, high = (0, 1) if little else (1, 0)
    left, rest = size, b""
    while True:
        more = stream.read(_CHUNK if left is None else min(_CHUNK, left))
        if left is not None:
            left -= len(more)
        block = rest + bytes(more) if rest else bytes(more)
        length, pos, starts = len(block), 0, []
        while pos + 4 <= length:
            after = pos + 4 + (block[pos + low] | block[pos + high] << 8)
            if after > length:
                break
            starts.append(pos)
            pos = after
        yield block, starts, pos
        rest = block[pos:]
        if not more:
            return


def walk(
    path: str, stream, wanted: set[int] | None, first: int = 0, stop: int | None = None, base: int = 0, head: bytes | None = None,
) -> Iterator[pa.RecordBatch]:
    """Frames of a file, or of its bytes from ``first`` to ``stop`` with ``base`` records before.

    ``wanted`` holds typ * 256 + sub. With ``head``, the file's first bytes, the stream stands at ``first`` already.
    """
    placed = head is not None
    head = head if placed else bytes(stream.read(6))
    if not is_far(head):
        yield _error_batch(path, 1, *((head[2], head[3]) if len(head) >= 4 else (None, None)), NOT_FAR)
        return
    little, version, index = byte_order(head), head[5], base
    if not placed:
        stream.seek(first)
    for block, starts, end in _blocks(stream, little, None if stop is None else stop - first):
        if starts:
            numbers = index + 1 + np.arange(len(starts), dtype=np.int64)
            yield from _frames(path, np.frombuffer(block, np.uint8), np.array(starts, np.int64), end, numbers, little, version, wanted)
            index += len(starts)
    if end < len(block):
        left = block[end:]
        yield _error_batch(path, index + 1, *((left[2], left[3]) if len(left) >= 4 else (None, None)), TRUNCATED)


def positioned(path: str, wanted: set[int] | None, first: int = 0, end: int | None = None) -> Iterator[pa.RecordBatch]:
    """Frames of the records that start from ``first``, a record's start, to ``end``; record_index is the place of a record's first byte."""
    try:
        with _opened(path, None) as logs:
            for name, stream in logs:
                yield from _positioned(name, stream, wanted, first, end)
    except _BROKEN as problem:
        yield _error_batch(path, 0, None, None, f"unreadable: {problem}")


def _positioned(path: str, stream, wanted: set[int] | None, first: int, end: int | None) -> Iterator[pa.RecordBatch]:
    head = bytes(stream.read(6))
    if not is_far(head):
        yield _error_batch(path, 0, None, None, NOT_FAR)
        return
    little, at = byte_order(head), first
    stream.seek(first)
    for block, starts, stop in _blocks(stream, little):
        places = np.array(starts, np.int64)
        inside = len(places) if end is None else int(np.searchsorted(places, end - at))
        if inside:
            last = stop if inside == len(places) else int(places[inside])
            yield from _frames(path, np.frombuffer(block, np.uint8), places[:inside], last, at + places[:inside], little, head[5], wanted)
        if inside < len(places):
            return
        at += stop
        if end is not None and at >= end:
            return
    if stop < len(block):
        left = block[stop:]
        yield _error_batch(path, at, *((left[2], left[3]) if len(left) >= 4 else (None, None)), TRUNCATED)


def _frames(path, data, starts, end, numbers, little, version, wanted) -> Iterator[pa.RecordBatch]:
    lengths = np.diff(np.append(starts, end)) - 4
    kinds = data[starts + 2].astype(np.int32) * 256 + data[starts + 3]
    if wanted is not None:
        keep = np.isin(kinds, list(wanted))
        starts, lengths, kinds, numbers = starts[keep], lengths[keep], kinds[keep], numbers[keep]
    n = len(starts)
    if n == 0:
        return
    body = binary_array(*gather(data, starts + 4, lengths))
    yield pa.RecordBatch.from_arrays(
        [
            pa.repeat(pa.scalar(path), n), pa.array(numbers), pa.array((kinds >> 8).astype(np.int16)),
            pa.array((kinds & 255).astype(np.int16)), pa.array(lengths.astype(np.int32)), pa.repeat(pa.scalar(little), n),
            pa.repeat(pa.scalar(version, pa.int16()), n), body, pa.nulls(n, pa.string()),
        ],
        schema=_ARROW,
    )


def frame_batches(batches: Iterator[pa.RecordBatch], wanted: set[int] | None, hashes: bool = False) -> Iterator[pa.RecordBatch]:
    """(path, content) batches to frame batches; the frames of small files share a batch.

    ``hashes`` adds a frame of type HASH per whole file, its body the MD5 of the file's bytes.
    """
    return merged(_file_batches(batches, wanted, hashes))


def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches put together."""
    held, joined, rows, size = [], [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= _BATCH_ROWS or size >= _CHUNK:
            yield from _joined(joined + held)
            held, joined, rows, size = [], [], 0, 0
        elif len(held) == _HELD:
            joined += _joined(held)
            held = []
    if rows:
        yield from _joined(joined + held)


def _joined(batches: list[pa.RecordBatch]) -> list[pa.RecordBatch]:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()


def _hash_batch(path: str, content: pa.Buffer | None, stream=None) -> pa.RecordBatch:
    digest = hashlib.md5()
    if content is not None:
        digest.update(content)
    else:
        with stream or open_path(path) as source:
            while block := source.read(_CHUNK):
                digest.update(block)
    return pa.RecordBatch.from_pylist([{"path": path, "record_index": 0, "rec_typ": HASH, "rec_sub": HASH, "body": digest.hexdigest().encode()}], _ARROW)


def _hashes(path: str, content: pa.Buffer | None) -> Iterator[pa.RecordBatch]:
    """The hash of a file, or of each member of an archive with several."""
    several: list[pa.RecordBatch] = []
    if path.endswith(".zip"):
        try:
            with _opened(path, content) as logs:
                several = [_hash_batch(name, None, stream) for name, stream in logs if name != path]
        except _BROKEN:
            several = []
    yield from several or [_hash_batch(path, content)]


def _file_batches(batches: Iterator[pa.RecordBatch], wanted: set[int] | None, hashes: bool = False) -> Iterator[pa.RecordBatch]:
    """A file with a broken format gives an error row; a store that cannot be read fails the task, which then runs again."""
    for batch in batches:
        content = batch.column("content")
        ranges = batch.select([c for c in ("first", "stop", "base", "packed_at") if c in batch.schema.names]).to_pylist()
        for i, path in enumerate(batch.column("path").to_pylist()):
            data = content[i].as_buffer() if content[i].is_valid else None
            if hashes and ranges[i]["first"] is None:
                if data is None:
                    # A small file is read once, for its hash and for its records.
                    with open_path(path) as stream:
                        data = pa.py_buffer(stream.read()) if stream.size() <= _WHOLE else None
                yield from _hashes(path, data)
            if (at := ranges[i].get("packed_at")) is not None:
                yield from _packed_part(path, wanted, at, ranges[i]["first"], ranges[i]["stop"], ranges[i]["base"])
                continue
            try:
                with _opened(path, data) as logs:
                    for name, stream in logs:
                        yield from walk(name, stream, wanted, ranges[i]["first"] or 0, ranges[i]["stop"], ranges[i]["base"] or 0)
            except _BROKEN as problem:
                yield _error_batch(path, 1, None, None, f"unreadable: {problem}")


def _packed_part(path: str, wanted: set[int] | None, at: int, first: int, stop: int | None, base: int) -> Iterator[pa.RecordBatch]:
    """Frames of a packed file from its member at ``at`` on, ``first`` unpacked bytes skipped."""
    kind = kind_of(path)
    try:
        with open_path(path) as raw:
            head = MemberStream(raw, 0, kind).read(6)
            yield from walk(path, MemberStream(raw, at, kind, first), wanted, first, stop, base, head)
    except _BROKEN as problem:
        yield _error_batch(path, base + 1, None, None, f"unreadable: {problem}")


# --- what to walk ------------------------------------------------------------------------

def walk_units(files: DataFrame, split_bytes: int = SPLIT_BYTES, split_packed: int = SPLIT_PACKED) -> DataFrame:
    """What to walk: whole files, ranges of large unpacked ones, members of large packed ones: path, content, first, stop, base, packed_at."""
    nothing = F.lit(None).cast("bigint")
    columns = ["path", "content", "first", "stop", "base", "packed_at"]
    whole = lambda df: df.select("path", "content", *[nothing.alias(c) for c in columns[2:]])
    if "length" not in files.columns:
        return whole(files)
    is_packed = F.col("path").rlike(PACKED)
    can_split = (~is_packed & (F.col("length") > split_bytes)) | (is_packed & ~F.endswith(F.col("path"), F.lit(".zip")) & (F.col("length") > split_packed))
    # Contents of files that are not large are not looked at here.
    large = files.filter(can_split).filter(F.col("content").isNull()).select("path", "length")
    kinds = [r["packed"] for r in large.select(is_packed.alias("packed")).distinct().collect()]
    out = whole(files.filter(~(can_split & F.col("content").isNull()))) if kinds else whole(files)
    parts = []
    if False in kinds:
        parts.append(range_units(large.filter(~is_packed), split_bytes, open_path).withColumn("packed_at", nothing))
    if True in kinds:
        parts.append(packed_units(large.filter(is_packed), split_packed, open_path))
    for part in parts:
        out = out.unionByName(part.withColumn("content", F.lit(None).cast("binary")).select(*columns))
    return out


def record_codes(types) -> set[int] | None:
    if types is None:
        return None
    return {layout_of(t).typ * 256 + layout_of(t).sub for t in types}


def stdf_frames(files: DataFrame, types: list[str] | None = None, split_bytes: int = SPLIT_BYTES, split_packed: int = SPLIT_PACKED) -> DataFrame:
    """Raw records of each file with a 1-based record_index.

    ``files`` holds path and content (NULL: read by path) and, to split large files, length.

    ``types`` drops unwanted bodies inside the walk, before they leave the task.
    Rows with ``error`` set mark files or records that could not be read.
    """
    wanted = record_codes(types)
    return walk_units(files, split_bytes, split_packed).mapInArrow(lambda it: frame_batches(it, wanted), FRAME_SCHEMA)


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [_hash_batch(path, None).column("body")[0].as_py().decode() for path in batch.column("path").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array(digests, pa.string())], ["path", "length", "file_hash"])


def hash_large_files(files: DataFrame) -> DataFrame:
    """MD5 of files too large to load whole, read in chunks."""
    return files.select("path", "length").mapInArrow(_hash_batches, "path string, length bigint, file_hash string")


def record_type_column(frames: DataFrame) -> DataFrame:
    """Add record_type to frames."""
    from dieflow.functions.codes import record_type_name

    return frames.withColumn("record_type", record_type_name(F.col("rec_typ"), F.col("rec_sub")))
