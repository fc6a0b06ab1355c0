"""Cutting large packed datalog files at the members they consist of.

A gzip or bzip2 file may be many packed streams in a row, and tools that pack in parallel write it
so. A first pass finds where members can start, by their signature. A second one unpacks every
part between two such places and reports where its last member ended, which proves or refutes
the next part's start, and, for every offset at which a record can begin in the part, the record
that follows the part and the records before it. Put together from the file's start these
maps give each part its first record. Signatures inside packed data are told from members by
the proof; a file without it is unpacked in one piece.
"""
from __future__ import annotations

import bz2
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dieflow.session import materialize
from dieflow.sources.ranges import FEW, LONGEST, MOST_TASKS, STRETCH, byte_order, is_far
from dieflow.sources.stores import StoreFile

# Suffixes of packed files, as a pattern.
PACKED = r"\.(gz|bz2|zip)$"
# Packed bytes of a part.
SPLIT_PACKED = 64 << 20
CHUNK = 1 << 20
# How a member starts.
SIGNATURE = {".gz": re.compile(rb"\x1f\x8b\x08[\x00-\x1f]", re.S), ".bz2": re.compile(rb"BZh[1-9]1AY&SY", re.S)}
_WIDEST = 10
_FAULTS = (OSError, EOFError, ValueError, zlib.error)


def kind_of(path: str) -> str:
    return next((k for k in SIGNATURE if path.endswith(k)), "")


class Members:
    """The unpacked bytes of the members from an offset on, with the offset behind the last whole one."""

    def __init__(self, raw, at: int, kind: str):
        self.raw, self.kind, self.at, self.rest = raw, kind, at, b""
        raw.seek(at)
        self._fresh()

    def _fresh(self) -> None:
        self.unpack = zlib.decompressobj(31) if self.kind == ".gz" else bz2.BZ2Decompressor()
        self.fed = 0

    def blocks(self, stop: int | None = None) -> Iterator[bytes]:
        """Unpacked pieces, until a member ends at or behind ``stop``."""
        while True:
            data = self.rest or bytes(self.raw.read(CHUNK))
            self.rest = b""
            if not data:
                if self.fed:
                    raise EOFError("a member is cut off")
                return
            out = self.unpack.decompress(data)
            self.fed += len(data)
            if self.unpack.eof:
                self.rest = self.unpack.unused_data
                self.at += self.fed - len(self.rest)
                self._fresh()
                if out:
                    yield out
                if stop is not None and self.at >= stop:
                    return
            elif out:
                yield out


class MemberStream:
    """Forward-only stream over unpacked members from an offset on."""

    def __init__(self, raw, at: int, kind: str, skip: int = 0):
        self.raw, self.pieces, self.held = raw, Members(raw, at, kind).blocks(), b""
        while skip:
            skip -= len(self.read(min(skip, CHUNK)))

    def read(self, size: int) -> bytes:
        parts, have = [self.held], len(self.held)
        while have < size and (piece := next(self.pieces, None)) is not None:
            parts.append(piece)
            have += len(piece)
        data = b"".join(parts)
        self.held = data[size:]
        return data[:size]

    def close(self) -> None:
        self.raw.close()


class Walks:
    """Walks from every offset at which a record can begin, over data that comes in pieces."""

    def __init__(self, little: bool, starts: int):
        self.little, self.base, self.held = little, 0, b""
        # Places still walked, and for each start its place and the records it passed.
        self.pos, self.of, self.n = np.arange(starts, dtype=np.int64), np.arange(starts), np.zeros(starts, np.int64)

    def feed(self, data: bytes) -> None:
        self.held += data
        if len(self.held) >= STRETCH + 4:
            self._advance(len(self.held) - 4)

    def _advance(self, size: int) -> None:
        data, stop = self.held, self.base + size
        here = self.pos < stop
        if here.any():
            places = self.pos[here] - self.base
            moved, passed = self._moved(data, places, size)
            pos, n = self.pos.copy(), np.zeros(len(self.pos), np.int64)
            pos[here], n[here] = moved + self.base, passed
            self.n += n[self.of]
            self.pos, back = np.unique(pos, return_inverse=True)
            self.of = back[self.of]
        self.held, self.base = data[size:], stop

    def _moved(self, data: bytes, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(places) <= FEW:
            low, high = (0, 1) if self.little else (1, 0)
            out = []
            for p in places.tolist():
                k = 0
                while p < size:
                    p += 4 + (data[p + low] | data[p + high] << 8)
                    k += 1
                out.append((p, k))
            return tuple(np.array(x, np.int64) for x in zip(*out))
        raw = np.frombuffer(data, np.uint8)[:size + 1].astype(np.int64)
        first, second = raw[:-1], raw[1:]
        to = np.arange(size) + 4 + (first | second << 8 if self.little else first << 8 | second)
        n = np.ones(size, np.int64)
        while (inside := np.flatnonzero(to < size)).size:
            n[inside] += n[to[inside]]
            to[inside] = to[to[inside]]
        return to[places], n[places]

    def end(self, following: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For each start: how far behind the data its walk stands, and the records it passed.

        ``following`` holds the bytes after the data, for a header that lies across its end.
        """
        size = self.base + len(self.held)
        self.held += following[:4].ljust(4, b"\0")
        self._advance(size - self.base)
        return self.pos[self.of] - size, self.n


_FOUND = "path string, start bigint"
_PART = "path string, start bigint, end bigint, size bigint, exits binary, n binary"
_PART_ARROW = pa.schema([("path", pa.string()), *[(c, pa.int64()) for c in ("start", "end", "size")], ("exits", pa.binary()), ("n", pa.binary())])


def _starts(batches: Iterator[pa.RecordBatch], opener: Callable[[str], StoreFile]) -> Iterator[pa.RecordBatch]:
    """Places in ranges of packed bytes where a member can start: its signature, and bytes that unpack."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            kind = kind_of(r["path"])
            with opener(r["path"]) as raw:
                for at in range(r["begin"], r["end"], CHUNK * 16):
                    stop = min(at + CHUNK * 16, r["end"])
                    raw.seek(at)
                    data = bytes(raw.read(stop - at + (1 << 16)))
                    for found in SIGNATURE[kind].finditer(data, 0, min(len(data), stop - at + _WIDEST)):
                        if found.start() < stop - at:
                            try:
                                (zlib.decompressobj(31) if kind == ".gz" else bz2.BZ2Decompressor()).decompress(data[found.start():found.start() + (1 << 16)])
                            except _FAULTS:
                                continue
                            rows.append({"path": r["path"], "start": at + found.start()})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("path", pa.string()), ("start", pa.int64())]))


def _maps(batches: Iterator[pa.RecordBatch], opener: Callable[[str], StoreFile]) -> Iterator[pa.RecordBatch]:
    """Unpack parts; where a part's last member ended, and the map of its records. No map where it does not unpack."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            kind, row = kind_of(r["path"]), {"path": r["path"], "start": r["start"]}
            try:
                with opener(r["path"]) as raw:
                    head = MemberStream(raw, 0, kind).read(6)
                    if is_far(head):
                        members, size = Members(raw, r["start"], kind), 0
                        walks = Walks(byte_order(head), 1 if r["start"] == 0 else LONGEST)
                        for piece in members.blocks(r["stop"]):
                            walks.feed(piece)
                            size += len(piece)
                        at, following = members.at, b""
                        for piece in members.blocks():
                            following += piece
                            if len(following) >= 4:
                                break
                        exits, n = walks.end(following)
                        row |= {"end": at, "size": size, "exits": zlib.compress(exits.astype("<i8").tobytes(), 1), "n": zlib.compress(n.astype("<i8").tobytes(), 1)}
            except _FAULTS:
                pass
            rows.append(row)
        yield pa.RecordBatch.from_pylist(rows, _PART_ARROW)


def _compose(parts: pd.DataFrame) -> pd.DataFrame:
    """Follow a file's parts from its start: units with the unpacked bytes to skip and to read, and the records before."""
    units, entry, base, at, whole = [], 0, 0, 0, True
    for r in parts.sort_values("start").itertuples():
        if pd.isna(r.end) or r.start != at:
            whole = False
            break
        exits, n = (np.frombuffer(zlib.decompress(x), "<i8") for x in (r.exits, r.n))
        # A missing value elsewhere makes whole numbers floats.
        start, size = int(r.start), int(r.size)
        after, passed = (entry - size, 0) if entry >= size else (int(exits[entry]), int(n[entry]))
        if passed:
            units.append([start, entry, size + after, base])
        entry, base, at = after, base + passed, int(r.end)
    if not whole or not units:
        units = [[None, None, None, 0]]
    else:
        # The last one runs to the end of the file, so a cut-off record is seen.
        units[-1][2] = None
    out = pd.DataFrame(units, columns=["packed_at", "first", "stop", "base"]).astype("Int64")
    return out.assign(path=parts["path"].iloc[0])[["path", "packed_at", "first", "stop", "base"]]


def packed_units(large: DataFrame, split_bytes: int = SPLIT_PACKED, opener: Callable[[str], StoreFile] = StoreFile) -> DataFrame:
    """Parts of packed files (path, length): path, packed_at (where its first member starts; NULL: the whole file), first, stop, base.

    ``first`` and ``stop`` are unpacked bytes from there.
    """
    spark = large.sparkSession
    n_bytes = large.agg(F.sum("length")).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(n_bytes // SPLIT_PACKED, MOST_TASKS))
    ranges = (
        large.select("path", "length", F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / split_bytes))).alias("range"))
        .select("path", (F.col("range") * split_bytes).alias("begin"), F.least((F.col("range") + 1) * split_bytes, F.col("length")).alias("end"))
        .repartition(n, "path", "begin")
    )
    starts = ranges.mapInArrow(lambda it: _starts(it, opener), _FOUND)
    # The first place in each range starts a part; a part ends where the next one starts.
    first = starts.groupBy("path", F.floor(F.col("start") / split_bytes).alias("range")).agg(F.min("start").alias("start"))
    following = F.lead("start").over(Window.partitionBy("path").orderBy("start"))
    parts = first.withColumn("stop", following).join(large.select("path", "length"), "path").select("path", "start", "stop", "length")
    maps = materialize(materialize(parts).repartition(n, "path", "start").mapInArrow(lambda it: _maps(it, opener), _PART))
    units = maps.groupBy("path").applyInPandas(_compose, "path string, packed_at bigint, first bigint, stop bigint, base bigint")
    return units.repartition(n, "path", "packed_at")
