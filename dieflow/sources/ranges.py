"""Cutting large datalog files into ranges that tasks can walk on their own.

A record says only how long it is, so nothing marks where one starts. But chains of lengths run
together: whatever offset a walk starts from, after some records it stands where the true
one stands. A range therefore starts a walk at *every* offset a record can begin at, some
megabytes before its own start. Those walks are followed all at once; the few that are
left where the range starts include the true one, whatever the records hold, registered
types or not. Each of them is followed to the range's end, which maps entry to exit. The
maps are put together per file from its first record on, and say exactly where each
range's first record starts and how many come before it.
"""
from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dieflow.session import materialize
from dieflow.sources.stores import StoreFile

# Bytes per range, bytes walked before it (the second where the first leave too many walks), and walks that may be left.
SPLIT_BYTES = 256 << 20
LEADS = 4 << 20, 32 << 20
MOST = 1024
# A record's largest size, bytes whose walks are joined at once, bytes read at once.
LONGEST = 65535 + 4
STRETCH = 1 << 20
CHUNK = 16 << 20
# Walks that are quicker followed one by one.
FEW = 16
# Tasks that look at ranges or walk them.
MOST_TASKS = 20_000
BIG, LITTLE = 1, 2  # CPU_TYPE values of the first record; any other means host order


def is_far(head: bytes) -> bool:
    """Does a file start with its byte order and version?"""
    return len(head) >= 6 and head[2] == 0 and head[3] == 10


def byte_order(head: bytes) -> bool:
    """Is the file little endian?"""
    return {BIG: False, LITTLE: True}.get(head[4], sys.byteorder == "little")


def _step_all(data: bytes, base: int, lo: int, hi: int, length: int, little: bool) -> np.ndarray:
    """For every offset from lo to hi (relative to ``base``): where a walk from it leaves that stretch."""
    raw = np.frombuffer(data, np.uint8)
    size = max(0, min(hi, length - base - 3) - lo)
    first, second = raw[lo:lo + size].astype(np.int64), raw[lo + 1:lo + 1 + size].astype(np.int64)
    lengths = first | second << 8 if little else first << 8 | second
    to = np.full(hi - lo, length - base, np.int64)
    # A record that is cut off ends the file.
    to[:size] = np.minimum(np.arange(lo, lo + size) + 4 + lengths, length - base)
    while (inside := np.flatnonzero(to < hi)).size:
        to[inside] = to[to[inside] - lo]
    return to


def entries(stream, begin: int, length: int, little: bool, lead: int) -> np.ndarray:
    """Offsets at or after ``begin`` where its first record can start; the true one is among them."""
    base = max(0, begin - lead)
    live = np.zeros(1, np.int64) if base == 0 else np.arange(min(LONGEST, length - base), dtype=np.int64)
    stop = begin - base
    stream.seek(base)
    data = bytes(stream.read(stop + 4))
    for lo in range(0, stop, STRETCH):
        hi = min(lo + STRETCH, stop)
        here = live[live < hi]
        if len(here) > FEW:
            moved = _step_all(data, base, lo, hi, length, little)[here - lo]
        else:
            moved = [_walk(data, int(p), hi, length - base, little)[0] for p in here]
        live = np.unique(np.r_[live[live >= hi], np.array(moved, np.int64)])
    # A record that starts before ``begin`` ends within its largest size.
    return base + live[live - stop < LONGEST]


def _walk(data: bytes, pos: int, stop: int, length: int, little: bool) -> tuple[int, int]:
    """Where a walk from ``pos`` leaves the bytes before ``stop``, and the whole records it passed."""
    low, high = (0, 1) if little else (1, 0)
    n = 0
    while pos < stop:
        if pos + 4 > length:
            return length, n
        pos += 4 + (data[pos + low] | data[pos + high] << 8)
        if pos > length:
            return length, n
        n += 1
    return pos, n


def exits(stream, starts: list[int], end: int, length: int, little: bool) -> list[tuple[int, int]]:
    """For each start: the first record at or after ``end`` on its walk, and the records before that one."""
    pos, n = list(starts), [0] * len(starts)
    # Walks that met: each follows its leader, some records ahead.
    leader, ahead = list(range(len(starts))), [0] * len(starts)
    at = min(starts)
    while at < end:
        # Short pieces while many walks are left: those that met are known at their ends.
        many = sum(leader[i] == i for i in range(len(starts))) > FEW
        stop = min(at + (STRETCH if many else CHUNK), end)
        stream.seek(at)
        data = bytes(stream.read(stop - at + 4))
        met: dict[int, int] = {}
        for i in range(len(starts)):
            if leader[i] == i:
                moved, passed = _walk(data, pos[i] - at, stop - at, length - at, little)
                pos[i], n[i] = moved + at, n[i] + passed
                first = met.setdefault(pos[i], i)
                if first != i:
                    leader[i], ahead[i] = first, n[i] - n[first]
        at = stop
    out = []
    for i in range(len(starts)):
        extra, j = 0, i
        while leader[j] != j:
            extra, j = extra + ahead[j], leader[j]
        out.append((pos[j], n[j] + extra))
    return out


_SCOUT = "path string, range bigint, entry bigint, exit bigint, n bigint"
_SCOUT_ARROW = pa.schema([("path", pa.string()), *[(c, pa.int64()) for c in ("range", "entry", "exit", "n")]])


def _scout(batches: Iterator[pa.RecordBatch], opener: Callable[[str], StoreFile], leads: tuple[int, ...] = LEADS) -> Iterator[pa.RecordBatch]:
    """Rows (range, entry, exit, n): the map of each range; one without an entry where too many walks are left."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            with opener(r["path"]) as stream:
                head = bytes(stream.read(6))
                starts: list[int] = []
                for lead in leads if is_far(head) else ():
                    if not 0 < len(starts) <= MOST:
                        starts = entries(stream, r["begin"], r["length"], byte_order(head), lead).tolist()
                if not 0 < len(starts) <= MOST:
                    rows.append({"path": r["path"], "range": r["range"]})
                    continue
                found = exits(stream, starts, r["end"], r["length"], byte_order(head))
            rows += [{"path": r["path"], "range": r["range"], "entry": e, "exit": x, "n": n} for e, (x, n) in zip(starts, found)]
        yield pa.RecordBatch.from_pylist(rows, _SCOUT_ARROW)


def _compose(maps: pd.DataFrame) -> pd.DataFrame:
    """Follow a file's maps from its start: the units to walk, each with the records before it."""
    steps = {(r.range, r.entry): (int(r.exit), int(r.n)) for r in maps.itertuples() if pd.notna(r.entry)}
    units, state, base = [], 0, 0
    for i in range(int(maps["range"].max()) + 1):
        found = steps.get((i, state))
        if found is None:
            units.append([state, None, base])
            break
        if found[1]:
            units.append([state, found[0], base])
        state, base = found[0], base + found[1]
    units = units or [[0, None, 0]]
    # The last one runs to the end of the file, so a cut-off record is seen.
    units[-1][1] = None
    out = pd.DataFrame(units, columns=["first", "stop", "base"]).astype("Int64")
    return out.assign(path=maps["path"].iloc[0])[["path", "first", "stop", "base"]]


def range_units(large: DataFrame, split_bytes: int = SPLIT_BYTES, opener: Callable[[str], StoreFile] = StoreFile) -> DataFrame:
    """Parts of unpacked files (path, length) to be walked by tasks of their own: path, first, stop, base.

    A file that does not start with FAR is one part. Where too many walks are left, which takes
    megabytes without two walks meeting, the file is one part from there on.
    """
    spark = large.sparkSession
    n_bytes = large.agg(F.sum("length")).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(n_bytes // SPLIT_BYTES, MOST_TASKS))
    ranges = (
        large.select("path", "length", F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / split_bytes))).alias("range"))
        .withColumn("begin", F.col("range") * split_bytes)
        .withColumn("end", F.least(F.col("begin") + split_bytes, F.col("length")))
        .repartition(n, "path", "range")
    )
    # A few rows per range, costly to make.
    maps = materialize(ranges.mapInArrow(lambda it: _scout(it, opener), _SCOUT))
    units = maps.groupBy("path").applyInPandas(_compose, "path string, first bigint, stop bigint, base bigint")
    return units.repartition(n, "path", "first")
