"""Removal of repeated strings by a content-defined difference cover.

Every string of LENGTH bytes holds a sampled position: the one whose following GRAM bytes
hash lowest among those that fit. Like the residues of a difference cover the sample lets
any two suffixes be compared at the same offset, but equal strings have it at the same
place, so suffixes that hang on different samples never need comparing, and only samples
are sorted and grouped, not every suffix. Names stand for whole contexts of a sample; where
a name is shared all its strings repeat, and only contexts that differ are merged string by
string.
"""
from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dieflow.llm.common import Scratch, narrowed

LENGTH, GRAM = 400, 256
# Bytes handled together; longer texts are cut into parts that overlap by one string.
CHUNK = 1 << 20
PLACE_BITS = 24
BASE = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    n = CHUNK + 2 * LENGTH
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


class Hashes:
    """Polynomial hashes of any part of a byte buffer."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = _powers()
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.sums[stop] - self.sums[start]) * self.inverse[start])

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mix((self.sums[size:] - self.sums[:n]) * self.inverse[:n])


def samples(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[Hashes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the buffer; sampled positions, the first and last string start that hangs on each, and names of their grams."""
    hashes = Hashes(data)
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return hashes, none, none, none, none.astype(np.uint64)
    name = hashes.grams(gram)
    mask = np.uint64((1 << PLACE_BITS) - 1)
    least = (name & ~mask) | np.arange(len(name), dtype=np.uint64)
    width, size = length - gram + 1, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if width > size:
        least = np.minimum(least[:size - width], least[width - size:])
    place = (least & mask).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], len(place)] - 1
    return hashes, place[first], first, last, name[place[first]]


def _buffers(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Buffers of whole texts or overlapping parts of long ones: bytes, and for each part its text number, start in the buffer, start in the text."""
    parts, size = [], 0

    def joined():
        data = np.frombuffer(b"".join(texts[i][a:b] for i, a, b in parts), np.uint8)
        sizes = np.array([b - a for _, a, b in parts])
        return data, np.array([i for i, _, _ in parts]), np.cumsum(sizes) - sizes, np.array([a for _, a, _ in parts])

    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t) - LENGTH + 1), CHUNK):
            b = min(len(t), a + CHUNK + LENGTH - 1)
            if b - a < LENGTH:
                continue
            if size + b - a > CHUNK + LENGTH and parts:
                yield joined()
                parts, size = [], 0
            parts.append((i, a, b))
            size += b - a
    if parts:
        yield joined()


def _sampled(texts: list[bytes]) -> Iterator[tuple]:
    """For each buffer: hashes, and of every sample: text number, shift from buffer to text, position, first and last start, name.

    Strings that would cross from one text into the next are left out, so a sample's starts
    may be cut, the same way in every copy that ends there.
    """
    for data, number, begin, offset in _buffers(texts):
        hashes, place, first, last, name = samples(data)
        end = np.r_[begin[1:], len(data)]
        # Starts of one sample lie in consecutive texts at most where it is cut.
        part = np.searchsorted(begin, place, side="right") - 1
        first, last = np.maximum(first, begin[part]), np.minimum(last, end[part] - LENGTH)
        ok = (first <= last) & (place + GRAM <= end[part])
        yield hashes, number[part[ok]], (offset - begin)[part[ok]], place[ok], first[ok], last[ok], name[ok]


def _mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Samples of each text: v, position, name of the gram there."""
    for frame in frames:
        keys = frame["v"].to_numpy()
        for _, number, shift, place, _, _, name in _sampled([t.encode() for t in frame["text"]]):
            yield pd.DataFrame({"v": keys[number], "pos": place + shift, "gram": name.view(np.int64)})


def _contexts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of the samples asked for, the name of the whole text that their strings span, and those strings' starts."""
    for frame in frames:
        keys, asked = frame["v"].to_numpy(), frame["at"].tolist()
        for hashes, number, shift, place, first, last, name in _sampled([t.encode() for t in frame["text"]]):
            keep = _asked(number, place + shift, asked)
            number, shift, place, first, last, name = (x[keep] for x in (number, shift, place, first, last, name))
            whole = hashes.of(first, last + LENGTH)
            context = _mix(whole + (place - first).astype(np.uint64) * np.uint64(BASE) + (last - first).astype(np.uint64))
            yield pd.DataFrame({
                "v": keys[number], "pos": place + shift, "gram": name.view(np.int64), "context": context.view(np.int64),
                "first": first + shift, "last": last + shift,
            })


def _strings(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of the samples asked for, a name for each string that hangs on them."""
    for frame in frames:
        keys, asked = frame["v"].to_numpy(), frame["at"].tolist()
        for hashes, number, shift, place, first, last, _ in _sampled([t.encode() for t in frame["text"]]):
            keep = _asked(number, place + shift, asked)
            number, shift, place, first, last = (x[keep] for x in (number, shift, place, first, last))
            count = last - first + 1
            start = np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
            name = hashes.of(start, start + LENGTH)
            yield pd.DataFrame({"v": np.repeat(keys[number], count), "pos": np.repeat(place + shift, count), "start": start + np.repeat(shift, count), "name": name.view(np.int64)})


def _asked(number: np.ndarray, pos: np.ndarray, asked: list) -> np.ndarray:
    """Which (text number, position) pairs are in the texts' lists."""
    sizes = [len(a) for a in asked]
    wanted = np.repeat(np.arange(len(asked)), sizes) << 40 | np.concatenate([np.asarray(a, np.int64) for a in asked])
    return np.isin(number.astype(np.int64) << 40 | pos, wanted)


def repeated_strings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (array of start, stop).

    A byte goes where a string of 400 bytes that covers it starts anywhere else as well, in
    another document or this one; strings do not cross documents and are judged on the
    input. Spans are maximal removed runs.

    NULL and empty texts have 0 bytes and nothing removed; texts under 400 bytes lose
    nothing. Copies of a text count as elsewhere, so a text of 400 bytes or more that occurs
    twice goes whole. Rows with NULL or repeated ids each give a row, decided by their
    text. An empty table gives none. Other columns are not read. Names are 64-bit hashes.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")).withColumn("v", F.xxhash64("text"))
    long = rows.filter(F.octet_length("text") >= LENGTH)
    # One row stands for each text: the first id of a partial minimum per task.
    texts = long.select("v", "text")
    copies = scratch.keep(long.groupBy("v").agg(F.count("*").alias("copies")).filter("copies > 1").select("v"), "copies")

    marks = scratch.keep(texts.mapInPandas(_mark, "v long, pos long, gram long"), "marks")
    spot = F.struct("v", "pos")
    twice = marks.groupBy("gram").agg(F.min(spot).alias("a"), F.max(spot).alias("b")).filter("a <> b").select("gram")
    asked = marks.join(twice, "gram").groupBy("v").agg(F.collect_set("pos").alias("at"))
    asked = scratch.keep(asked, "asked")
    scratch.drop(marks)
    contexts = narrowed(texts, asked, "v")[0].dropDuplicates(["v"]).join(asked, "v")
    contexts = scratch.keep(
        contexts.select("v", "text", "at").mapInPandas(_contexts, "v long, pos long, gram long, context long, first long, last long"), "contexts"
    )
    named = scratch.keep(contexts.groupBy("gram", "context").agg(F.count("*").alias("size"), F.min(spot).alias("one")), "named")
    shared = contexts.join(named.filter("size > 1").select("context", "gram"), ["gram", "context"]).select("v", "first", "last")
    # Grams with several contexts: strings of one of each context are compared.
    mixed = named.groupBy("gram").agg(F.min("context").alias("a"), F.max("context").alias("b")).filter("a <> b").select("gram")
    ones = named.join(mixed, "gram").select("one.v", "one.pos").groupBy("v").agg(F.collect_set("pos").alias("at"))
    ones = scratch.keep(ones, "ones")
    strings = narrowed(texts, ones, "v")[0].dropDuplicates(["v"]).join(ones, "v").select("v", "text", "at")
    strings = scratch.keep(strings.mapInPandas(_strings, "v long, pos long, start long, name long"), "strings")
    again = strings.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1").select("name")
    # A string found in two contexts; contexts of several samples are known to repeat already.
    found = strings.join(again, "name").select("v", F.col("start").alias("first"), F.col("start").alias("last"))
    runs = shared.unionByName(found).groupBy("v").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    runs = runs.join(copies.withColumn("whole", F.lit(True)), "v", "full").select("v", "runs", F.coalesce("whole", F.lit(False)).alias("whole"))
    runs = scratch.keep(runs, "runs")
    scratch.drop(contexts, named, asked, ones, strings, copies)

    some, rest = narrowed(rows.withColumn("id", F.col("doc_id").cast("string")).drop("doc_id"), runs, "v")
    cut = some.join(runs, "v", "left").select("id", "text", "runs", F.coalesce("whole", F.lit(False)).alias("whole"))
    spans = "array<struct<start:bigint,stop:bigint>>"
    cut = cut.mapInPandas(_removed, f"id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans {spans}")
    none = rest.select(
        "id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_removed"), F.lit(0).cast("bigint").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"), F.array().cast(spans).alias("spans"),
    )
    kind = docs.schema[id_column].dataType
    out = cut.unionByName(none).select(F.col("id").cast(kind).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
    out = scratch.keep(out, "result")
    scratch.drop(runs)
    return out


def _removed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for name, text, runs, whole in zip(frame["id"], frame["text"], frame["runs"], frame["whole"]):
            data = np.frombuffer(text.encode(), np.uint8)
            edge = np.zeros(len(data) + 1, np.int64)
            if whole:
                edge[[0, -1]] = 1, -1
            if runs is not None and len(runs):
                np.add.at(edge, [r["first"] for r in runs], 1)
                np.add.at(edge, [r["last"] + LENGTH for r in runs], -1)
            gone = np.cumsum(edge[:-1]) > 0
            change = np.diff(np.r_[0, gone.astype(np.int8), 0])
            start, stop = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
            kept = hashlib.sha256(data[~gone].tobytes()).hexdigest()
            out.append((name, len(data), int(gone.sum()), len(start), kept, [{"start": a, "stop": b} for a, b in zip(start.tolist(), stop.tolist())]))
        yield pd.DataFrame(out, columns=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])
