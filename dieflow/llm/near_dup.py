"""Near-duplicates: MinHash signatures in a multi-index Hamming join, links confirmed on full shingle sets."""
from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dieflow.llm.common import Scratch, give_back
from dieflow.llm.components import components

WORDS = 5
# A signature has CHUNKS x WIDTH values of 16 bits; a chunk may differ in ERRORS values. By
# pigeonhole every pair that differs in fewer than CHUNKS x (ERRORS + 1) = 24 of the 60 values
# meets in a bucket. Of pairs at similarity 0.75 six in a million meet in none, above it fewer.
CHUNKS, WIDTH, ERRORS = 12, 5, 1
VALUES = CHUNKS * WIDTH
# Pairs in one bucket whose signatures differ in more values than this are not compared in full
# (at similarity 0.75: one in fifty million).
FAR = 33
# Members compared as one block.
BLOCK = 256
# Shingles of the members whose pairs are confirmed together, and number of these pairs.
HELD, PAIRS = 1 << 21, 1 << 20
# Characters of text handled together.
CHARS = 1 << 19
CACHE = 150_000


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbers(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit numbers, the same on every machine."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


FACTORS = _numbers(WORDS, 11)
ADD, TIMES = _numbers(VALUES, 23), _numbers(VALUES, 37)
_known: dict[bytes, int] = {}


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Each text's set of shingles as sorted 64-bit hashes.

    Words are what lies between ASCII white space, A-Z in lower case. A text of fewer than
    five words has its whole sequence as one shingle; one without words has none.
    """
    words = [(t or "").encode().lower().split() for t in texts]
    new = set().union(*words)
    if len(_known) + len(new) > CACHE:
        _known.clear()
    for w in new.difference(_known):
        _known[w] = xxhash.xxh3_64_intdigest(w)
    sizes = [len(w) for w in words]
    h = np.fromiter(map(_known.__getitem__, chain.from_iterable(words)), np.uint64, sum(sizes))
    n = max(0, len(h) - WORDS + 1)
    runs = np.zeros(n, np.uint64)
    for k in range(WORDS):
        runs += h[k:k + n] * FACTORS[k]
    runs = mix(runs)
    out, at = [], 0
    for size in sizes:
        if size >= WORDS:
            out.append(np.unique(runs[at:at + size - WORDS + 1]))
        elif size:
            short = (h[at:at + size] * FACTORS[:size]).sum(dtype=np.uint64)
            out.append(mix(np.array([short + np.uint64(size)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += size
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """VALUES 16-bit values per non-empty set: for each hash function, bits of the smallest hash."""
    flat = np.concatenate(sets)
    start = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.empty((len(sets), VALUES), np.uint16)
    for k in range(VALUES):
        out[:, k] = np.minimum.reduceat((flat ^ ADD[k]) * TIMES[k] >> np.uint64(8), start) & np.uint64(0xFFFF)
    return out


@functools.lru_cache(maxsize=1)
def _masks() -> list[tuple[int, list[int]]]:
    """Which values make each key: every chunk with one value left out."""
    return [(c * WIDTH + skip, [c * WIDTH + k for k in range(WIDTH) if k != skip]) for c in range(CHUNKS) for skip in range(WIDTH)]


def bucket_keys(signature: np.ndarray) -> np.ndarray:
    """The keys of each signature, one per chunk and allowed error; equal keys have equal values."""
    out = np.empty((len(signature), VALUES), np.uint64)
    wide = signature.astype(np.uint64)
    for k, (name, kept) in enumerate(_masks()):
        packed = np.zeros(len(wide), np.uint64)
        for v in kept:
            packed = packed << np.uint64(16) | wide[:, v]
        out[:, k] = mix(packed ^ ADD[name])
    return out.view(np.int64)


def _blocks(texts: list[str | None]) -> Iterator[slice]:
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHARS:
            yield slice(lo, i + 1)
            lo, size = i + 1, 0
    if lo < len(texts):
        yield slice(lo, len(texts))


def _describe(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for part in _blocks(frame["text"].tolist()):
            rows = frame.iloc[part]
            sets = shingle_sets(rows["text"].tolist())
            n = np.array([len(s) for s in sets])
            full = [s for s in sets if len(s)]
            v = np.full(len(sets), 0, np.int64)
            v[n > 0] = [_fingerprint(s) for s in full]
            sig = np.full(len(sets), None, object)
            if full:
                sig[n > 0] = [x.tobytes() for x in signatures(full)]
            yield pd.DataFrame({"doc_id": rows["doc_id"], "void": rows["void"], "v": pd.Series(v, rows.index), "n": n, "sig": sig})
    give_back()


def _fingerprint(s: np.ndarray) -> int:
    """One number for a whole set."""
    return int(mix(np.array([mix(s + np.uint64(7)).sum(dtype=np.uint64) + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def _sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for part in _blocks(frame["text"].tolist()):
            sets = [s for s in shingle_sets(frame["text"].iloc[part].tolist()) if len(s)]
            yield pd.DataFrame({"v": np.array([_fingerprint(s) for s in sets], np.int64), "shingles": [s.tobytes() for s in sets]})
    give_back()


def _shared(a: pd.Series, b: pd.Series) -> pd.Series:
    """Shingles that two sets share."""
    both = zip(a, b)
    return pd.Series([len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), True)) for x, y in both], dtype="int64")


def _keys(sig: pd.Series) -> pd.Series:
    if not len(sig):
        return pd.Series([], dtype=object)
    return pd.Series(list(bucket_keys(np.frombuffer(b"".join(sig), np.uint16).reshape(-1, VALUES))))


def _differing(a: pd.Series, b: pd.Series) -> pd.Series:
    """Values in which two signatures differ."""
    x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(-1, VALUES) for s in (a, b))
    return pd.Series((x != y).sum(1), dtype="int32")


def _close(similar: int):
    """Pairs of two blocks of a bucket that lie in different components, are of fitting size and have close signatures.

    A pair counts in the bucket of its smallest common key only. The pairs of many blocks make one
    row, with each member once: at most PAIRS pairs, and HELD shingles unless one pair has more.
    """

    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = _Group()
        for frame in frames:
            for key, xs, ys, same in zip(frame["key"], frame["xs"], frame["ys"], frame["same"]):
                v, comp, n, sig = _columns(xs)
                w, other, m, sig2 = _columns(ys)
                keys, keys2 = bucket_keys(sig), bucket_keys(sig2)
                for i in range(len(v)):
                    ok = (other != comp[i]) & (100 * np.minimum(m, n[i]) >= similar * np.maximum(m, n[i]))
                    if same:
                        ok[:i + 1] = False
                    at = np.flatnonzero(ok)
                    at = at[(sig2[at] != sig[i]).sum(1) <= FAR]
                    at = at[np.where(keys2[at] == keys[i], keys2[at], np.iinfo(np.int64).max).min(1) == key]
                    for part in np.split(at, np.flatnonzero(np.diff(np.cumsum(m[at]) // HELD)) + 1) if len(at) else ():
                        if group.full(n[i] + m[part].sum(), len(part)):
                            yield group.row()
                            group = _Group()
                        group.add((v[i], comp[i], n[i]), (w[part], other[part], m[part]))
        if group.a:
            yield group.row()

    return pairs


class _Group:
    """Pairs that are confirmed together, as places in a list of members."""

    def __init__(self):
        self.place, self.comps, self.a, self.b, self.pairs, self.held = {}, [], [], [], 0, 0

    def full(self, shingles: int, pairs: int) -> bool:
        return bool(self.a) and (self.held + shingles > HELD or self.pairs + pairs > PAIRS)

    def _at(self, v: int, comp: int, n: int) -> int:
        at = self.place.setdefault(v, len(self.comps))
        if at == len(self.comps):
            self.comps.append(comp)
            self.held += n
        return at

    def add(self, one: tuple, others: tuple) -> None:
        at = self._at(*map(int, one))
        found = [self._at(*x) for x in zip(*(c.tolist() for c in others))]
        self.a.append(np.full(len(found), at, np.uint32))
        self.b.append(np.array(found, np.uint32))
        self.pairs += len(found)

    def row(self) -> pd.DataFrame:
        both = np.stack([np.concatenate(self.a), np.concatenate(self.b)])
        return pd.DataFrame({"id": [uuid.uuid4().hex], "members": [list(self.place)], "comps": [self.comps], "pairs": [both.tobytes()]})


def _links(similar: int):
    """Links among a group's pairs, by full sets; a pair whose components were joined by a link before is passed over."""

    def links(sets: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
        found = {v: np.frombuffer(s, np.uint64) for v, s in zip(sets["v"], sets["shingles"])}
        out = []
        for members, comps, pairs in zip(group["members"], group["comps"], group["pairs"]):
            members, comps, top = members.tolist(), comps.tolist(), {}

            def root(c):
                while c in top:
                    top[c] = c = top.get(top[c], top[c])
                return c

            for i, j in np.frombuffer(pairs, np.uint32).reshape(2, -1).T.tolist():
                one, two = root(comps[i]), root(comps[j])
                if one == two:
                    continue
                x, y = found[members[i]], found[members[j]]
                shared = len(np.intersect1d(x, y, True))
                if 100 * shared >= similar * (len(x) + len(y) - shared):
                    top[one] = two
                    out.append((members[i], members[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return links


def _columns(members) -> tuple[np.ndarray, ...]:
    numbers = [np.array([m[k] for m in members], np.int64) for k in ("v", "comp", "n")]
    return *numbers, np.frombuffer(b"".join(m["sig"] for m in members), np.uint16).reshape(-1, VALUES)


def near_duplicates(
    docs: DataFrame, similar: int = 75, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable over links), kept.

    Documents are linked where 100 x shared shingles >= ``similar`` x shingles of both together.
    Texts with equal sets become one vertex first. A bucket's members are compared with one
    leader each, and components formed; only then are members of a bucket that still lie in
    different components compared with each other, in blocks, by signature. Pairs that stay
    close are not made into rows: they travel as places in lists of members, and the members'
    full sets meet them there. So a group of n near copies costs about n comparisons, texts
    alike but not linked cost rows by their members, and no link between components goes untested.

    Texts that are NULL, empty or without words have no shingles and link with nothing. Rows
    sharing an id count as one document with the links of all its texts; each gives a row.
    Rows with a NULL id are returned unlinked (component NULL, kept). An empty table gives an
    empty result; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "near")
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    marked = rows.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("void"), "text")
    described = scratch.keep(marked.mapInPandas(_describe, "doc_id long, void boolean, v long, n long, sig binary"), "described")
    full = described.filter("n > 0 and not void")
    vertices = scratch.keep(
        full.groupBy("v").agg(F.min("doc_id").alias("rep"), F.any_value("n").alias("n"), F.any_value("sig").alias("sig")), "vertices"
    )
    entries = vertices.select("v", F.explode(F.pandas_udf(_keys, "array<bigint>")("sig")).alias("key"))
    buckets = entries.groupBy("key").agg(
        F.count("*").alias("size"), F.min("v").alias("leader"), F.max("v").alias("last"),
        F.sum(F.xxhash64("v").cast("decimal(38,0)")).alias("members"),
    ).filter("size > 1")
    # Buckets with the same members are one bucket.
    buckets = scratch.keep(
        buckets.groupBy("members", "size").agg(F.min("key").alias("key"), F.any_value("leader").alias("leader"), F.any_value("last").alias("last")),
        "buckets",
    )
    big = scratch.keep(entries.join(buckets.filter("size > 2").select("key", "leader", "size"), "key"), "members")
    stars = buckets.filter("size = 2").select(F.col("leader").alias("a"), F.col("last").alias("b")).unionByName(
        big.filter("v != leader").select(F.col("leader").alias("a"), F.col("v").alias("b"))
    )
    sizes = vertices.select("v", "n", "sig")
    tried = scratch.keep(_near(stars.distinct(), sizes, similar), "tried")
    links = _confirmed(rows, vertices, tried, similar, scratch)
    # Rows that share an id are one document.
    shared = full.groupBy("doc_id").agg(F.min("v").alias("a"), F.max("v").alias("b")).filter("a < b")
    shared = full.join(shared.select("doc_id", "a"), "doc_id").select("a", F.col("v").alias("b"))
    first = scratch.keep(components(links.unionByName(shared), scratch), "components")

    comp = F.coalesce("component", "v").alias("comp")
    members = big.join(first, "v", "left").select("key", "v", "leader", "size", comp)
    mixed = members.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high").select("key")
    # The leader has met every member already.
    left = members.filter("v != leader").join(mixed, "key").join(sizes, "v")
    block = F.pmod(F.xxhash64("v"), F.ceil(F.col("size") / BLOCK).cast("bigint"))
    blocks = left.groupBy("leader", "key", block.alias("block")).agg(F.collect_list(F.struct("v", "comp", "n", "sig")).alias("xs"))
    blocks = scratch.keep(blocks, "blocks")
    others = blocks.select("key", F.col("block").alias("other"), F.col("xs").alias("ys"))
    # Buckets with one leader share members, so they go to the same tasks.
    tasks = 4 * docs.sparkSession.sparkContext.defaultParallelism
    pairs = blocks.join(others, "key").filter("block <= other").repartitionByRange(tasks, "leader", "key", "block", "other")
    pairs = pairs.select("key", (F.col("block") == F.col("other")).alias("same"), "xs", "ys")
    groups = scratch.keep(pairs.mapInPandas(_close(similar), "id string, members array<bigint>, comps array<bigint>, pairs binary"), "groups")
    members = groups.select(F.col("id").alias("group"), F.explode("members").alias("v"))
    sets = _sets_of(rows, vertices, members.select("v").distinct(), scratch)
    left, right = members.join(sets, "v").repartition(tasks, "group").groupBy("group"), groups.repartition(tasks, "id").groupBy("id")
    second = scratch.keep(left.cogroup(right).applyInPandas(_links(similar), "a long, b long"), "second")
    scratch.drop(sets)
    name = first.select(F.col("v").alias("x"), "component")
    joined = second.join(name.withColumnsRenamed({"x": "a", "component": "ca"}), "a", "left").join(
        name.withColumnsRenamed({"x": "b", "component": "cb"}), "b", "left"
    ).select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    merged = scratch.keep(components(joined, scratch), "merged")

    place = vertices.select("v", "rep").join(first, "v", "left").withColumn("c", F.coalesce("component", "v"))
    place = place.join(merged.select(F.col("v").alias("c"), F.col("component").alias("top")), "c", "left")
    place = place.select("v", "rep", F.coalesce("top", "c").alias("c"))
    lowest = place.groupBy("c").agg(F.min("rep").alias("component_id"))
    place = scratch.keep(place.join(lowest, "c").select("v", "component_id"), "places")
    linked = F.when((F.col("n") > 0) & ~F.col("void"), F.col("v")).alias("v")
    out = described.select(F.when(~F.col("void"), F.col("doc_id")).alias("doc_id"), linked, F.col("n").alias("n_shingles"))
    out = out.join(place, "v", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = scratch.keep(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), "result")
    scratch.drop(described, vertices, buckets, big, tried, first, blocks, groups, second, merged, place)
    return out


def _near(pairs: DataFrame, sizes: DataFrame, similar: int) -> DataFrame:
    """Pairs of fitting set size whose signatures are close enough."""
    side = lambda k: sizes.select(F.col("v").alias(k), F.col("n").alias(f"n_{k}"), F.col("sig").alias(f"sig_{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.filter(100 * F.least("n_a", "n_b") >= similar * F.greatest("n_a", "n_b"))
    return both.filter(F.pandas_udf(_differing, "int")("sig_a", "sig_b") <= FAR).select("a", "b")


def _confirmed(rows: DataFrame, vertices: DataFrame, pairs: DataFrame, similar: int, scratch: Scratch) -> DataFrame:
    """The pairs that are links on full sets; only the texts of these pairs are cut again."""
    needed = pairs.select(F.col("a").alias("v")).unionByName(pairs.select(F.col("b").alias("v"))).distinct()
    sets = _sets_of(rows, vertices, needed, scratch)
    size = (F.length("shingles") / 8).cast("bigint")
    side = lambda k: sets.select(F.col("v").alias(k), F.col("shingles").alias(f"set_{k}"), size.alias(f"n_{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("shared", F.pandas_udf(_shared, "bigint")("set_a", "set_b"))
    links = both.filter(100 * F.col("shared") >= similar * (F.col("n_a") + F.col("n_b") - F.col("shared"))).select("a", "b")
    links = scratch.keep(links, "confirmed")
    scratch.drop(sets)
    return links


def _sets_of(rows: DataFrame, vertices: DataFrame, needed: DataFrame, scratch: Scratch) -> DataFrame:
    """The full sets of some vertices, cut again from their texts."""
    texts = rows.join(vertices.join(needed, "v", "left_semi").select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    return scratch.keep(texts.mapInPandas(_sets, "v long, shingles binary").dropDuplicates(["v"]), "sets")
