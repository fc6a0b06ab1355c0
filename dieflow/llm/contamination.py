"""Benchmark decontamination by template windows with slot checks."""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dieflow.llm.common import FILTER_BITS, Scratch, give_back, key_filter, without

# Template tokens of a window; words of its own that it must hold.
WINDOW, LITERAL = 8, 5
# An item is leaked where matched windows cover this share of it, or this many lie on one
# alignment (6 windows of 8 are 13 tokens in a row).
SHARE, RUN = 0.5, 6
CHARS, CACHE = 1 << 19, 150_000
TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?:\n]")
# Number words and units (English, German, French, Spanish).
NUMBER_WORDS = frozenset("""one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty sixty seventy eighty ninety
hundred thousand million billion half dozen zwei drei vier sechs sieben acht neun zehn hundert tausend deux trois quatre cinq sept huit neuf
dix cent mille dos tres cuatro cinco seis siete ocho nueve diez cien mil""".split())
UNITS = frozenset("""mm cm m km mg g kg t ml cl l s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years
inch inches foot feet ft yard yards mile miles mph kmh lb lbs pound pounds oz ounce ounces gallon gallons liter liters litre litres meter meters
metre metres kilometer kilometers gram grams kilogram kilograms ton tons cent cents dollar dollars euro euros usd eur percent degree degrees
stunde stunden tag tage jahr jahre meter heure heures jour jours an ans hora horas dia dias metro metros""".split())
BREAKS = frozenset(".!?:\n")
BREAK, NUMBER, UNIT, UPPER = 1, 2, 4, 8
_index: dict[str, int] = {}
_hash: list[int] = []
_kind: list[int] = []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


FACTORS = _mix(np.arange(3, WINDOW + 3, dtype=np.uint64)) | np.uint64(1)
NAME_HASH, NUMBER_HASH, UNIT_HASH = (np.uint64(xxhash.xxh3_64_intdigest(s)) for s in ("<name>", "<number>", "<unit>"))


def _learn(tokens: set[str]) -> None:
    if len(_index) + len(tokens) > CACHE:
        _index.clear(), _hash.clear(), _kind.clear()
    for t in tokens.difference(_index):
        low = t.lower()
        number = t[0].isdigit() or low in NUMBER_WORDS
        kind = BREAK if t in BREAKS else NUMBER * number + UNIT * (low in UNITS) + UPPER * t[0].isupper()
        _index[t] = len(_hash)
        _hash.append(xxhash.xxh3_64_intdigest(low))
        _kind.append(kind)


def template_windows(texts: list[str | None], lengths: list[int], wanted: np.ndarray | None) -> tuple[np.ndarray, ...]:
    """Windows of all texts: text number, position, length, hash, and the values in its slots.

    Numbers and units after numbers are placeholders in every window. A window with names
    (capitalised inside a sentence) is given twice, names as they are and as placeholders.
    ``wanted`` filters by hash. Windows shorter than WINDOW, for short items, need
    LITERAL words of their own too.
    """
    cut = [TOKEN.findall(t or "") for t in texts]
    _learn(set().union(*cut))
    count = [len(c) for c in cut]
    index = np.fromiter((_index[t] for c in cut for t in c), np.int64, sum(count))
    text = np.repeat(np.arange(len(texts)), count)
    kind, value = np.array(_kind, np.int8)[index], np.array(_hash, np.uint64)[index]
    # A token after a break, or first in its text, starts a sentence.
    first = np.r_[True, (kind[:-1] == BREAK) | (text[1:] != text[:-1])] if len(index) else np.zeros(0, bool)
    real = kind != BREAK
    place = np.flatnonzero(real)
    kind, value, text, first = kind[real], value[real], text[real], first[real]
    n = len(kind)
    before = np.cumsum(np.bincount(text, minlength=len(texts))) - np.bincount(text, minlength=len(texts))
    number = (kind & NUMBER) > 0
    unit = ((kind & UNIT) > 0) & ~number & np.r_[False, number[:-1]][:n] & np.r_[False, text[1:] == text[:-1]][:n]
    name = ((kind & UPPER) > 0) & ~first & ~number & ~unit
    plain = np.where(number, NUMBER_HASH, np.where(unit, UNIT_HASH, value))
    named = np.where(name, NAME_HASH, plain)
    found = []
    for length in lengths:
        m = n - length + 1
        if m <= 0:
            continue
        inside = text[:m] == text[length - 1:]
        for hashes, slot in ((plain, number | unit), (named, number | unit | name)):
            total = np.zeros(m, np.uint64)
            for k in range(length):
                total += hashes[k:k + m] * FACTORS[k]
            total = _mix(total + np.uint64(length))
            filled = np.cumsum(np.r_[0, slot])
            ok = inside & (length - (filled[length:] - filled[:-length]) >= LITERAL)
            if slot is not None and hashes is named:
                names = np.cumsum(np.r_[0, name])
                ok &= names[length:] > names[:-length]
            if wanted is not None:
                ok &= wanted[total & np.uint64((1 << FILTER_BITS) - 1)]
            at = np.flatnonzero(ok)
            values = [[cut[text[i]][place[j] - sum_before] for j in range(i, i + length) if slot[j]] for i, sum_before in zip(at, _starts(count)[text[at]])]
            found.append((text[at], at - before[text[at]], np.full(len(at), length), total[at], [[v.lower() for v in vs] for vs in values]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.uint64), []
    return *(np.concatenate([f[i] for f in found]) for i in range(4)), [v for f in found for v in f[4]]


def _starts(count: list[int]) -> np.ndarray:
    return np.cumsum(count) - np.array(count)


WINDOWS = "key long, pos int, length int, hash long, slots array<string>"


def _windows(lengths: list[int], shared=None):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = None if shared is None else np.unpackbits(np.frombuffer(shared.value, np.uint8), bitorder="little").astype(bool)
        for frame in frames:
            texts, keys = frame["text"].tolist(), frame["key"].to_numpy()
            lo = size = 0
            for i, t in enumerate(texts):
                size += len(t or "")
                if size >= CHARS or i == len(texts) - 1:
                    text, pos, length, value, slots = template_windows(texts[lo:i + 1], lengths, wanted)
                    if len(text):
                        yield pd.DataFrame({"key": keys[lo + text], "pos": pos, "length": length, "hash": value.view(np.int64), "slots": slots})
                    lo, size = i + 1, 0
        give_back()

    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, contaminated, item_ids (sorted), coverage (largest share of one item found).

    Texts become templates: words in lower case, numbers, units and names as typed
    placeholders, punctuation ignored. Windows of 8 template tokens are joined by hash. On one
    alignment of document and item, an item's slot value must stand for one value in the
    document everywhere; windows with a slot that breaks this do not count. Items of 5 to 7
    tokens are one window; shorter ones, and windows with fewer than 5 words of their own,
    are not searched. Names written as they are match in any letter case.

    The benchmark may have any size: a filter of fixed size over its windows thins the
    documents' windows inside the scan, and what passes is joined exactly.

    NULL and empty texts are clean; NULL or empty items match nothing; items with equal texts
    are all reported. Decisions depend on the text, so rows with NULL or repeated ids
    each get their own. Empty tables give no rows, or clean ones. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "contamination")
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")).withColumn("key", F.xxhash64("text"))
    items = benchmark.select(F.col(item_column).cast("bigint").alias("key"), F.col(item_text_column).alias("text"))
    # All lengths a short item can have; windows of an item are its longest possible ones.
    lengths = list(range(LITERAL, WINDOW + 1))
    cut = items.filter("key is not null").mapInPandas(_windows(lengths), WINDOWS).withColumnRenamed("key", "item_id")
    longest = cut.groupBy("item_id").agg(F.max("length").alias("length"))
    cut = scratch.keep(cut.join(longest, ["item_id", "length"]), "items")
    sizes = cut.groupBy("item_id").agg(F.count_distinct("pos").alias("n_windows"))
    used = [r[0] for r in cut.select("length").distinct().collect()]
    shared = key_filter(cut, "hash")
    passed = rows.select("key", "text").mapInPandas(_windows(sorted(used), shared), WINDOWS)
    ours = cut.select("item_id", "length", "hash", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"))
    # Copies of a text have equal windows.
    hits = scratch.keep(passed.join(ours, ["hash", "length"]).distinct().withColumn("line", F.col("pos") - F.col("item_pos")), "hits")
    pairs = hits.select("key", "item_id", "line", F.explode(F.arrays_zip("item_slots", "slots")).alias("p"))
    broken = pairs.groupBy("key", "item_id", "line", F.col("p.item_slots").alias("slot")).agg(
        F.min("p.slots").alias("a"), F.max("p.slots").alias("b")
    ).filter("a <> b").groupBy("key", "item_id", "line").agg(F.collect_set("slot").alias("broken"))
    good = hits.join(broken, ["key", "item_id", "line"], "left").filter("broken is null or not arrays_overlap(item_slots, broken)")
    runs = good.groupBy("key", "item_id", "line").agg(F.count_distinct("item_pos").alias("run")).groupBy("key", "item_id").agg(F.max("run").alias("run"))
    covered = good.groupBy("key", "item_id").agg(F.count_distinct("item_pos").alias("n")).join(sizes, "item_id").join(runs, ["key", "item_id"])
    share = F.col("n") / F.col("n_windows")
    leaks = covered.filter((share >= SHARE) | (F.col("run") >= RUN)).groupBy("key").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max(share).alias("coverage")
    )
    leaks = scratch.keep(leaks, "leaks")
    scratch.drop(hits, cut)
    out = rows.select("doc_id", "key").join(leaks, "key", "left")
    return out.select(
        "doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
        F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item; all columns stay."""
    found = contamination(docs.select(F.xxhash64("text").alias("doc_id"), "text"), benchmark).filter("contaminated").select(F.col("doc_id").alias("_key")).distinct()
    return without(docs.withColumn("_key", F.xxhash64("text")), found, "_key").drop("_key")
