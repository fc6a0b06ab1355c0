"""Line dedup: repeated runs of lines by prefix doubling over line ids."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dieflow.llm.common import Scratch, narrowed
from dieflow.operators.numbering import number_all

# A repeated run of lines goes if it has this many words.
WORDS = 20


def _windows(words_least: int):
    """Shortest runs with enough words: from each line on, and up to each line, inside stretches of repeated lines."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for k, doc_id, lines in zip(frame["k"], frame["doc"], frame["lines"]):
                line = np.array([x["line"] for x in lines], np.int64)
                upto = np.cumsum([x["words"] for x in lines])
                before = upto - [x["words"] for x in lines]
                stretch = line - np.arange(len(line))
                # First line at which enough words are together, and last line from which they are.
                stop = np.searchsorted(upto, before + words_least)
                start = np.searchsorted(before, upto - words_least, side="right") - 1
                at = np.arange(len(line))
                pairs = np.concatenate([np.stack([at, stop], 1)[stop < len(line)], np.stack([start, at], 1)[start >= 0]])
                pairs = np.unique(pairs[stretch[pairs[:, 0]] == stretch[pairs[:, 1]]], axis=0)
                out.append(pd.DataFrame({"k": k, "doc": doc_id, "line": line[pairs[:, 0]], "n": pairs[:, 1] - pairs[:, 0] + 1}))
            yield pd.concat(out)

    return run


def repeated_runs(docs: DataFrame, scratch: Scratch, words: int = WORDS) -> DataFrame:
    """(k, runs): for each document key the runs (line, n) that occur earlier, too. ``docs`` has doc (text), order, k, text."""
    lines = docs.select("k", "doc", F.posexplode(F.split("text", "\n")).alias("line", "content"))
    lines = lines.select("k", "doc", F.col("line").cast("bigint"), F.xxhash64("content").alias("h"), F.regexp_count("content", F.lit(r"\S+")).alias("words"))
    spot = F.struct("k", "line")
    twice = lines.groupBy("h").agg(F.min(spot).alias("a"), F.max(spot).alias("b")).filter("a <> b").select("h")
    ids = scratch.keep(number_all(twice, ["h"], "rank"), "ids")
    placed = scratch.keep(lines.join(ids, "h").select("k", "doc", "line", "words", "rank").dropDuplicates(["k", "line"]), "places")
    stretches = placed.groupBy("k", "doc").agg(F.array_sort(F.collect_list(F.struct("line", "words"))).alias("lines"))
    windows = stretches.mapInPandas(_windows(words), "k long, doc string, line long, n long")
    windows = scratch.keep(windows.withColumn("level", F.floor(F.log2("n")).cast("int")), "windows")
    most = windows.agg(F.max("level")).first()[0]
    out, ranks = None, placed.select("k", "line", "rank")
    for level in range(0 if most is None else most + 1):
        if level:
            # Ranks of runs twice as long: pairs of ranks, sorted and numbered. A run that occurs once drops out.
            ahead = ranks.select("k", (F.col("line") - (1 << level - 1)).alias("line"), F.col("rank").alias("next"))
            pairs = scratch.keep(ranks.join(ahead, ["k", "line"]), "pairs")
            known = pairs.groupBy("rank", "next").agg(F.count("*").alias("n")).filter("n > 1").select("rank", "next")
            known = number_all(known, ["rank", "next"], "new")
            longer = scratch.keep(pairs.join(known, ["rank", "next"]).select("k", "line", F.col("new").alias("rank")), "ranks")
            scratch.drop(pairs, ranks)
            ranks = longer
        # A run of n lines is named by the ranks of its first and its last 2^level lines: suffixes with
        # one name form an interval whose common prefix has n lines or more.
        of_level = windows.filter(F.col("level") == level)
        tail = ranks.select("k", F.col("line").alias("at"), F.col("rank").alias("last"))
        named = of_level.join(ranks, ["k", "line"]).withColumn("at", F.col("line") + F.col("n") - (1 << level)).join(tail, ["k", "at"])
        named = scratch.keep(named.select("k", "doc", "line", "n", F.col("rank").alias("first"), "last"), "named")
        place = F.struct(F.col("doc").cast("bigint").alias("d"), "doc", "k", "line")
        earliest = named.groupBy("n", "first", "last").agg(F.min(place).alias("earliest"), F.count("*").alias("size")).filter("size > 1")
        later = named.join(earliest, ["n", "first", "last"]).filter(place != F.col("earliest")).select("k", "line", "n")
        out = later if out is None else out.unionByName(later)
    if out is None:
        out = windows.select("k", "line", "n").limit(0)
    runs = scratch.keep(out.groupBy("k").agg(F.collect_list(F.struct("line", "n")).alias("runs")), "runs")
    scratch.drop(ids, placed, windows)
    return runs


def _without(text: pd.Series, runs: pd.Series) -> pd.DataFrame:
    out = []
    for t, found in zip(text, runs):
        lines = t.split("\n")
        gone = np.zeros(len(lines) + 1, np.int64)
        if found is not None:
            np.add.at(gone, [r["line"] for r in found], 1)
            np.add.at(gone, [r["line"] + r["n"] for r in found], -1)
        gone = np.cumsum(gone[:-1]) > 0
        out.append(("\n".join(x for x, g in zip(lines, gone) if not g), int(gone.sum())))
    return pd.DataFrame(out, columns=["text", "n_removed"])


def dedup_lines(docs: DataFrame, words: int = WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents with later copies of repeated line runs deleted, and a struct ``line_dedup`` (n_lines, n_removed).

    A line goes if it lies in a run of lines with at least ``words`` words in all that
    also occurs earlier: in a document with a smaller id, or further up in the same one.
    Copies may overlap. Documents of one id are ordered by a hash of their text. Ranks by
    prefix doubling sort runs of 1, 2, 4, ... lines; only lines that occur twice take part,
    and ranks go as far as the longest run needed to reach ``words`` words.

    NULL and empty texts have no lines and stay as they are; NULL ids come before others;
    rows equal in id and text are one document, and each gets its result. An empty table
    gives an empty one. Extra columns stay; one named ``line_dedup`` is replaced.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    name, text = F.col(id_column).cast("string"), F.coalesce(F.col(text_column), F.lit(""))
    keyed = docs.withColumn("_k", F.xxhash64(name, text))
    runs = repeated_runs(keyed.select(F.col("_k").alias("k"), name.alias("doc"), text.alias("text")).filter("text <> ''"), scratch, words)
    n_lines = F.when(text == "", 0).otherwise(F.size(F.split(text, "\n"))).cast("bigint")
    some, rest = narrowed(keyed, runs.select(F.col("k").alias("_k")), "_k")
    cut = some.join(runs.withColumnRenamed("k", "_k").withColumnRenamed("runs", "_runs"), "_k", "left")
    cut = cut.withColumn("_cut", F.pandas_udf(_without, "text string, n_removed long")(text, "_runs"))
    hit = F.col("_runs").isNotNull()
    cut = cut.withColumn("line_dedup", F.struct(n_lines.alias("n_lines"), F.when(hit, F.col("_cut.n_removed")).otherwise(F.lit(0).cast("bigint")).alias("n_removed")))
    cut = cut.withColumn(text_column, F.when(hit, F.col("_cut.text")).otherwise(F.col(text_column))).drop("_k", "_runs", "_cut")
    rest = rest.withColumn("line_dedup", F.struct(n_lines.alias("n_lines"), F.lit(0).cast("bigint").alias("n_removed"))).drop("_k")
    return cut.unionByName(rest)
