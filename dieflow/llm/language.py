"""Language of web pages: text likelihood, declared language, address suffix and host priors, combined by Bayes' rule."""
from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dieflow.llm.common import Scratch

# Buckets of hashed character trigrams; a model has one row of them per language.
BUCKETS = 1 << 15
GRAM = 3
# A text counts as at most this many independent trigrams, as neighbours say much the same.
EVIDENCE = 60
# Weight of the next wider level in host priors, and added counts in evidence tables.
HOST, DOMAIN, ADDED = 5.0, 20.0, 1.0
CHARS = 1 << 20
_OUT = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", re.S | re.I)
_SPACE = re.compile(r"\s+")


def visible_text(page: str | None) -> str:
    """Text of a page without comments, scripts, styles and tags."""
    return _SPACE.sub(" ", entities.unescape(_OUT.sub(" ", page or ""))).strip()


def grams(text: str) -> np.ndarray:
    """Bucket of every character trigram of the lower-cased text, with a space at either end."""
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    if len(code) < GRAM:
        return np.zeros(0, np.int64)
    h = np.zeros(len(code) - GRAM + 1, np.uint64)
    for k in range(GRAM):
        h = h * np.uint64(0x100000001B3) + code[k:len(code) - GRAM + 1 + k]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - 15)).astype(np.int64)


def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Trigram counts by language, added up in the task."""
    total: dict[str, np.ndarray] = {}
    for frame in frames:
        for lang, text in zip(frame["lang"], frame["text"]):
            for lo in range(0, len(text), CHARS):
                row = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                row += np.bincount(grams(text[lo:lo + CHARS]), minlength=BUCKETS)
    for lang, row in total.items():
        at = np.flatnonzero(row)
        yield pd.DataFrame({"lang": lang, "bucket": at, "n": row[at]})


def train(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and log probabilities of trigrams in each, from all labelled documents; size is languages x buckets."""
    rows = docs.select(F.col(lang_column).alias("lang"), F.col(text_column).alias("text")).filter("lang is not null and text is not null")
    counts = rows.mapInPandas(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    table = np.full((len(langs), BUCKETS), 0.5)
    table[counts["lang"].map({x: i for i, x in enumerate(langs)}).astype(int), counts["bucket"]] += counts["n"]
    return langs, np.log(table / table.sum(1, keepdims=True))


def declared_language(page: Column) -> Column:
    """Primary subtag of the language that the page's html element names, else ''."""
    return F.lower(F.coalesce(F.regexp_extract(page, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-zA-Z]{2,3})\b", 1), F.lit("")))


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?i:[a-z][a-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))


def suffix(url: Column) -> Column:
    """Last label of the host, and the language-like first part of the path if there is one."""
    return F.concat_ws("/", F.regexp_extract(host(url), r"([^.]*)$", 1), F.lower(F.regexp_extract(url, r"^[^?#]*?//[^/?#]*/([a-zA-Z]{2})(?:[/?#-]|$)", 1)))


def languages(
    pages: DataFrame, docs: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
) -> DataFrame:
    """One row per page: page_id, lang, probability, text_lang, declared, host.

    The text's likelihood comes from a trigram model of ``docs`` (text, lang). What a page
    declares and what its address ends in count by how often they go with each language,
    learned from the text posteriors of all pages. A host's prior is smoothed towards its
    domain (last two labels), that towards the whole; a page's own share is taken out.

    NULL or empty html has no text and is judged by address and host; pages without any
    evidence get the overall prior. NULL urls share one empty host. Rows with NULL or
    repeated ids give a row each. Without labelled documents lang is NULL. An empty table gives
    none. Other columns are not read. Ties go to the first language in order.
    """
    scratch = Scratch(pages.sparkSession, "language")
    langs, model = train(docs)
    url, page = F.col(url_column), F.col(html_column)
    names = host(url)
    rows = pages.select(
        F.col(id_column).alias("page_id"), page.alias("html"), declared_language(page).alias("declared"), names.alias("host"),
        F.coalesce(suffix(url), F.lit("")).alias("suffix"), F.regexp_extract(names, r"([^.]+\.[^.]+|[^.]*)$", 1).alias("domain"),
    )
    if not langs:
        empty = F.lit(None).cast("string")
        return rows.select("page_id", empty.alias("lang"), F.lit(None).cast("double").alias("probability"), empty.alias("text_lang"), "declared", "host")
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def likelihood(html: pd.Series) -> pd.Series:
        out = []
        for x in html:
            text, total, n = visible_text(x), np.zeros(len(langs)), 0
            for lo in range(0, len(text), CHARS):
                found = grams(text[lo:lo + CHARS])
                total, n = total + shared.value[:, found].sum(1), n + len(found)
            out.append((total / max(n, 1) * min(n, EVIDENCE)).tolist())
        return pd.Series(out, dtype=object)

    scored = rows.withColumn("log", F.pandas_udf(likelihood, "array<double>")("html")).drop("html")
    softmax = lambda log: F.transform(log, lambda x: F.exp(x - F.array_max(log)))
    scored = scratch.keep(_normal(scored.withColumn("q", softmax(F.col("log"))), "q"), "scored")

    def summed(keys: list[str]) -> DataFrame:
        """Text posteriors added up by key, as arrays; partial sums before the shuffle."""
        return scored.groupBy(*keys).agg(F.array(*[F.sum(F.col("q")[i]) for i in range(len(langs))]).alias("sums"))

    whole = np.array([x or 0.0 for x in summed([]).first()[0]]) + ADDED
    base = F.array(*[F.lit(float(x)) for x in whole / whole.sum()])
    mass = F.array(*[F.lit(float(x)) for x in whole])
    out = scored
    for key in ("declared", "suffix"):
        values = max(1, scored.agg(F.approx_count_distinct(key)).first()[0])
        # P(value | language), up to a factor that all languages share.
        log = F.zip_with("sums", mass, lambda s, m: F.log((s + ADDED) / (m + ADDED * values)))
        out = out.join(summed([key]).select(key, log.alias(f"log_{key}")), key)
    for key in ("host", "domain"):
        out = out.join(summed([key]).withColumnRenamed("sums", f"sums_{key}"), key)
    own = lambda sums: F.zip_with(sums, "q", lambda s, q: F.greatest(s - q, F.lit(0.0)))
    mean = lambda sums, weight, wider: F.zip_with(sums, wider, lambda s, w: s + weight * w)
    out = out.withColumn("wide", mean(own("sums_domain"), DOMAIN, base))
    out = _normal(out, "wide").withColumn("near", mean(own("sums_host"), HOST, F.col("wide")))
    out = _normal(out, "near")
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    total = add(add(add("log", "log_declared"), "log_suffix"), F.transform("near", lambda x: F.log(x)))
    out = out.withColumn("total", total).withColumn("p", softmax(F.col("total")))
    out = _normal(out, "p")
    label = F.array(*[F.lit(x) for x in langs])
    best = lambda c: F.element_at(label, F.array_position(c, F.array_max(c)).cast("int"))
    return out.select("page_id", best(F.col("p")).alias("lang"), F.array_max("p").alias("probability"), best(F.col("q")).alias("text_lang"), "declared", "host")


def _normal(rows: DataFrame, column: str) -> DataFrame:
    """The array scaled to add up to 1."""
    total = F.aggregate(column, F.lit(0.0), lambda a, x: a + x)
    return rows.withColumn("_sum", total).withColumn(column, F.transform(column, lambda x: x / F.col("_sum"))).drop("_sum")
