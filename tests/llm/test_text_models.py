"""Quality scores, template windows and page languages."""
import zlib

import duckdb
import numpy as np
import pytest

from dieflow.llm import contamination, language, quality
from dieflow.llm.common import table
from dieflow.llm.queries import QUERIES
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scores(spark):
    return {r.doc_id: r for r in QUERIES["op4_quality_classifier"](spark, SF).collect()}


def test_held_out_accuracy(spark, scores):
    labels = table(spark, SF, "labels").collect()
    held = [(scores[r.doc_id], r.quality) for r in labels if scores[r.doc_id].held_out]
    assert np.mean([s.predicted == q for s, q in held]) > 0.9
    good, bad = [s.score for s, q in held if q == 1], [s.score for s, q in held if q == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    assert all(s.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= s.score <= 1 and s.predicted == (s.score >= 0.7) for i, s in scores.items())
    assert len(scores) == table(spark, SF, "documents").count()


def test_scores_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "A fine text about things.", 0.1), (2, None, 0.2), (3, "", 0.3), (None, "$$$ !!!", 0.4), (1, "A fine text about things.", 0.5), (5, "x" * 200000, 0.6)],
        "doc_id long, text string, score double")
    trusted = spark.createDataFrame([(1,), (1,), (77,), (None,)], "doc_id long")
    rows = quality.quality_scores(docs, trusted, F.lit(True)).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.quality_scores(docs, trusted.limit(0), F.lit(True)).collect()} == {0.5}
    assert quality.quality_scores(docs.limit(0), trusted, F.lit(True)).count() == 0


def test_features_add_up_over_pieces(monkeypatch):
    text = "Some words words WITH signs $$ and\nlines | " * 50
    whole = quality.features(text)
    assert len(whole) == quality.WIDTH and whole[-1] == 1.0
    assert np.allclose(quality.features(None)[:-1], 0) and np.allclose(quality.features("")[:-1], 0)
    assert abs(whole[quality.NAMES.index("repeat")] - 50 / len(text.split())) < 1e-9


ITEM = "Anna has 3 apples and Bob has 5 apples so how many apples do Anna and Bob have together if 3 are eaten by the old dog"


def leaks(spark, texts, items=(ITEM,)):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, hash string")
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], "item_id long, text string, key int")
    return {r.doc_id: r.item_ids for r in contamination.contamination(docs, bench).collect()}


def test_templates(spark):
    other = "the river runs past a mill where nobody has worked for more than a hundred years and weeds grow high"
    texts = [
        f"Intro here. {ITEM}. {other}", ITEM.upper(), ITEM.lower().replace(" ", "\n"), other, None, "",
        # Other numbers and names, used alike everywhere.
        f"{other} then " + ITEM.replace("3", "17").replace("5", "29").replace("Bob", "Carl"),
        # The two places of one number differ.
        " ".join(ITEM.replace("if 3", "if 4").split()[12:]),
        "1 2 3 4 5 6 7 8 9 10 11 12", "Anna has 3 apples", ITEM,
    ]
    got = leaks(spark, texts, (ITEM, "1 2 3 4 5 6 7 8 9", "too short", None, "", ITEM))
    assert {i for i, found in got.items() if found} == {0, 1, 2, 6, 7, 10}
    assert got[0] == [0, 5]


def test_slots_must_agree(spark):
    item = "a box holds 4 red balls while another box holds 4 blue balls and 4 green ones are lost on the way home today"
    same, broken = item.replace("4", "9"), item.replace("4 red", "9 red").replace("4 blue", "2 blue").replace("4 green", "7 green")
    got = leaks(spark, [same, broken], (item,))
    assert got[0] == [0] and got[1] == []


def test_short_items(spark):
    got = leaks(spark, ["we ask what is the capital of France now", "what is the capital"], ("what is the capital of France",))
    assert got[0] == [0] and got[1] == []


def test_leaks_of_the_given_table(spark):
    got = {r.doc_id for r in QUERIES["op1_benchmark_templates"](spark, SF).collect() if r.contaminated}
    want = {r[0] for r in duckdb.sql(f"SELECT DISTINCT d.doc_id FROM '{SF}/documents.parquet' d JOIN '{SF}/benchmark.parquet' b ON contains(d.text, b.text)").fetchall()}
    assert got == want and want


def test_page_languages(spark):
    rows = QUERIES["op5_page_language"](spark, SF).collect()
    assert len(rows) == table(spark, SF, "pages").count()
    assert all(0 < r.probability <= 1 for r in rows)
    assert np.mean([r.lang == r.text_lang for r in rows]) > 0.8


def test_language_evidence(spark):
    """Where the text says little, declaration, address and host decide."""
    docs = table(spark, SF, "documents")
    text = {r.lang: r.text for r in docs.filter("length(text) > 800").collect()}
    rows = [(i, f"https://fr.example.org/a/{i}", f"<html lang='fr'><body>{text['fr'][:500]}</body>") for i in range(20)]
    rows += [(i, f"http://www.beispiel.de/{i}", f'<HTML LANG="de-AT"><p>{text["de"][:500]}</p>') for i in range(20, 40)]
    rows += [(100, "https://fr.example.org/b", "<p>12</p>"), (101, "http://www.beispiel.de/x", None), (102, None, ""), (None, "weird", "<html lang=de>"), (100, "https://fr.example.org/b", "<p>12</p>")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, lang string")
    got = language.languages(pages, docs).collect()
    by = {(r.page_id, r.host): r for r in got}
    assert len(got) == len(rows)
    assert by[100, "fr.example.org"].lang == "fr" and by[101, "www.beispiel.de"].lang == "de"
    assert all(by[i, "fr.example.org"].lang == "fr" for i in range(20)) and all(by[i, "www.beispiel.de"].declared == "de" for i in range(20, 40))
    assert language.languages(pages.limit(0), docs).count() == 0
    assert {r.lang for r in language.languages(pages, docs.limit(0)).collect()} == {None}


def brute_languages(spark, sf):
    docs, pages = table(spark, sf, "documents").collect(), table(spark, sf, "pages").collect()
    langs = sorted({d.lang for d in docs})
    counts = np.full((len(langs), language.BUCKETS), 0.5)
    for d in docs:
        np.add.at(counts[langs.index(d.lang)], language.grams(d.text), 1)
    model = np.log(counts / counts.sum(1, keepdims=True))
    return langs, model, pages


def test_model_counts_all_documents(spark):
    langs, model = language.train(table(spark, "/root/testdata/sf0.001", "documents"))
    want_langs, want, _ = brute_languages(spark, "/root/testdata/sf0.001")
    assert langs == want_langs and np.allclose(model, want)


def test_posteriors_by_hand(spark):
    """The whole computation again, page by page, in plain Python."""
    sf = "/root/testdata/sf0.001"
    langs, model, pages = brute_languages(spark, sf)
    rows = {r.page_id: r for r in QUERIES["op5_page_language"](spark, sf).collect()}
    probe = table(spark, sf, "pages").select("page_id", language.declared_language(F.col("html")).alias("d"), language.host(F.col("url")).alias("h"), language.suffix(F.col("url")).alias("s"))
    parts = {r.page_id: r for r in probe.collect()}
    log = {}
    for p in pages:
        g = language.grams(language.visible_text(p.html))
        log[p.page_id] = model[:, g].sum(1) / max(len(g), 1) * min(len(g), language.EVIDENCE)
    q = {i: np.exp(x - x.max()) / np.exp(x - x.max()).sum() for i, x in log.items()}
    mass = sum(q.values()) + language.ADDED
    dom = lambda h: ".".join(h.split(".")[-2:])
    for i, x in log.items():
        total = x.copy()
        for name in "ds":
            mine = getattr(parts[i], name)
            s = sum(q[j] for j in q if getattr(parts[j], name) == mine)
            total += np.log((s + language.ADDED) / (mass + language.ADDED * len({getattr(v, name) for v in parts.values()})))
        wide = sum((q[j] for j in q if dom(parts[j].h) == dom(parts[i].h)), np.zeros(len(langs))) - q[i] + language.DOMAIN * mass / mass.sum()
        near = sum((q[j] for j in q if parts[j].h == parts[i].h), np.zeros(len(langs))) - q[i] + language.HOST * wide / wide.sum()
        total += np.log(near / near.sum())
        p = np.exp(total - total.max())
        p /= p.sum()
        assert abs(rows[i].probability - p.max()) < 0.02 and (rows[i].lang == langs[int(p.argmax())] or np.sort(p)[-2] > 0.4)
