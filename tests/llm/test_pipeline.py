"""The pipeline stage by stage against brute force."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as cp  # noqa: E402
import numpy as np  # noqa: E402
from dieflow.llm import quality, segmentations  # noqa: E402
from dieflow.llm.common import Scratch, table  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from test_lines import brute as brute_lines  # noqa: E402
from test_pairs import brute_components  # noqa: E402

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.select(cp.COLUMNS).collect()), key=str)


def test_stages(spark):
    scratch = Scratch(spark, "t")
    docs = table(spark, SF, "documents")
    kept = {}
    for name, stage in cp.STAGES:
        out = scratch.keep(stage(spark, docs, SF), name)
        kept[name] = (docs, out)
        docs = out
    before, after = kept["quality"]
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    stay = {r.doc_id for r in after.collect()}
    right = [(i in stay) == (q == 1) for i, q in labels.items()]
    assert np.mean(right) > 0.85 and set(rows(after)) <= set(rows(before))

    before, after = kept["lines"]
    want = brute_lines([(r.doc_id, r.text) for r in before.collect()], 20)
    texts = {k[0]: v for k, v in want.items()}
    expect = {i: t for i, (_, n, t) in texts.items() if not (n and not (t or "").strip())}
    assert {r.doc_id: r.text for r in after.collect()} == expect
    assert all(r.n_chars == len(r.text) for r in after.collect() if texts[r.doc_id][1])

    before, after = kept["near_duplicates"]
    groups = brute_components([(r.doc_id, r.text) for r in before.collect()])
    assert {r.doc_id for r in after.collect()} == {i for i, _, c in groups if i == c}

    before, after = kept["benchmark"]
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect() if not any(b in r.text for b in items)}

    before, after = kept["segmentations"]
    found = after.collect()
    assert {r.doc_id for r in found} == {r.doc_id for r in before.collect()} and all(r.exact for r in found)


def test_odd_rows_pass_through(spark):
    odd = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "Plain words in a row here.", "en", "s", 26), (2, "Plain words in a row here.", "en", "s", 26), (None, "Other words, also plain.", None, None, 5)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in cp.STAGES[1:]:
        docs = stage(spark, docs, SF)
        if name != "segmentations":
            assert docs.columns == cp.COLUMNS
    assert docs.filter("exact").count() == docs.count() >= 4
    empty = table(spark, SF, "documents").limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_run_applies_all_stages(spark):
    out = cp.run(spark, SF)
    assert out.columns == segmentations.sampled_segmentations(table(spark, SF, "documents"), cp.public_tokenizers.path("piece_bpe_32k.model")).columns
    assert 0 < out.agg(F.count_distinct("doc_id")).first()[0] < table(spark, SF, "documents").count()
    assert quality.WIDTH > 10
