"""The recurrent model against finite differences and plain loops; its scores against single words."""
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dieflow.llm import recurrent as model
from dieflow.llm.common import table
from dieflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def small_net(kind=np.float64):
    net = model.Net.first(np.arange(1, model.KINDS + 1)[::-1].astype(float))
    net = model.Net(net.values.astype(kind))
    net.values += np.random.default_rng(4).normal(0, 0.2, len(net.values))
    return net


def test_gradients_by_finite_differences():
    random, net = np.random.default_rng(7), small_net()
    inputs, targets = random.integers(0, model.KINDS, (2, 5, 3))
    targets[0] = [0, 1, model.RARE]
    inputs[1:3] = inputs[0]
    fresh = np.zeros((5, 3), bool)
    fresh[2, 1] = True
    h = random.normal(0, 0.3, (3, model.HIDDEN))
    _, grad, rows, _ = model.gradients(net, inputs, targets, h, fresh)
    assert rows.tolist() == sorted(set(inputs.ravel()))
    at = np.flatnonzero(grad.values)
    for i in random.choice(at, 60, replace=False):
        loss = []
        for move in (1e-5, -1e-5):
            moved = net.values.copy()
            moved[i] += move
            loss.append(model.gradients(model.Net(moved), inputs, targets, h, fresh)[0])
        assert grad.values[i] == pytest.approx((loss[0] - loss[1]) / 2e-5, rel=1e-4, abs=1e-8)


def plain_log_p(net, ids):
    """One document, one step at a time."""
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    h, before, total, n = np.zeros(model.HIDDEN), 0, 0.0, model.HIDDEN
    for i in ids:
        x, inner = net.into[before], h @ net.again
        keep, reset = sigmoid(x[:n] + inner[:n]), sigmoid(x[n:2 * n] + inner[n:2 * n])
        h = (1 - keep) * np.tanh(x[2 * n:] + reset * inner[2 * n:]) + keep * h
        logits = h @ net.to_class + net.class_bias
        kind = 0 if i == 0 else 1 + (i - 1) // model.WIDE if i <= model.SIZE else i - model.SIZE + model.CLASSES
        total += logits[kind] - np.log(np.exp(logits).sum())
        if 0 < i <= model.SIZE:
            c, w = divmod(i - 1, model.WIDE)
            logits = h @ net.to_word[c] + net.word_bias[c]
            total += logits[w] - np.log(np.exp(logits).sum())
        before = i
    return total


def test_whole_documents_with_state_across_windows(monkeypatch):
    monkeypatch.setattr(model, "LANES", 4)
    monkeypatch.setattr(model, "WINDOW", 3)
    random, net = np.random.default_rng(2), small_net()
    docs = [[*random.integers(1, model.KINDS, n), 0] for n in (0, 5, 1, 40, 0, 7, 3, 12)]
    got = model.score(net, np.concatenate(docs).astype("<u2"), np.cumsum([len(d) for d in docs]))
    assert got == pytest.approx([plain_log_p(net, d) for d in docs], rel=1e-9)
    # All kinds together have probability one, whatever came before.
    ids = np.arange(model.KINDS)
    state = np.tile(random.normal(0, 0.5, model.HIDDEN), (model.KINDS, 1))
    assert np.exp(model.output(net, state, ids)[0]).sum() == pytest.approx(1)


def test_large_weights_do_not_overflow():
    net = small_net(np.float32)
    net.to_class *= 500
    log_p, _ = model.output(net, np.ones((model.KINDS, model.HIDDEN), np.float32), np.arange(model.KINDS))
    assert not np.isnan(log_p).any()
    assert np.exp(log_p.astype(float)).sum() == pytest.approx(1, rel=1e-3)


def words_of(text):
    return [*(text or "").encode().lower().split(), b""]


def checked(docs, rows, learned):
    counts = Counter(w for key, text in docs if learned(key) for w in words_of(text))
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (str(key), not learned(key), len(words_of(t)), sum(counts[w] > 0 for w in words_of(t)), n,
         round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words_of(t)), 6))
        for key, t in docs
    )
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows) == want
    assert all(-1e9 < r.score < 0 or r.train_tokens == 0 for r in rows)


def test_the_given_table(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    rows = QUERIES["op11_recurrent_scores"](spark, SF).collect()
    checked(docs, rows, lambda i: zlib.crc32(str(i).encode()) % 10 != 0)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held)


def test_the_model_learns_order(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("one two three four five " * 30).alias("text"))
    rows = model.recurrent_scores(docs, F.col("doc_id") < 280).collect()
    for r in rows:
        # Five words by themselves cost log10(5) each; their order is certain.
        assert r.score > 0.5 * r.base_score


def test_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (3, " \n\t", 5), (None, "NULL id A", 5), (4, "a b c a\x0bb", 5), (4, "a b c a\x0bb", 5), (5, "é É \x1c ß", 5), (6, "w " * 30_000, 5), (7, "x" * 200_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block int").repartition(3)
    keys = [(k, t) for k, t, _ in rows]
    checked(keys, model.recurrent_scores(docs, F.coalesce(F.col("doc_id") < 6, F.lit(True))).collect(), lambda k: k is None or k < 6)
    nothing = model.recurrent_scores(docs, F.lit(False)).collect()
    checked(keys, nothing, lambda k: False)
    assert all(r.score == r.base_score for r in nothing)
    assert model.recurrent_scores(docs.limit(0), F.lit(True)).collect() == []


def test_classes_are_bounded_in_one_pass(monkeypatch):
    """Logits of all classes are bounded by two calls, whatever the number of classes; large ones are still safe."""
    net, bounded, calls = small_net(np.float32), model._large, []
    monkeypatch.setattr(model, "_large", lambda *x: calls.append(x) or bounded(*x))
    net.to_word[3] *= 400
    ids = np.arange(model.KINDS)
    h = np.random.default_rng(2).uniform(-1, 1, (len(ids), model.HIDDEN)).astype(np.float32)
    log_p, _ = model.output(net, h, ids)
    assert len(calls) == 2 and np.isfinite(log_p).all()
    assert net.large() == [False, *(c == 3 for c in range(model.CLASSES))]


def test_words_are_numbered_as_they_come():
    words = model.Words()
    words.add(1, True, "b a B")
    words.add(2, True, "c a")
    assert list(words.numbers) == [b"", b"b", b"a", b"c"]
    assert [a.tolist() for a in words.at] == [[1, 2, 1, 0], [3, 2, 0]]
