"""Removal of repeated 400-byte strings against brute force."""
import hashlib
from collections import Counter

import numpy as np
import pytest

from dieflow.llm import repeats
from dieflow.llm.common import table
from dieflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + 400] for d in data for i in range(len(d) - 399))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 400, bool)
        for i in range(len(d) - 399):
            if seen[d[i:i + 400]] > 1:
                gone[i:i + 400] = True
        gone = gone[:len(d)]
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, spans string, v int")
    got = repeats.repeated_strings(docs).collect()
    want = [(i, *r) for (i, _), r in zip(rows, brute([t for _, t in rows]))]
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert len(r.spans) == r.n_spans and sum(s.stop - s.start for s in r.spans) == r.n_removed


def test_generated_repeats(spark):
    """Shared passages around the length limit, cut at either end, overlapping, inside one text, periodic, and copies."""
    rng = np.random.default_rng(4)
    letters = list("abcdefgh ")
    text = lambda n: "".join(rng.choice(letters, n))
    passages = [text(n) for n in (398, 399, 400, 401, 420, 500, 700, 1500)]
    rows = []
    for _ in range(60):
        parts = []
        for _ in range(rng.integers(1, 4)):
            p = passages[rng.integers(len(passages))]
            lo = rng.integers(0, 30) * rng.integers(0, 2)
            parts += [text(rng.integers(0, 300)), p[lo:len(p) - rng.integers(0, 30) * rng.integers(0, 2)]]
        rows.append((len(rows), "".join(parts) + text(rng.integers(0, 200))))
    base = text(3000)
    for k in range(12):
        at = rng.integers(0, 2900)
        rows.append((len(rows), base[:at] + "X" * k + base[at + 5:]))
    rows += [(900, "ab" * 600), (901, "ab" * 300), (902, "z" * 400), (903, "z" * 401), (904, "é" * 300 + base[:500]), (905, base), (906, base), (907, "q" * 399), (908, "q" * 399)]
    rows += [(None, None), (1000, ""), (None, base[:450]), (905, text(500)), (1001, "日本語" * 50)]
    check(spark, rows)


def test_empty_and_plain(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.repeated_strings(docs).count() == 0
    check(spark, [(1, "short"), (2, None)])
    check(spark, [(1, "x" * 1000)])


def test_long_texts_are_cut_with_overlap(monkeypatch):
    """Parts of a long text give every string start once, whatever the part size."""
    monkeypatch.setattr(repeats, "CHUNK", 1000)
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 101, n, np.uint8)) for n in (5000, 300, 400, 401, 2399, 12345)]
    starts = {i: [] for i in range(len(texts))}
    for _, number, shift, _, first, last, _ in repeats._sampled(texts):
        for i, a, b in zip(number.tolist(), (first + shift).tolist(), (last + shift).tolist()):
            starts[i] += range(a, b + 1)
    assert {i: sorted(s) for i, s in starts.items()} == {i: list(range(max(0, len(t) - 399))) for i, t in enumerate(texts)}


def test_equal_strings_have_equal_samples():
    rng = np.random.default_rng(2)
    shared = bytes(rng.integers(97, 100, 400, np.uint8))
    offsets = set()
    for _ in range(20):
        before = bytes(rng.integers(97, 100, rng.integers(0, 50), np.uint8))
        data = np.frombuffer(before + shared + bytes(rng.integers(97, 100, 60, np.uint8)), np.uint8)
        _, place, first, last, _ = repeats.samples(data)
        at = np.flatnonzero((first <= len(before)) & (last >= len(before)))[0]
        offsets.add(int(place[at]) - len(before))
    assert len(offsets) == 1


@pytest.mark.parametrize("sf", [SF])
def test_the_given_table(spark, sf):
    docs = table(spark, sf, "documents").collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op9_repeated_strings"](spark, sf).collect()}
    assert got == dict(zip([d.doc_id for d in docs], brute([d.text for d in docs])))
