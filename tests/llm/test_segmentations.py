"""Sampled segmentations: round trip, distinctness, and probabilities against full enumeration."""
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from dieflow.llm import segmentations as s
from dieflow.llm.common import table
from dieflow.llm.queries import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "a", "  a  b ", "\n", "a\n\nb \n", "日本語 text", "🙂🦜 x", "▁ mark", "tab\tx\x00y", "w" * 700, "many words here " * 300, "a", "a"]


@pytest.fixture(scope="module")
def lexicon():
    return s.Lexicon(PATH)


def all_segmentations(lexicon, text):
    """Every segmentation of a short text with its probability."""
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    usable = {sp.id_to_piece(i): i for i in lexicon.piece[lexicon.piece >= 0].tolist()}

    def cut(rest):
        if not rest:
            yield (), 0.0
        for n in range(1, len(rest) + 1):
            if rest[:n] in usable:
                i = usable[rest[:n]]
                for tail, log in cut(rest[n:]):
                    yield (i, *tail), lexicon.log[i] + log

    # The raw text, not its units.
    out = list(cut("▁" + text.replace(" ", "▁")))
    weights = {ids: math.exp(log) for ids, log in out}
    total = sum(weights.values())
    return {ids: w / total for ids, w in weights.items()}


def test_no_piece_crosses_a_unit():
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in ("a    b        c", " x", "   x  ", "tail  ", " ", "    ", "def f(x):\n        return x\n\n  #  y", "a \nb", "▁▁ marks  ▁ x"):
        assert "".join(s.units(text)) == "▁" + text.replace(" ", "▁")
        ends = set(np.cumsum([len(u) for u in s.units(text)]).tolist())
        pieces = [sp.id_to_piece(i) for i in sp.encode(text)]
        # A line break is given as one byte.
        assert ends <= set(np.cumsum([1 if x == "<0x0A>" else len(x) for x in pieces]).tolist())


@pytest.mark.parametrize("text", ["the on", "a    on", " is  "])
def test_first_and_second_draws_follow_the_distribution(lexicon, text):
    n = 6000
    exact = all_segmentations(lexicon, text)
    seeds = np.arange(n, dtype=np.uint64) * np.uint64(2654435761)
    draws = s.sample_block(lexicon, [text] * n, seeds, 2)
    first = Counter(tuple(d[0][0].tolist()) for d in draws)
    second = Counter(tuple(d[1][0].tolist()) for d in draws)
    assert set(first) | set(second) <= set(exact)
    for ids, p in exact.items():
        assert abs(first[ids] / n - p) < 4.5 * math.sqrt(p * (1 - p) / n) + 1e-3
        # Drawn second: first another one, then this one in proportion among the rest.
        q = sum(o * p / (1 - o) for other, o in exact.items() if other != ids)
        assert abs(second[ids] / n - q) < 4.5 * math.sqrt(q * (1 - q) / n) + 1e-3
    for d in draws[:50]:
        for ids, log, included in d:
            assert math.isclose(math.exp(log), exact[tuple(ids.tolist())], rel_tol=1e-6)
            assert included <= 0


def test_inclusion_scores_are_unbiased(lexicon):
    """Horvitz-Thompson: the mean of p / inclusion over samples estimates 1."""
    n = 4000
    seeds = np.arange(n, dtype=np.uint64) * np.uint64(40503) + np.uint64(7)
    draws = s.sample_block(lexicon, ["the on"] * n, seeds, 3)
    sums = [sum(math.exp(log - included) for _, log, included in d) for d in draws]
    assert abs(np.mean(sums) - 1) < 5 * np.std(sums) / math.sqrt(n)


def test_everything_is_taken_when_few_exist(lexicon):
    exact = all_segmentations(lexicon, "ab")
    got = s.sample_block(lexicon, ["ab"], np.array([5], np.uint64), 50)[0]
    assert {tuple(ids.tolist()) for ids, _, _ in got} == set(exact)
    assert len(got) == len(exact) and all(inc == 0.0 for _, _, inc in got)


def test_samples_of_odd_texts(spark, lexicon):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, "null id", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    got = s.sampled_segmentations(docs, PATH, k=3)
    found = got.collect()
    by = {}
    for r in found:
        assert r.exact
        by.setdefault(r.doc_id, []).append(bytes(r.ids))
    texts = {r[0]: r[1] or "" for r in rows}
    for doc_id, samples in by.items():
        assert len(set(samples)) == len(samples)
        for x in samples:
            ids = np.frombuffer(x, "<u4")
            assert lexicon.decode(ids).decode() == texts[doc_id].replace("▁", " ")
            if "  " not in texts[doc_id] and texts[doc_id][:1] != " ":
                assert sp.decode(ids.tolist()) == texts[doc_id].replace("▁", " ")
    assert set(by) == set(texts)
    assert by[0] == [b""] and by[1] == [b""] and by[3][0] is not None
    back = got.select("doc_id", s.decoded(PATH)("ids").alias("text")).collect()
    assert {(r.doc_id, r.text) for r in back} == {(k, v.replace("▁", " ")) for k, v in texts.items()}
    assert s.sampled_segmentations(docs.limit(0), PATH).count() == 0


def test_batches_do_not_matter(lexicon, monkeypatch):
    texts = ["one two three", "four five", "six " * 40]
    seeds = np.array([3, 4, 5], np.uint64)
    whole = s.sample_block(lexicon, texts, seeds, 3)
    for i in range(3):
        alone = s.sample_block(lexicon, texts[i:i + 1], seeds[i:i + 1], 3)[0]
        assert [a[0].tolist() for a in alone] == [a[0].tolist() for a in whole[i]]


def test_the_given_table(spark):
    rows = QUERIES["op10_sampled_segmentations"](spark, "/root/testdata/sf0.001").collect()
    docs = table(spark, "/root/testdata/sf0.001", "documents").count()
    assert len({r.doc_id for r in rows}) == docs
    assert all(r.exact and r.log_prob <= 1e-6 and r.log_inclusion <= 0 for r in rows)


def test_the_query_gives_the_ids_and_what_they_decode_to(spark, lexicon, tmp_path):
    rows = [(1, "two  words\n\tand 日本 ▁"), (2, ""), (3, None), (1, "two  words\n\tand 日本 ▁")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op10_sampled_segmentations"](spark, str(tmp_path)).collect()
    texts = {k: (v or "").replace("▁", " ") for k, v in rows}
    assert sorted((r.doc_id, r.sample) for r in found) == [(1, 1), (1, 1), (1, 2), (1, 2), (2, 1), (3, 1)]
    for r in found:
        ids = np.frombuffer(r.ids, "<u4")
        assert r.text == texts[r.doc_id] == lexicon.decode(ids).decode()
        assert len(ids) == r.n_tokens and zlib.crc32(bytes(r.ids)) == r.ids_crc32


def test_unlikely_segmentations_are_in_reach():
    """However sharp the distribution: what all other pieces at a place have together is not lost beside 1."""
    sharp = s.Lexicon(PATH, power=6.0)
    exact = all_segmentations(sharp, "the")
    got = s.sample_block(sharp, ["the"], np.array([5], np.uint64), 50)[0]
    assert min(exact.values()) < 1e-100
    assert len(got) == len(exact) and {tuple(ids.tolist()) for ids, _, _ in got} == set(exact)
    # Every first edge beside another one; the last has all others left.
    lattice = s.Lattice(sharp, ["▁the"])
    for at in range(4):
        edges = np.arange(lattice.edges_at[at], lattice.edges_at[at] + lattice.many[at])
        for e in edges:
            assert lattice.left[e] == pytest.approx(lattice.p[edges[edges != e]].sum(), rel=1e-12, abs=0)


def test_lattice_looks_up_only_what_can_go_on(lexicon, monkeypatch):
    """A unit's first characters are no lookups, nor are nodes that nothing follows; edges are those of plain slices."""
    looked, step = [], s.Lexicon.step

    def counted(self, node, letter):
        looked.append(node.copy())
        return step(self, node, letter)

    monkeypatch.setattr(s.Lexicon, "step", counted)
    words = ["▁the", "▁segmentation", "▁日本", "\n", "▁▁▁x", "▁\U0010ffff", "ab\x00c"]
    lattice = s.Lattice(lexicon, words)
    assert looked and all(lexicon.inner[node].all() and (node > 0).all() for node in looked)
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    usable = {sp.id_to_piece(i): i for i in lexicon.piece[lexicon.piece >= 0].tolist()}
    for first, word in zip(lattice.first, words):
        for at in range(len(word)):
            place = first + at
            edges = slice(lattice.edges_at[place], lattice.edges_at[place] + lattice.many[place])
            want = [(first + end, usable[word[at:end]]) for end in range(len(word), at, -1) if word[at:end] in usable]
            got = [(e, p) for e, p in zip(lattice.end[edges].tolist(), lattice.piece[edges].tolist()) if p >= 0]
            assert got == want and (lattice.start[edges] == place).all()
            assert lattice.p[edges].sum() == pytest.approx(1)
            assert len(want) + (word[at] not in usable) == lattice.many[place]
