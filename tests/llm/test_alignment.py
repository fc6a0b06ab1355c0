"""Alignment of two tokenizers against the libraries and plain loops."""
import hashlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from dieflow.llm import alignment
from dieflow.llm.common import table
from dieflow.llm.queries import QUERIES
from dieflow.llm.token_counts import byte_letters

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "\n", "  ", "a", " a", "a ", "a\n", "\na", "a  b", "a \n b", "a\n\nb", "x\ty", "don't we'll I'M 's", "aaaaaaaaaaaaaaaa", "a" * 3001,
    "<|endoftext|>", "hi <|endoftext|> there<|endoftext|>", "\x00nul \x00", "日本語 テキスト", "a b  c　", "é" * 50, "🙂🙂 x🙂", "12345 6,7.8", "***!!! ###",
    "a\x1cb \x1c c", "tail\n \n", "word " * 2000, "ß\r\nq\r\n", "\x85 x", "▁a b", "x ▁ y", "a ▁b", "<s> </s> <unk> <0x41>", "ﬁ ½ Å", "a\nb c\nd;\re", "plain words\nand a line",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def encoded(libraries, text):
    """Ids and byte ends by both libraries; None where they do not spell the text."""
    a, b = libraries
    letters = {x: i for i, x in byte_letters().items()}
    ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)] if text else [[], []]
    data = [
        [bytes(letters[x] for x in a.id_to_token(i)) for i in ids[0]],
        [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]],
    ]
    if not text or any(b"".join(d) != (" " + text).encode() for d in data):
        return None
    return [(i, np.cumsum(list(map(len, d))).tolist()) for i, d in zip(ids, data)]


def brute_force(libraries, docs):
    linked, parts = {}, {}
    for key, text in docs:
        found = encoded(libraries, text)
        if found is None:
            linked[key], parts[key] = Counter(), (0, 0, 0, 0, "")
            continue
        (a, ends_a), (b, ends_b) = found
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            stop = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append("|".join(",".join(map(str, x)) for x in (a[i:stop[0]], b[j:stop[1]])))
            i, j = stop
        ends = sorted({*ends_a, *ends_b})
        linked[key] = Counter((a[bisect_left(ends_a, e)], b[bisect_left(ends_b, e)]) for e in ends)
        parts[key] = len(a), len(b), len(groups), len(ends), hashlib.sha256(";".join(groups).encode()).hexdigest()
    counts = Counter(pair for found in linked.values() for pair in found)
    most: dict[int, int] = {}
    for (a, _), n in counts.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for key, found in linked.items():
        best = sum(n for p, n in found.items() if counts[p] == most[p[0]])
        out.append((key, *parts[key][:4], best, sum(n * counts[p] for p, n in found.items()), parts[key][4]))
    return out


def test_odd_texts(spark, libraries, monkeypatch):
    monkeypatch.setattr(alignment, "PART", 500)
    rows = [(i, t, "clash", 1, 2) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows + [(None, "word word", "c", 0, 0), (500, "same text", "c", 0, 0), (500, "same text", "c", 0, 0)], "doc_id long, text string, block string, at int, n int")
    got = sorted(map(tuple, alignment.token_alignment(docs.repartition(3), *PATHS).collect()), key=str)
    want = brute_force(libraries, [*enumerate(ODD), ("none", "word word"), ("x", "same text"), ("y", "same text")])
    names = {"none": None, "x": 500, "y": 500}
    assert got == sorted([(names.get(r[0], r[0]), *r[1:]) for r in want], key=str)
    assert alignment.token_alignment(docs.limit(0), *PATHS).collect() == []


def test_the_given_table(spark, libraries):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert sorted(map(tuple, QUERIES["op13_tokenizer_alignment"](spark, SF).collect())) == sorted(brute_force(libraries, docs))


def test_cuts_are_the_common_ends():
    random = np.random.default_rng(5)
    for _ in range(200):
        stops, parts_a, parts_b, base = [], [], [], 0
        for _ in range(random.integers(1, 5)):
            size = int(random.integers(1, 60))
            for parts in (parts_a, parts_b):
                inner = random.permutation(np.arange(1, size))[: random.integers(0, size)]
                parts.append(base + np.sort(np.r_[inner, size]))
            base += size
        a, b = np.concatenate(parts_a), np.concatenate(parts_b)
        stops = np.cumsum([len(x) for x in parts_a])
        cut = alignment.shared_cuts(a, b, stops - [len(x) for x in parts_a], stops)
        assert a[cut].tolist() == np.intersect1d(a, b).tolist()
