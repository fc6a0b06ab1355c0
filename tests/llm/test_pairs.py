"""Near-duplicates and exact search against brute force."""
import numpy as np
import pytest
from compare import differences

from dieflow.llm import near_dup, topk
from dieflow.llm.common import Scratch, table
from dieflow.llm.components import components
from dieflow.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def brute_components(rows):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in rows]
    name = list(range(len(rows)))

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            alike = sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j])
            if rows[i][0] is not None and rows[j][0] is not None and (alike or rows[i][0] == rows[j][0]):
                name[root(i)] = root(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[root(i)] = min(low.get(root(i), k), k)
    return sorted(((k, len(sets[i]), low.get(root(i)) if k is not None else None) for i, (k, _) in enumerate(rows)), key=str)


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "v", 3) for r in rows], "doc_id long, text string, v string, n int")
    got = near_dup.near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_components(rows)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_odd_rows(spark):
    a = "a b c d e f g h i j k l m n o p q r s t"
    rows = [(5, a), (3, a.upper()), (9, a + " u"), (2, ""), (4, None), (6, " \t\n "), (7, "one two"), (8, "One  two"), (10, "two one"),
            (None, a), (None, a), (11, "x y z"), (11, a.replace("a b", "q q")), (12, "y x"), (12, "y x"), (1, "über Über"), (13, "ÜBER über")]
    check(spark, rows)
    assert near_dup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    check(spark, [(1, None), (2, "")])


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_of_near_copies(spark, seed, monkeypatch):
    """Chains of edits around the threshold, and documents sharing a passage, with small blocks."""
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    rng = np.random.default_rng(seed)
    word = lambda: "w%d" % rng.integers(5000)
    passage, rows = [word() for _ in range(40)], []
    for g in range(6):
        base = [word() for _ in range(60)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.integers(0, 4)):
                copy[rng.integers(len(copy))] = word()
            rows.append((len(rows), " ".join(copy)))
            if rng.random() < 0.3:
                base = copy
    for _ in range(30):
        rows.append((len(rows), " ".join(passage + [word() for _ in range(rng.integers(1, 30))])))
    rng.shuffle(rows)
    check(spark, [(int(i), str(t)) for i, t in rows])


def test_texts_alike_but_not_linked_make_no_rows_by_pairs(spark, monkeypatch):
    """400 texts share two thirds of their words: 79,800 pairs to refuse, but no table of so many rows."""
    rows, keep = {}, Scratch.keep

    def counted(self, df, name):
        out = keep(self, df, name)
        rows[name] = max(rows.get(name, 0), out.count())
        return out

    monkeypatch.setattr(Scratch, "keep", counted)
    monkeypatch.setattr(near_dup, "BLOCK", 64)
    common = " ".join(f"w{i}" for i in range(70))
    texts = [(i, f"{common} " + " ".join(f"x{i}y{k}" for k in range(18))) for i in range(400)]
    check(spark, texts + [(400, texts[7][1] + " more"), (401, texts[9][1] + " other")])
    assert "vertices" in rows and max(rows.values()) < 60 * 402


def test_keys_meet_below_the_threshold():
    """Signatures that differ in up to 23 values share a key."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        a = rng.integers(0, 1 << 16, near_dup.VALUES).astype(np.uint16)
        b = a.copy()
        at = rng.choice(near_dup.VALUES, near_dup.CHUNKS * (near_dup.ERRORS + 1) - 1, replace=False)
        b[at] ^= 1
        keys = near_dup.bucket_keys(np.stack([a, b]))
        assert (keys[0] == keys[1]).any()


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7), (None, 3), (5, None), (102, 100), (100, 101), (-9, 200)]
    got = components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "t")).collect()
    want = {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100, -9: -9, 200: -9}
    assert {r.v: r.component for r in got} == want and len(got) == len(want)


def test_near_duplicates_by_sql(spark):
    assert differences(spark, SF, QUERIES["op6_near_duplicates"], ORACLES["op6_near_duplicates"]) == []


def brute_top(rows, k):
    usable = [(i, np.array([np.floor(256 * float(x)) for x in v]).astype(np.int64)) for i, v in rows
              if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out, seen = [], set()
    for i, v in sorted(usable, key=lambda r: (r[0], r[1].tolist())):
        if i % 50 == 0 and i not in seen:
            seen.add(i)
            scores = sorted((-int(v @ w), j) for j, w in usable if j != i and len(w) == len(v))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_top_k(spark, small, monkeypatch):
    if small:
        monkeypatch.setattr(topk, "BINS", 4)
        monkeypatch.setattr(topk, "CANDIDATES", 7)
        monkeypatch.setattr(topk, "QUERIES", 2)
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.normal(size=8).astype("f4")]) for i in range(-60, 120)]
    rows += [(i, [0.5] * 8) for i in range(200, 230)] + [(250, [0.5] * 8), (300, [0.5] * 8)]
    rows += [(400, None), (401, [float("nan")] * 8), (402, [None] + [1.0] * 7), (403, [float("inf")] * 8), (None, [1.0] * 8), (450, []), (500, [1.0, 2.0]), (501, [3.0, -1.0]),
             (550, [1.0] * 3), (7, [0.25] * 8), (7, [0.25] * 8), (0, [2.0] * 8)]
    vectors = spark.createDataFrame([(*r, "s") for r in rows], "vec_id long, embedding array<float>, score string")
    got = sorted(map(tuple, topk.top_k(vectors, F.col("vec_id") % 50 == 0).collect()))
    assert got == brute_top([(i, None if v is None else [None if x is None else np.float32(x) for x in v]) for i, v in rows], 5)


def test_top_k_empty(spark):
    vectors = table(spark, SF, "embeddings")
    assert topk.top_k(vectors.limit(0), F.lit(True)).count() == 0
    assert topk.top_k(vectors, F.lit(False)).count() == 0
    big = spark.createDataFrame([(0, [3e6, 2e6]), (1, [3e6, -1e6]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r.score) for r in topk.top_k(big, F.col("vec_id") == 0).orderBy("rank").collect()] == [
        (1, (256 * 3000000) ** 2 - 256 * 256 * 2000000 * 1000000), (2, 256 * 256 * 5000000)]


def test_top_k_by_sql(spark):
    assert differences(spark, SF, QUERIES["op3_exact_topk"], ORACLES["op3_exact_topk"]) == []
