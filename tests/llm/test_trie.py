"""The prefix trie against plain dictionaries and its SQL."""
import hashlib
import random
import zlib

import pytest
from compare import differences

from dieflow.llm import trie
from dieflow.llm.queries import ORACLES, QUERIES


def rebuilt(rows):
    own: dict[int, list] = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute_force(convs):
    nodes: dict[tuple, list] = {}
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {k: 0 for k in nodes}
    for k in nodes:
        if k:
            children[k[:-1]] += 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1]) if k else 0
    return sorted(
        (m[0], len(k), nodes[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k],
         hashlib.sha256(",".join(str(c) for c in m if len(convs[c]) == len(k)).encode()).hexdigest())
        for k, m in nodes.items()
    )


def built(spark, rows, local):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, rep string").repartition(5)
    turns, convs = trie.with_shared_heads(trie.ordered_turns(df))
    return sorted(map(tuple, trie.prefix_trie(turns, convs, local).collect()))


def chatter(seed, n):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "bot"]), r.choice(["", "hé", "go on", "🙂"])) for c in range(n) for t in range(r.randint(1, 6))]


@pytest.mark.parametrize("local", [1, 12, 10_000])
def test_random_conversations(spark, local):
    rows = chatter(3, 60) + [(c, t, "user", "the same") for c in range(200, 240) for t in range(5)]
    assert built(spark, rows, local) == brute_force(rebuilt(rows))


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "lost"), (7, None, None, None), (7, None, "a", "b"), (7, 2, "user", "x"), (7, 2, "user", "x"), (7, -5, "user", "y"),
        (-3, 0, "user", "below zero"), (9, 0, "u", "long " * 20_000), (9, 1, "", ""), (10, 0, "u", "long " * 20_000), (1 << 40, 0, "u", "far"),
        (0, 0, "ab", "c"), (0, 1, "a", "bc"), (1, 0, "a", "bc"), (1, 1, "ab", "c"),
    ]
    # Spark's and C's remainder of a negative number is negative, Python's is not.
    want = rebuilt([r for r in rows if r[0] != -3])
    h = zlib.crc32(b"-3") % 6
    want[-3] = [("ab", "c"), ("a", "bc")][:h] + [("user", "below zero")][h:]
    assert built(spark, rows, 3) == brute_force(want)
    assert built(spark, rows[:1], 3) == []


@pytest.mark.parametrize("local", [40, 10_000])
def test_one_deep_conversation(spark, local, monkeypatch):
    monkeypatch.setattr(trie, "TURNS", 16)
    monkeypatch.setattr(trie, "IDS", 2)
    deep = [("user", str(i % 7)) for i in range(150)]
    convs = {1: deep, 2: deep[:100] + [("user", "else")], 3: [], 4: deep[:3], **{i: deep[:9] for i in range(10, 40)}}
    rows = [(c, i, *t) for c, turns in convs.items() for i, t in enumerate(turns)]
    turns = spark.createDataFrame(rows, "conv_id long, pos long, role string, text string")
    ids = spark.createDataFrame([(c,) for c in convs], "conv_id long")
    assert sorted(map(tuple, trie.prefix_trie(turns, ids, local).collect())) == brute_force(convs)


def test_sql(spark):
    assert differences(spark, "/root/testdata/sf0.01", QUERIES["op12_prefix_trie"], ORACLES["op12_prefix_trie"]) == []
