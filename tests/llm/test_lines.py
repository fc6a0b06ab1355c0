"""Line dedup against brute force and SQL."""
import numpy as np
from compare import differences

from dieflow.llm import line_runs
from dieflow.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def brute(rows, least):
    """For each distinct (id, text): lines left, by trying every run."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = set(), {}
    for key in order:
        lines = (key[1] or "").split("\n") if key[1] else []
        gone = set()
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = "\n".join(lines[a:b + 1])
                if len(run.split()) >= least and run in seen:
                    gone |= set(range(a, b + 1))
                # A run that starts further up counts, so add runs only once all starts before are known.
            for b in range(a, len(lines)):
                seen.add("\n".join(lines[a:b + 1]))
        out[key] = (len(lines), len(gone), key[1] if not lines else "\n".join(x for i, x in enumerate(lines) if i not in gone))
    return out


def check(spark, rows, least):
    docs = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, runs string, line_dedup int")
    got = line_runs.dedup_lines(docs, words=least).collect()
    want = brute(rows, least)
    have = sorted(((r.doc_id, r.line_dedup.n_lines, r.line_dedup.n_removed, r.text, r.runs) for r in got), key=str)
    assert have == sorted(((i, *want[i, t], "k") for i, t in rows), key=str)


def test_runs_of_lines(spark):
    rng = np.random.default_rng(3)
    lines = ["w%d " % i * int(rng.integers(0, 6)) for i in range(14)]
    rows = [(i, "\n".join(lines[j] for j in rng.integers(0, len(lines), rng.integers(1, 14)))) for i in range(60)]
    block = "\n".join(lines[:9])
    rows += [(100, block), (101, "x\n" + block + "\ny"), (102, block + "\n" + block), (103, ""), (104, None), (None, block), (105, "a b c\n" * 30), (106, "\n\n\n"), (107, block), (107, block)]
    for least in (1, 5, 11):
        check(spark, rows, least)


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert line_runs.dedup_lines(empty).count() == 0
    check(spark, [(1, "one line only"), (2, "another")], 2)
    check(spark, [(2, "same words in here"), (1, "same words in here")], 3)


def test_by_sql(spark):
    assert differences(spark, SF, QUERIES["op2_line_runs"], ORACLES["op2_line_runs"]) == []
    assert QUERIES["op2_line_runs"](spark, SF).agg(F.sum("n_removed")).first()[0] > 0
