"""Validation against a sequential check, and comparison details."""
import random

import pytest
from pyspark.sql import functions as F

from dieflow.operators import quality as q, records as r, stats
from dieflow.sources.files import stdf_files
from dieflow.sources.frames import record_type_column, stdf_frames
from dieflow.sources.registry import record_types
from fixtures.encode import datalog


def sequential(types, strict):
    """The rules read one record after another."""
    initial = {"FAR", "ATR", "MIR", "RDR", "SDR"}
    known = set(record_types()) - ({"DTR"} if strict else set())
    if types[0] != "FAR":
        return q.NOT_FAR
    i = 1
    while i < len(types) and types[i] == "ATR":
        i += 1
    if i == len(types):
        return q.NO_INITIAL
    if types[i] != "MIR":
        return q.NO_MIR
    i += 1
    if i < len(types) and types[i] == "RDR":
        i += 1
    while i < len(types) and types[i] == "SDR":
        i += 1
    if i == len(types):
        return q.EOF
    counts = {"MRR": 0, "WCR": 0}
    for t in types[i + 1 if strict else i:]:
        if t in initial:
            return q.OUTSIDE
        if t in counts:
            counts[t] += 1
            if counts[t] > 1:
                return q.TWO_MRR if t == "MRR" else q.TWO_WCR
        if t not in known:
            return q.UNKNOWN
    return q.VALID if types[-1] == "MRR" else q.MRR_NOT_LAST


def sequences(n=400):
    rng = random.Random(5)
    out = []
    for _ in range(n):
        head = ["FAR"] * (rng.random() < 0.95) + ["ATR"] * rng.randrange(3) + ["MIR"] * (rng.random() < 0.9)
        head += ["RDR"] * (rng.random() < 0.5) + ["SDR"] * rng.randrange(3)
        body = [rng.choice(["PIR", "PTR", "PRR", "PTR", "HBR", "WCR", "DTR", "GDR"]) for _ in range(rng.randrange(6))]
        if rng.random() < 0.4:
            body.insert(rng.randrange(len(body) + 1), rng.choice(["MRR", "SDR", "RDR", "ATR", "MIR", "FAR", "???", "WCR"]))
        out.append((head + body + ["MRR"] * (rng.random() < 0.8)) or ["FAR"])
    return out


@pytest.mark.parametrize("strict", [False, True])
def test_validation_equals_sequential_reading(spark, strict):
    cases = sequences()
    rows = [(f"f{i}", n + 1, t) for i, seq in enumerate(cases) for n, t in enumerate(seq)]
    df = spark.createDataFrame(rows, "path string, record_index long, record_type string").repartition(8)
    got = {x.path: (x.message, x.valid) for x in q.validate_files(df, strict).collect()}
    for i, seq in enumerate(cases):
        want = sequential(seq, strict)
        assert got[f"f{i}"] == (want, want == q.VALID), seq
    assert len({m for m, _ in got.values()}) >= 7


def test_one_file_in_many_pieces(spark, monkeypatch):
    """A file's records over many partitions and batches, in any order, read once."""
    monkeypatch.setattr(q, "PIECES", 50)
    rng = random.Random(8)
    files = {}
    for i in range(12):
        seq = ["FAR", "ATR", "MIR", "RDR", "SDR"] + ["PTR"] * rng.randrange(300) + ["MRR"]
        for _ in range(rng.randrange(3)):
            seq.insert(rng.randrange(len(seq) + 1), rng.choice(["MRR", "WCR", "SDR", "???", "PIR", "DTR"]))
        files[f"f{i}"] = seq
    rows = [(p, n + 1, t) for p, seq in files.items() for n, t in enumerate(seq)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "path string, record_index long, record_type string")
    for strict in (False, True):
        for partitions in (1, 7):
            out = q.validate_files(df.repartition(partitions), strict)
            assert {x.path: x.message for x in out.collect()} == {p: sequential(seq, strict) for p, seq in files.items()}
    assert str(q.validate_files(df)._jdf.queryExecution().executedPlan()).count("Scan ExistingRDD") == 1


def test_a_large_file_is_validated_from_its_ranges(spark, tmp_path):
    head = [("MIR", {}), ("SDR", {})]
    body = [("PTR", {"TEST_NUM": i, "TEST_TXT": "x" * 50}) for i in range(3000)]
    for name, records in {"good": head + body + [("MRR", {})], "two": head + body + [("MRR", {})] * 2, "sdr": head + body + head, "short": head}.items():
        (tmp_path / f"{name}.stdf").write_bytes(datalog(records))
    frames = stdf_frames(stdf_files(spark, str(tmp_path), inline_bytes=10), split_bytes=20_000)
    out = {x.path.rsplit("/", 1)[1]: x.message for x in q.validate_files(record_type_column(frames)).collect()}
    assert out == {"good.stdf": q.VALID, "two.stdf": q.TWO_MRR, "sdr.stdf": q.OUTSIDE, "short.stdf": q.EOF}


def test_compare_counts_and_summary(spark):
    a = spark.createDataFrame([("PTR",)] * 200 + [("MIR",)] + [("WCR",)], "record_type string")
    b = spark.createDataFrame([("PTR",)] * 50 + [("MIR",)] + [("DTR",)], "record_type string")
    counts = q.compare_record_counts(a, b)
    assert {x.record_type: (x.diff, x.status, x.presence) for x in counts.collect()} == {
        "PTR": (-150, "different", "both"), "MIR": (0, "equal", "both"), "WCR": (-1, "close", "missing"), "DTR": (1, "close", "unexpected"),
    }
    total = q.compare_summary(counts).collect()[0]
    assert (total.total_diff, total.rating, total.exact_match_percent) == (150, "good", 25.0)


def test_record_stats_keeps_null_types_apart(spark):
    df = spark.createDataFrame([("a", "PTR"), ("a", None), ("b", "PTR")], "path string, record_type string")
    rows = {(x.path, x.record_type): x.n_records for x in stats.record_stats(df).collect()}
    assert rows == {("a", "PTR"): 1, ("a", None): 1, ("b", "PTR"): 1, ("a", "TOTAL"): 2, ("b", "TOTAL"): 1, ("TOTAL", "TOTAL"): 3}


def test_field_config(spark):
    config = {"field_extraction_rules": {"PTR": {"enabled": True, "fields": ["TEST_NUM", "NOPE"]}, "QQQ": {"fields": []}, "MPR": {"enabled": False}}}
    problems = {(x.record_type, x.field): x.problem for x in r.validate_fields(spark, config).collect()}
    assert problems == {("PTR", "NOPE"): "unknown field", ("QQQ", None): "unknown type"}
    df = spark.createDataFrame([("PTR", {"TEST_NUM": "1", "RESULT": "2"}), ("MPR", {"TEST_NUM": "1"})], "record_type string, fields map<string,string>")
    config["field_extraction_rules"].pop("QQQ")
    assert [(x.record_type, x.fields) for x in r.select_fields(df, config).collect()] == [("PTR", {"TEST_NUM": "1"})]


def test_distinct_entities_approximate(spark):
    df = spark.range(1000).select((F.col("id") % 50).cast("string").alias("a"), F.lit("").alias("b"))
    exact = {x.entity: x.n_distinct for x in stats.distinct_entities(df, ["a", "b"]).collect()}
    near = {x.entity: x.n_distinct for x in stats.distinct_entities(df, ["a", "b"], approximate=True).collect()}
    assert exact.get("a") == 50 and abs(near["a"] - 50) <= 5 and near["b"] == 0
