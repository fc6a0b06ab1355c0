"""File validation and comparison of two extractions."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dieflow.functions.text import normalize_name
from dieflow.sources.registry import record_types

# Outcomes of the validation rules.
VALID = "valid"
NOT_FAR = "first record is not FAR"
NO_INITIAL = "initial sequence not found"
NO_MIR = "MIR not located"
EOF = "EOF after initial sequence"
OUTSIDE = "outside of initial sequence"
TWO_MRR = "more than one MRR"
TWO_WCR = "more than one WCR"
UNKNOWN = "unknown record"
MRR_NOT_LAST = "MRR not last"

_HEAD = ("FAR", "ATR", "MIR", "RDR", "SDR")
_CLASSES = (*_HEAD, "MRR", "WCR", "other", "unknown")
# Classes that change nothing when they come twice in a row; the others are counted.
_TWICE = np.array([c not in ("FAR", "MIR", "RDR", "MRR", "WCR") for c in _CLASSES])
_ERRORS = (NOT_FAR, NO_MIR, OUTSIDE, TWO_MRR, TWO_WCR, UNKNOWN)
# Before FAR, before MIR, right behind MIR, behind RDR or SDR; in the body, how many MRR and WCR and whether the last is MRR.
_BODY = [(mrr, wcr, last) for mrr in (0, 1) for wcr in (0, 1) for last in (0, 1)]
_STATES = ["start", "head", "mir", "sdr", *_BODY, *_ERRORS]
# Consecutive record numbers whose pieces are put together first.
PIECES = 1 << 16


def _next(state, kind: str, strict: bool):
    """The state after a record of a class."""
    if state in _ERRORS:
        return state
    if state == "start":
        return "head" if kind == "FAR" else NOT_FAR
    if state == "head":
        return "head" if kind == "ATR" else "mir" if kind == "MIR" else NO_MIR
    if state in ("mir", "sdr"):
        if kind == "SDR" or (kind == "RDR" and state == "mir"):
            return "sdr"
        if strict:
            return 0, 0, int(kind == "MRR")
        state = 0, 0, 0
    mrr, wcr, _ = state
    if kind in _HEAD:
        return OUTSIDE
    if kind == "unknown":
        return UNKNOWN
    if kind == "MRR":
        return TWO_MRR if mrr else (1, wcr, 1)
    if kind == "WCR":
        return TWO_WCR if wcr else (mrr, 1, 0)
    return mrr, wcr, 0


def _table(strict: bool) -> np.ndarray:
    """Per class, the state each state goes to."""
    return np.array([[_STATES.index(_next(s, c, strict)) for s in _STATES] for c in _CLASSES], np.uint8)


def _through(kinds: np.ndarray, begin: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Where each state is after each run of records; the k-th records of all runs are taken together.

    A class that changes nothing when it comes twice in a row counts once, and a run is done
    when all states have ended in errors, so few records of a run are looked at.
    """
    again = np.r_[False, (kinds[1:] == kinds[:-1]) & _TWICE[kinds[1:]]]
    again[begin] = False
    place = np.cumsum(~again) - 1
    kept, at = kinds[~again], place[begin]
    sizes = np.diff(np.r_[at, len(kept)])
    state = np.tile(np.arange(len(_STATES), dtype=np.uint8), (len(begin), 1))
    live, step = np.arange(len(begin)), 0
    while len(live):
        now = table[kept[at[live] + step][:, None], state[live]]
        state[live] = now
        step += 1
        live = live[(sizes[live] > step) & (now < len(_STATES) - len(_ERRORS)).any(1)]
    return state


_PIECE = pa.schema([("path", pa.string()), ("first", pa.int64()), ("states", pa.binary()), ("stretch", pa.int64())])


def _pieces(batches: Iterator[pa.RecordBatch], classes: dict[str, int], table: np.ndarray, stretch: int) -> Iterator[pa.RecordBatch]:
    """Runs of consecutive records in a batch, each as the map from the state before it to the one after."""
    unknown = _CLASSES.index("unknown")
    for batch in batches:
        if not batch.num_rows:
            continue
        paths = batch.column("path").dictionary_encode()
        code, index = paths.indices.to_numpy(zero_copy_only=False), batch.column("record_index").to_numpy(zero_copy_only=False)
        types = batch.column("record_type").dictionary_encode(null_encoding="encode")
        kinds = np.array([classes.get(t, unknown) for t in types.dictionary.to_pylist()])[types.indices.to_numpy(zero_copy_only=False)]
        order = np.lexsort((index, code))
        code, index, kinds = code[order], index[order], kinds[order]
        begin = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (index[1:] != index[:-1] + 1)])
        states = [row.tobytes() for row in _through(kinds, begin, table)]
        columns = [paths.dictionary.take(pa.array(code[begin])), pa.array(index[begin]), pa.array(states, pa.binary()), pa.array(index[begin] // stretch)]
        yield pa.RecordBatch.from_arrays(columns, schema=_PIECE)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of one file and stretch, which come in their order, as one piece."""
    now, first, state = None, 0, None

    def piece():
        return dict(zip(_PIECE.names, (now[0], first, state.tobytes(), now[1])))

    for batch in batches:
        out = []
        for path, at, step, stretch in zip(*(batch.column(c).to_pylist() for c in _PIECE.names)):
            step = np.frombuffer(step, np.uint8)
            if (path, stretch) == now:
                state = step[state]
                continue
            if now is not None:
                out.append(piece())
            now, first, state = (path, stretch), at, step
        yield pa.RecordBatch.from_pylist(out, _PIECE)
    if now is not None:
        yield pa.RecordBatch.from_pylist([piece()], _PIECE)


def validate_files(records: DataFrame, strict: bool = False) -> DataFrame:
    """Per file: path, message of the first broken rule (or ``valid``), valid flag.

    ``records`` holds (path, record_index from 1, record_type), in any order and partitioning. The rules are
    an automaton; a run of records is the map from the state before it to the state after, and
    such maps are put together in order: within a batch before anything is shuffled, then
    within stretches of a file, then per file. The records are read once, and a huge file
    is checked by as many tasks as hold it. ``strict`` leaves the first record after the
    initial sequence unchecked and treats DTR as unknown.
    """
    known = [t for t in record_types() if not (strict and t == "DTR")]
    classes = {t: _CLASSES.index(t if t in _CLASSES else "other") for t in known}
    table, stretch, schema = _table(strict), PIECES, "path string, first bigint, states binary, stretch bigint"
    pieces = records.select("path", F.col("record_index").cast("bigint").alias("record_index"), "record_type").mapInArrow(
        lambda it: _pieces(it, classes, table, stretch), schema
    )
    # First within stretches of a file, then per file; a stretch number keeps apart what does not touch.
    stretches = pieces.repartition("path", "stretch").sortWithinPartitions("path", "first").mapInArrow(_joined, schema)
    whole = stretches.withColumn("stretch", F.lit(0).cast("bigint")).repartition("path").sortWithinPartitions("path", "first").mapInArrow(_joined, schema)
    ends = [NO_INITIAL if s in ("start", "head") else EOF if s in ("mir", "sdr") else s if s in _ERRORS else VALID if s[2] else MRR_NOT_LAST for s in _STATES]
    # The state a whole file leads to from the first one.
    state = F.conv(F.substring(F.hex("states"), 1, 2), 16, 10).cast("int")
    outcome = F.element_at(F.array(*map(F.lit, ends)), state + 1)
    return whole.select("path", outcome.alias("message"), (outcome == VALID).alias("valid"))


# Bounds of the comparison report.
_CLOSE, _NOTABLE = 100, 1000


def compare_record_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Per record type: both counts, difference, status, and which side lacks the type."""
    a = left.groupBy("record_type").agg(F.count("*").alias("left_count"))
    b = right.groupBy("record_type").agg(F.count("*").alias("right_count"))
    both = a.join(b, "record_type", "full_outer").fillna(0, ["left_count", "right_count"])
    diff = F.col("right_count") - F.col("left_count")
    return both.select(
        "record_type", "left_count", "right_count", diff.alias("diff"),
        F.when(diff == 0, "equal").when(F.abs(diff) < _CLOSE, "close").otherwise("different").alias("status"),
        F.when(F.col("right_count") == 0, "missing").when(F.col("left_count") == 0, "unexpected").otherwise("both").alias("presence"),
    )


def compare_summary(counts: DataFrame) -> DataFrame:
    """One row over ``compare_record_counts``: totals, accuracy percent, exact-match rate, rating."""
    totals = counts.agg(
        F.sum("left_count").alias("left_total"), F.sum("right_count").alias("right_total"),
        F.count("*").alias("types"), F.count_if(F.col("diff") == 0).alias("exact_types"),
    )
    diff = F.abs(F.col("right_total") - F.col("left_total"))
    largest = F.nullif(F.greatest("left_total", "right_total"), F.lit(0))
    return totals.select(
        "left_total", "right_total", diff.alias("total_diff"),
        F.coalesce((1 - diff / largest) * 100.0, F.lit(100.0)).alias("accuracy_percent"),
        (F.col("exact_types") * 100.0 / F.nullif(F.col("types"), F.lit(0))).alias("exact_match_percent"),
        F.when(diff == 0, "perfect").when(diff < _CLOSE, "excellent").when(diff < _NOTABLE, "good").otherwise("different").alias("rating"),
    )


# The fields every comparison must report.
KEY_FIELDS = ("test_flg", "test_num", "head_num", "site_num", "result")


def compare_fields(left: DataFrame, right: DataFrame, keys: tuple[str, ...] = ("path", "record_index", "record_type")) -> DataFrame:
    """Per record and normalised field name: status with both values, and whether it is a key field.

    Both sides hold the keys and a ``fields`` map of text. Status is equal, different,
    left (only there) or right.
    """

    def texts(df: DataFrame, name: str) -> DataFrame:
        """The record's fields by normalised name; of two that become one, the first."""
        pairs = F.transform(F.map_entries("fields"), lambda e: F.struct(normalize_name(e["key"]).alias("key"), F.trim(F.coalesce(e["value"], F.lit(""))).alias("value")))
        first = F.filter(F.col("_pairs"), lambda e, i: F.array_position(F.col("_pairs.key"), e["key"]) == i + 1)
        return df.select(*keys, pairs.alias("_pairs")).select(*keys, F.map_from_entries(first).alias(name))

    # One row per record is shuffled; fields are told apart only after the join.
    joined = texts(left, "_left").join(texts(right, "_right"), [*keys], "full_outer")
    nothing = F.create_map().cast("map<string,string>")
    both = F.map_zip_with(
        F.coalesce("_left", nothing), F.coalesce("_right", nothing),
        lambda _, a, b: F.struct(
            F.when(b.isNull(), "left").when(a.isNull(), "right").when(a == b, "equal").otherwise("different").alias("status"),
            a.alias("left_value"), b.alias("right_value"),
        ),
    )
    rows = joined.select(*keys, F.explode(both).alias("field", "_found"))
    return rows.select(*keys, "field", "_found.status", "_found.left_value", "_found.right_value", F.col("field").isin(*KEY_FIELDS).alias("is_key"))


def compare_fields_summary(compared: DataFrame) -> DataFrame:
    """Per record type and field: how often each status occurs."""
    n = {s: F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("equal", "different", "left", "right")}
    return compared.groupBy("record_type", "field", "is_key").agg(*n.values())
