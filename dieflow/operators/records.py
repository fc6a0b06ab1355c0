"""Choosing record types and fields; records as text maps."""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dieflow.functions.binary import bits_hex, bytes_hex
from dieflow.functions.numbers import fixed_six, six_digits
from dieflow.sources.frames import record_codes
from dieflow.sources.registry import DEFAULT_TYPES, TEST_TYPES, field_names, layout_of, registry_frame

TEST_COLUMNS = ["path", "record_index", "record_type", "test_num", "test_flg", "alarm_id", "test_txt", "result", "rtn_rslt", "units"]


def filter_record_types(df: DataFrame, types: tuple[str, ...] = DEFAULT_TYPES) -> DataFrame:
    """Keep the enabled record types."""
    return df.filter(F.col("record_type").isin(*types))


def test_records(df: DataFrame, types: tuple[str, ...] = TEST_TYPES) -> DataFrame:
    """Keep test results; bins may be asked for too."""
    return filter_record_types(df, types)


def extract_records(frames: DataFrame, types: list[str]) -> DataFrame:
    """Raw records of the chosen types; the file header always stays."""
    codes = sorted(record_codes([*types, "FAR"]))
    return frames.filter((F.col("rec_typ").cast("int") * 256 + F.col("rec_sub")).isin(*codes))


def union_tests(*tests: DataFrame) -> DataFrame:
    """One test list out of several record types; missing columns become NULL."""
    shaped = [_test_shape(t) for t in tests]
    out = shaped[0]
    for other in shaped[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def _test_shape(df: DataFrame) -> DataFrame:
    present = {c.lower(): c for c in df.columns}
    columns = [F.col(present[c]).alias(c) for c in TEST_COLUMNS if c in present]
    shaped = df.select(*columns)
    casts = {"result": "double", "rtn_rslt": "array<double>", "test_num": "bigint", "test_flg": "int"}
    if isinstance(shaped.schema["rtn_rslt"].dataType if "rtn_rslt" in shaped.columns else None, T.StringType):
        casts.pop("rtn_rslt")
    if isinstance(shaped.schema["result"].dataType if "result" in shaped.columns else None, T.StringType):
        casts.pop("result")
    return shaped.withColumns({c: F.col(c).cast(t) for c, t in casts.items() if c in shaped.columns})


def first_n_per_type(df: DataFrame, n: int, by: str = "record_type", order: tuple[str, ...] = ("path", "record_index")) -> DataFrame:
    """First n rows of each type. The rank filter is applied before the shuffle too."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


# --- field configuration -------------------------------------------------------------


def load_field_config(config: str | dict) -> dict[str, list[str]]:
    """Enabled types and their fields; an empty list in the JSON means all fields."""
    rules = (json.loads(config) if isinstance(config, str) else config)["field_extraction_rules"]
    return {
        t: rule.get("fields") or field_names(t)
        for t, rule in rules.items()
        if rule.get("enabled", True)
    }


def select_fields(records: DataFrame, config: str | dict) -> DataFrame:
    """Keep enabled types and, in each ``fields`` map, the configured names."""
    chosen = load_field_config(config)
    allowed = F.create_map(*[c for t, names in chosen.items() for c in (F.lit(t), F.array(*map(F.lit, names)))])
    kept = F.map_filter("fields", lambda name, _: F.array_contains(allowed[F.col("record_type")], name))
    return records.filter(F.col("record_type").isin(*chosen)).withColumn("fields", kept)


def validate_fields(spark: SparkSession, config: str | dict) -> DataFrame:
    """Requested (record_type, field) pairs the registry does not know, with the reason."""
    rules = (json.loads(config) if isinstance(config, str) else config)["field_extraction_rules"]
    rows = [(t, f) for t, rule in rules.items() for f in (rule.get("fields") or [None])]
    asked = spark.createDataFrame(rows, "record_type string, field string")
    return unknown_fields(asked, registry_frame(spark))


def unknown_fields(asked: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs in ``asked`` missing from ``known``: unknown type or unknown field."""
    types = known.select("record_type").distinct().withColumn("_known", F.lit(True))
    missing = asked.join(known.select("record_type", "field"), ["record_type", "field"], "left_anti")
    reason = F.when(F.col("_known").isNull(), "unknown type").otherwise("unknown field")
    rated = missing.join(types, "record_type", "left").withColumn("problem", reason).drop("_known")
    return rated.filter((F.col("problem") == "unknown type") | F.col("field").isNotNull())


# --- text form ---------------------------------------------------------------------


def field_text(name: str, data_type: T.DataType) -> Column:
    """Text form of one decoded field; NULL (absent) fields take their default first."""
    col = F.col(name)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return fixed_six(F.coalesce(col, F.lit(0.0)))
    if isinstance(data_type, T.ArrayType):
        if isinstance(data_type.elementType, (T.FloatType, T.DoubleType)):
            return F.concat_ws(",", F.transform(col, six_digits))
        if isinstance(data_type.elementType, T.StructType):
            return F.concat_ws(",", F.transform(col, lambda v: F.concat_ws(":", v["tag"], v["value"])))
        return F.concat_ws(",", F.transform(col, lambda v: v.cast("string")))
    if isinstance(data_type, T.StructType):
        return F.coalesce(bits_hex(col), F.lit(""))
    if isinstance(data_type, T.BinaryType):
        return F.coalesce(bytes_hex(col), F.lit(""))
    if isinstance(data_type, T.NumericType):
        return F.coalesce(col, F.lit(0)).cast("string")
    return F.coalesce(col, F.lit(""))


def record_fields(decoded: DataFrame, record_type: str) -> DataFrame:
    """Typed rows to (path, record_index, record_type, fields map of text)."""
    schema = {f.name: f.dataType for f in decoded.schema}
    names = [f.name for f in layout_of(record_type).fields if f.name in schema]
    pairs = [c for n in names for c in (F.lit(n), field_text(n, schema[n]))]
    fields = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return decoded.select("path", "record_index", F.lit(record_type).alias("record_type"), fields.alias("fields"))


def field_coverage(records: DataFrame, expected: DataFrame) -> DataFrame:
    """Per type: distinct names seen, share of the expected ones, and whether it reaches 80 %.

    ``expected`` holds (record_type, field). Names are reduced per task before the shuffle.
    """
    seen = records.select("record_type", F.explode(F.map_keys("fields")).alias("field")).distinct()
    counted = seen.groupBy("record_type").agg(F.count("*").alias("n_fields"))
    want = expected.select("record_type", "field").distinct()
    hit = want.join(seen.withColumn("_seen", F.lit(1)), ["record_type", "field"], "left")
    share = hit.groupBy("record_type").agg(
        F.count("*").alias("n_expected"), F.count("_seen").alias("n_found"), F.avg(F.coalesce("_seen", F.lit(0))).alias("coverage")
    )
    return share.join(counted, "record_type", "left").select(
        "record_type", F.coalesce("n_fields", F.lit(0)).alias("n_fields"), "n_expected", "n_found",
        "coverage", (F.col("coverage") >= 0.8).alias("covered"),
    )
