"""Scalar functions on the given tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.views import NUMBER_PREFIX, SAFE_FLOAT, VALUES_SKIP, table, view, with_views
from dieflow import functions as fn
from dieflow.functions.sqlfunctions import register_sql_functions
from dieflow.sources.decode import decode_other
from dieflow.sources.frames import stdf_frames
from fixtures.datalogs import datalog_files

KEYS = ("path", "record_index")


@query("F1_safe_float", with_views(
    f"SELECT path, record_index, {SAFE_FLOAT.format(x='result')} AS result, {SAFE_FLOAT.format(x='rtn_rslt')} AS rtn_rslt FROM test_records",
    "test_records"))
def _(spark, sf):
    df = view(spark, sf, "test_records")
    return df.select(*KEYS, fn.safe_float(F.col("result")).alias("result"), fn.safe_float(F.col("rtn_rslt")).alias("rtn_rslt"))


@query("F2_safe_int", with_views(
    f"SELECT path, record_index, CAST(trunc({SAFE_FLOAT.format(x='result')}) AS INT) AS whole, "
    f"CAST(trunc({SAFE_FLOAT.format(x='neg')}) AS INT) AS negative FROM (SELECT *, concat('-', result) AS neg FROM test_records)",
    "test_records"))
def _(spark, sf):
    df = view(spark, sf, "test_records")
    return df.select(*KEYS, fn.safe_int(F.col("result")).alias("whole"), fn.safe_int(F.concat(F.lit("-"), "result")).alias("negative"))


@query("F3_safe_uint", with_views(
    "SELECT event_id, CAST(least(greatest(test_num * 20 - 100, 0), 255) AS SMALLINT) AS u8, "
    "greatest(test_num - 25, 0) AS u64, CAST(0 AS BIGINT) AS malformed FROM landing", "landing"))
def _(spark, sf):
    df = view(spark, sf, "landing")
    return df.select(
        "event_id", fn.safe_uint(F.col("test_num") * 20 - 100, 8).alias("u8"),
        fn.safe_uint((F.col("test_num") - 25).cast("string")).cast("bigint").alias("u64"),
        fn.safe_uint(F.col("alarm_id")).cast("bigint").alias("malformed"),
    )


@query("F4_number_prefix", with_views(
    f"SELECT path, record_index, {NUMBER_PREFIX.format(x='t')} AS number, TRY_CAST(nullif(regexp_extract(t, '^\\s*([+-]?\\d+)', 1), '') AS INT) AS whole "
    "FROM (SELECT *, concat(' ', result, 'V') AS t FROM test_records)", "test_records"))
def _(spark, sf):
    text = F.concat(F.lit(" "), "result", F.lit("V"))
    return view(spark, sf, "test_records").select(*KEYS, fn.number_prefix(text).alias("number"), fn.int_prefix(text).alias("whole"))


_ZERO = ("list_transform(list_filter(string_split({x}, ','), lambda z: trim(z) <> ''), lambda z: " + SAFE_FLOAT.format(x="z") + ")")


@query("F5_parse_values", with_views(
    f"""SELECT path, record_index, mode, CAST(pos AS INT) AS pos, v[pos + 1] AS value FROM (
  SELECT path, record_index, mode, CASE WHEN len(v) = 0 THEN [0.0] ELSE v END AS v FROM (
    SELECT path, record_index, 'skip' AS mode, {VALUES_SKIP.format(x='rtn_rslt')} AS v FROM test_records
    UNION ALL SELECT path, record_index, 'zero', {_ZERO.format(x='rtn_rslt')} FROM test_records)) x,
  LATERAL (SELECT unnest(range(len(x.v))) AS pos) u""", "test_records"))
def _(spark, sf):
    df = view(spark, sf, "test_records")
    modes = F.create_map(*[c for m in ("skip", "zero") for c in (F.lit(m), fn.parse_values(F.col("rtn_rslt"), m))])
    return df.select(*KEYS, F.explode(modes).alias("mode", "v")).select(*KEYS, "mode", F.posexplode("v").alias("pos", "value"))


@query("F7_pixel_xy", with_views(r"""
SELECT path, record_index, TRY_CAST(nullif(regexp_extract(alarm_id, 'Pixel=R(\d+)C(\d+)', 2), '') AS INT) AS x,
       TRY_CAST(nullif(regexp_extract(alarm_id, 'Pixel=R(\d+)C(\d+)', 1), '') AS INT) AS y,
       TRY_CAST(nullif(regexp_extract(alarm_id, 'Pixel=R(\d+)C(\d+)', 1), '') AS INT) AS row_first FROM test_records""", "test_records"))
def _(spark, sf):
    pixel, swapped = fn.pixel_xy(F.col("alarm_id")), fn.pixel_xy(F.col("alarm_id"), "row_col")
    return view(spark, sf, "test_records").select(*KEYS, pixel["x"].alias("x"), pixel["y"].alias("y"), swapped["x"].alias("row_first"))


@query("F8_coordinates", with_views(r"""
SELECT path, record_index, coalesce(ax, tx, dx) AS x, coalesce(ay, ty, dy) AS y,
       coalesce(nullif(CASE WHEN alarm_id <> '' THEN ax ELSE tx END, 0), dx) AS zx,
       coalesce(nullif(CASE WHEN alarm_id <> '' THEN ay ELSE ty END, 0), dy) AS zy FROM (
  SELECT *, CAST(record_index % 7 AS INT) AS dx, CAST(test_num AS INT) AS dy,
    TRY_CAST(nullif(regexp_extract(alarm_id, 'Pixel=R(\d+)C(\d+)', 2), '') AS INT) AS ax,
    TRY_CAST(nullif(regexp_extract(alarm_id, 'Pixel=R(\d+)C(\d+)', 1), '') AS INT) AS ay,
    TRY_CAST(nullif(regexp_extract(test_txt, 'Pixel=R(\d+)C(\d+)', 2), '') AS INT) AS tx,
    TRY_CAST(nullif(regexp_extract(test_txt, 'Pixel=R(\d+)C(\d+)', 1), '') AS INT) AS ty FROM test_records)""", "test_records"))
def _(spark, sf):
    args = (F.col("alarm_id"), F.col("test_txt"), (F.col("record_index") % 7).cast("int"), F.col("test_num").cast("int"))
    xy, z = fn.coordinates(*args), fn.coordinates(*args, zero_is_missing=True)
    return view(spark, sf, "test_records").select(*KEYS, xy["x"].alias("x"), xy["y"].alias("y"), z["x"].alias("zx"), z["y"].alias("zy"))


@query("F9_clean_param", with_views(
    r"SELECT path, record_index, regexp_replace(regexp_replace(alarm_id, ';Pixel=R\d+C\d+', '', 'g'), '^Pixel=R\d+C\d+;', '') AS name FROM test_records",
    "test_records"))
def _(spark, sf):
    return view(spark, sf, "test_records").select(*KEYS, fn.clean_param(F.col("alarm_id")).alias("name"))


@query("F10_clean_param_modsum", """
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name WHEN p_partkey % 3 = 1 THEN 'modSum' ELSE concat(p_type, ' ', p_brand) END AS name FROM part""")
def _(spark, sf):
    part = table(spark, sf, "part")
    text = (
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit('"'), "p_brand", F.lit(": "), "p_name", F.lit(";modSum;x"), F.lit('"')))
        .when(F.col("p_partkey") % 3 == 1, F.lit("'modSum'"))
        .otherwise(F.concat(F.lit('"'), "p_type", F.lit(" "), "p_brand", F.lit(' "')))
    )
    return part.select("p_partkey", fn.clean_param_modsum(text).alias("name"))


@query("F11_clean_param_basic", with_views(
    "SELECT path, record_index, CASE WHEN alarm_id = '' THEN 'UNKNOWN_PARAM' ELSE trim(alarm_id) END AS name FROM test_records", "test_records"))
def _(spark, sf):
    return view(spark, sf, "test_records").select(*KEYS, fn.clean_param_basic(F.col("alarm_id")).alias("name"))


@query("F12_file_hash", with_views("SELECT path, md5(content) AS file_hash FROM files", "files"))
def _(spark, sf):
    return view(spark, sf, "files").select("path", fn.file_hash(F.col("content")).alias("file_hash"))


@query("F13_pass_flag", r"""
SELECT s_suppkey, CASE WHEN TRY_CAST(nullif(regexp_extract(b, '^\s*([+-]?\d+)', 1), '') AS INT) = 1 THEN 1 ELSE 0 END AS flag,
       CASE WHEN TRY_CAST(nullif(regexp_extract(b, '^\s*([+-]?\d+)', 1), '') AS INT) = 1 THEN 'PASS' ELSE 'FAIL' END AS descr
FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 5 = 1 THEN 'bad' ELSE concat(CAST(s_suppkey % 3 AS VARCHAR), 'A') END AS b FROM supplier)""")
def _(spark, sf):
    key = F.col("s_suppkey")
    code = F.when(key % 5 == 0, None).when(key % 5 == 1, "bad").otherwise(F.concat((key % 3).cast("string"), F.lit("A")))
    return table(spark, sf, "supplier").select(key, fn.pass_flag(code).cast("int").alias("flag"), fn.bin_desc(code).alias("descr"))


@query("F14_record_type_name", """
SELECT l_linenumber, CASE l_linenumber % 7 WHEN 0 THEN 'FAR' WHEN 2 THEN 'PTR' ELSE '???' END AS with_sub_10,
       CASE l_linenumber % 7 WHEN 1 THEN 'MRR' WHEN 2 THEN 'FTR' WHEN 5 THEN 'PRR' WHEN 0 THEN 'ATR' ELSE '???' END AS with_sub_20,
       count(*) AS n FROM lineitem GROUP BY ALL""")
def _(spark, sf):
    code = F.col("l_linenumber") % 7
    typ = F.when(code == 0, 0).when(code == 1, 1).when(code == 2, 15).when(code == 5, 5).otherwise(99)
    ten = F.when(code.isin(0, 2), 10).otherwise(11)
    return (
        table(spark, sf, "lineitem")
        .select("l_linenumber", fn.record_type_name(typ, ten).alias("with_sub_10"), fn.record_type_name(typ, F.lit(20)).alias("with_sub_20"))
        .groupBy("l_linenumber", "with_sub_10", "with_sub_20").agg(F.count("*").alias("n"))
    )


@query("F15_json_fields", with_views("""
SELECT event_id, coalesce(TRY_CAST(record_data ->> '$.WTP_ID' AS BIGINT), 0) AS u, coalesce(TRY_CAST(record_data ->> '$.WP_POS_X' AS INT), 0) AS i,
       coalesce(TRY_CAST(record_data ->> '$.RESULT' AS DOUBLE), 0.0) AS f, coalesce(record_data ->> '$.UNITS', '') AS s,
       TRY_CAST(record_data ->> '$.LO_LIMIT' AS DOUBLE) AS maybe, coalesce(len(TRY_CAST(record_data -> '$.RTN_STAT' AS INT[])), 0) AS n_states,
       coalesce(record_data ->> '$.NONE', '') AS absent FROM landing_full""", "landing_full"))
def _(spark, sf):
    names = ["WTP_ID", "WP_POS_X", "RESULT", "UNITS", "LO_LIMIT", "RTN_STAT", "NONE"]
    df = view(spark, sf, "landing_full").withColumn("j", fn.parse_record(F.col("record_data"), names))
    return df.select(
        "event_id", fn.json_uint(F.col("j.WTP_ID")).alias("u"), fn.json_int(F.col("j.WP_POS_X")).alias("i"),
        fn.json_float(F.col("j.RESULT")).alias("f"), fn.json_string(F.col("j.UNITS")).alias("s"),
        fn.json_float_or_null(F.col("j.LO_LIMIT")).alias("maybe"),
        F.size(fn.json_array(F.col("j.RTN_STAT"), "int")).cast("bigint").alias("n_states"), fn.json_string(F.col("j.NONE")).alias("absent"),
    )


@query("F16_normalize_name", "SELECT p_partkey, lower(p_brand) AS name, concat('x_', lower(p_type)) AS kept FROM part")
def _(spark, sf):
    prefix = F.when(F.col("p_partkey") % 3 == 0, "REC_").when(F.col("p_partkey") % 3 == 1, "rec_STDF_").otherwise("Stdf_")
    return table(spark, sf, "part").select(
        "p_partkey", fn.normalize_name(F.concat(prefix, "p_brand")).alias("name"), fn.normalize_name(F.concat(F.lit("X_"), "p_type")).alias("kept"))


@query("F17_nibbles", """
SELECT doc_id, coalesce(array_to_string(list_transform(range(1, doc_id % 33 + 1), lambda i: strpos('0123456789abcdef', substr(md5(text), i, 1)) - 1), ','), '') AS states
FROM documents""")
def _(spark, sf):
    states = fn.nibbles(F.unhex(F.md5("text")), F.col("doc_id") % 33)
    return table(spark, sf, "documents").select("doc_id", fn.values_csv(states).alias("states"))


@query("F18_bytes_hex", "SELECT doc_id, upper(md5(text)) AS bytes, upper(md5(text)) AS bits FROM documents")
def _(spark, sf):
    digest = F.unhex(F.md5("text"))
    return table(spark, sf, "documents").select(
        "doc_id", fn.bytes_hex(digest).alias("bytes"), fn.bits_hex(F.struct(F.lit(128).alias("n_bits"), digest.alias("bits"))).alias("bits"))


@query("F19_values_csv", """
SELECT p_partkey, concat(CAST(CAST(p_size AS DOUBLE) AS VARCHAR), ',', CAST(p_retailprice AS VARCHAR)) AS csv,
       concat(printf('%g', CAST(p_size AS DOUBLE)), ',', printf('%g', p_retailprice)) AS six FROM part""")
def _(spark, sf):
    values = F.array(F.col("p_size").cast("double"), F.col("p_retailprice"))
    return table(spark, sf, "part").select(
        "p_partkey", fn.values_csv(values).alias("csv"), F.concat_ws(",", F.transform(values, fn.six_digits)).alias("six"))


@query("F20_flag_bits", """
SELECT p_partkey, (p_partkey & 1) <> 0 AS new_id, (p_partkey & 2) <> 0 AS new_coord, (p_partkey & 4) <> 0 AS aborted, (p_partkey & 8) <> 0 AS failed,
       (p_partkey & 16) <> 0 AS no_indication, (p_partkey & 1) <> 0 AS min_invalid, (p_partkey & 2) <> 0 AS max_invalid, (p_partkey & 4) <> 0 AS tim_invalid,
       (p_partkey & 16) <> 0 AS sums_invalid, (p_partkey & 32) <> 0 AS sqrs_invalid FROM part""")
def _(spark, sf):
    part, tsr = fn.part_flags(F.col("p_partkey")), fn.tsr_flags(F.col("p_partkey"))
    return table(spark, sf, "part").select(
        "p_partkey", *[part[n].alias(n) for n in ("new_id", "new_coord", "aborted", "failed", "no_indication")],
        *[tsr[n].alias(n) for n in ("min_invalid", "max_invalid", "tim_invalid", "sums_invalid", "sqrs_invalid")])


@query("F21_code_label", """
SELECT p_partkey, CASE substr(p_type, 1, 1) WHEN 'P' THEN 'PRODUCTION' WHEN 'E' THEN 'ENG' WHEN 'M' THEN 'MAINTENANCE' WHEN 'D' THEN 'DEBUG'
       WHEN 'A' THEN 'AEL' WHEN 'C' THEN 'CHECKER' WHEN 'Q' THEN 'QUALITY' END AS mode,
       CASE p_size % 6 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'INCHES' WHEN 2 THEN 'CENTIMETERS' WHEN 3 THEN 'MILLIMETERS' WHEN 4 THEN 'MILS' END AS units FROM part""")
def _(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", fn.code_label("mode", F.substring("p_type", 1, 1)).alias("mode"), fn.code_label("units", F.col("p_size") % 6).alias("units"))


@query("F22_epoch_ts", "SELECT o_orderkey, strftime(TIMESTAMP '1970-01-01 00:00:00' + to_seconds(o_orderkey * 86399), '%Y-%m-%d %H:%M:%S') AS moment FROM orders")
def _(spark, sf):
    moment = F.date_format(fn.epoch_ts(F.col("o_orderkey") * 86399), "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "orders").select("o_orderkey", moment.alias("moment"))


@query("F23_yyyymm", with_views(
    "SELECT year(wptm_created_date) * 100 + month(wptm_created_date) AS yyyymm, count(*) AS n FROM landing GROUP BY 1", "landing"))
def _(spark, sf):
    df = view(spark, sf, "landing")
    return df.select(fn.yyyymm(F.col("wptm_created_date")).cast("bigint").alias("yyyymm")).groupBy("yyyymm").agg(F.count("*").alias("n"))


@query("F24_synthetic_wld_id", with_views("""
SELECT path, record_index, list_sum(list_transform(range(1, 9), lambda i: (strpos('0123456789abcdef', substr(md5(path), i, 1)) - 1) * power(16, 8 - i)))::BIGINT
  % 2147483648 + record_index AS wld_id FROM test_records""", "test_records"))
def _(spark, sf):
    return view(spark, sf, "test_records").select(*KEYS, fn.synthetic_wld_id(F.col("path"), F.col("record_index")).alias("wld_id"))


@query("F25_generic_values", " UNION ALL ".join(
    f"SELECT concat('p', p_partkey, '.stdf', CASE WHEN p_partkey % 3 = 0 THEN '.gz' ELSE '' END) AS path, '{tag}' AS tag, {value} AS value FROM part"
    for tag, value in (("U4", "CAST(p_partkey AS VARCHAR)"), ("Cn", "p_brand"), ("I2", "CAST(-p_size AS VARCHAR)"), ("N1", "CAST(p_size % 16 AS VARCHAR)"))))
def _(spark, sf):
    records = decode_other(stdf_frames(datalog_files(spark, sf), ["GDR"]), "GDR")
    return records.select("path", fn.generic_values(F.col("GEN_DATA")))


@query("E1_sql_functions", with_views(r"""
SELECT path, record_index, {sf} AS value, TRY_CAST(nullif(regexp_extract(alarm_id, 'Pixel=R(\d+)C(\d+)', 2), '') AS INT) AS x,
       TRY_CAST(nullif(regexp_extract(alarm_id, 'Pixel=R(\d+)C(\d+)', 1), '') AS INT) AS y, {np} AS first_value,
       regexp_replace(regexp_replace(alarm_id, ';Pixel=R\d+C\d+', '', 'g'), '^Pixel=R\d+C\d+;', '') AS name,
       contains(alarm_id, 'Pixel=') OR contains(test_txt, 'Pixel=') AS pixel FROM test_records
""".replace("{sf}", SAFE_FLOAT.format(x="result")).replace("{np}", NUMBER_PREFIX.format(x="rtn_rslt")), "test_records"))
def _(spark, sf):
    register_sql_functions(spark)
    view(spark, sf, "test_records").createOrReplaceTempView("test_records")
    return spark.sql("""
        SELECT path, record_index, df_safe_float(result) AS value, df_pixel_x(alarm_id) AS x, df_pixel_y(alarm_id) AS y, df_number_prefix(rtn_rslt) AS first_value,
               df_clean_param(alarm_id) AS name, df_is_pixel_test(alarm_id, test_txt) AS pixel FROM test_records""")
