"""Walking, decoding and rendering datalog bytes derived from the part table."""
from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.views import table
from dieflow.functions import record_type_name
from dieflow.operators import flatten, landing, records as r
from dieflow.session import materialize, scratch_path
from dieflow.sources import decode as d
from dieflow.sources.datasource import register
from dieflow.sources.files import file_manifest, stdf_files
from dieflow.sources.frames import record_type_column, stdf_frames
from dieflow.sources.registry import layout_of, register_record_type, registry_frame, unregister_record_type
from fixtures.datalogs import SEQUENCE, datalog_files, write_files

OTHER = ["FAR", "ATR", "MRR", "PCR", "PMR", "PGR", "PLR", "RDR", "SDR", "WIR", "WRR", "WCR", "PIR", "TSR", "BPS", "EPS", "GDR", "DTR"]
PATH = "concat('p', p_partkey, '.stdf', CASE WHEN p_partkey % 3 = 0 THEN '.gz' ELSE '' END)"
PIXEL = "concat(p_name, ';Pixel=R', p_size % 8, 'C', p_partkey % 4)"
PRICE = "CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE)"


def frames(spark, sf, types=None):
    return stdf_frames(datalog_files(spark, sf), types)


def text_records(spark, sf, types):
    """Decoded records of several types as text maps."""
    raw = materialize(frames(spark, sf, types))  # every type reads the frames again
    out = r.record_fields(d.decode(raw, types[0]), types[0])
    for t in types[1:]:
        out = out.unionByName(r.record_fields(d.decode(raw, t), t))
    return out


@query("S1_stdf_files", "SELECT concat('d', doc_id, '.stdf') AS name, strlen(text) AS length, md5(text) AS file_hash FROM documents")
def _(spark, sf):
    folder = scratch_path(spark, "files")
    docs = table(spark, sf, "documents")
    write_files(docs.select(F.concat(F.lit("d"), "doc_id", F.lit(".stdf")).alias("path"), F.encode("text", "utf-8").alias("content")), folder)
    files = stdf_files(spark, folder)
    return file_manifest(files).select(F.element_at(F.split("path", "/"), -1).alias("name"), "length", "file_hash")


@query("S2_data_source", f"""
SELECT {PATH} AS name, p_partkey AS test_num, {PRICE} AS result, p_type AS units FROM part""")
def _(spark, sf):
    folder = scratch_path(spark, "logs")
    write_files(datalog_files(spark, sf), folder)
    register(spark)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW ptr_of_folder USING stdf OPTIONS (path '{folder}', types 'PTR', fields 'TEST_NUM, RESULT, UNITS')")
    return spark.sql("SELECT element_at(split(path, '/'), -1) AS name, TEST_NUM AS test_num, CAST(RESULT AS DOUBLE) AS result, UNITS AS units FROM ptr_of_folder")


@query("S2_data_source_stream", "SELECT p_partkey AS test_num, p_size AS site_num FROM part")
def _(spark, sf):
    folder, target, check = (scratch_path(spark, n) for n in ("logs", "stream", "check"))
    write_files(datalog_files(spark, sf), folder)
    register(spark)
    rows = spark.readStream.format("stdf").option("types", "MPR").schema("TEST_NUM bigint, SITE_NUM smallint").load(folder)
    for _ in range(2):  # the second run finds nothing new
        rows.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True).start(target).awaitTermination()
    return spark.read.parquet(target).select(F.col("TEST_NUM").alias("test_num"), F.col("SITE_NUM").cast("int").alias("site_num"))


_ORDER = ", ".join(
    f"({i + 2}, {layout_of(t).typ}, {layout_of(t).sub}, '{t}')" for i, t in enumerate(SEQUENCE)
)
_LOG = f"(VALUES (1, 0, 10, 'FAR'), {_ORDER}) AS v(i, typ, sub, name)"


@query("S2_stdf_frames", f"""
SELECT {PATH} AS path, CAST(i AS BIGINT) AS record_index, typ AS rec_typ, sub AS rec_sub, name AS record_type, p_partkey % 2 = 0 AS little_endian, 4 AS stdf_ver
FROM part CROSS JOIN {_LOG}""")
def _(spark, sf):
    return record_type_column(frames(spark, sf)).select(
        "path", "record_index", F.col("rec_typ").cast("int").alias("rec_typ"), F.col("rec_sub").cast("int").alias("rec_sub"), "record_type",
        "little_endian", F.col("stdf_ver").cast("int").alias("stdf_ver"))


@query("P13_extract_records", f"""
SELECT {PATH} AS path, CAST(i AS BIGINT) AS record_index, name AS record_type FROM part CROSS JOIN {_LOG} WHERE name IN ('FAR', 'PTR', 'PRR')""")
def _(spark, sf):
    return record_type_column(r.extract_records(frames(spark, sf), ["PTR", "PRR"])).select("path", "record_index", "record_type")


def _doubles(df, *names):
    return df.withColumns({n: F.col(n).cast("double") for n in names})


@query("S3_decode_ptr", f"""
SELECT {PATH} AS path, p_partkey AS test_num, p_size AS site_num, p_partkey % 4 AS test_flg, {PRICE} AS result, p_brand AS test_txt, {PIXEL} AS alarm_id,
       -3 AS res_scal, -{PRICE} AS lo_limit, {PRICE} AS hi_limit, p_type AS units, '%9.3f' AS c_resfmt, '' AS c_llmfmt, 0.5::DOUBLE AS lo_spec, 1.5::DOUBLE AS hi_spec FROM part""")
def _(spark, sf):
    cols = ["test_num", "site_num", "test_flg", "result", "test_txt", "alarm_id", "res_scal", "lo_limit", "hi_limit", "units", "c_resfmt", "c_llmfmt", "lo_spec", "hi_spec"]
    df = d.decode_ptr(frames(spark, sf, ["PTR"]))
    return _doubles(df.select("path", *[F.col(c).alias(c) for c in cols]), "result", "lo_limit", "hi_limit", "lo_spec", "hi_spec")


@query("S4_decode_mpr", f"""
SELECT {PATH} AS path, p_partkey AS test_num, 3 AS rtn_icnt, 2 AS rslt_cnt, concat('1,', p_size % 16, ',15') AS rtn_stat, {PRICE} AS first_result,
       p_size::DOUBLE AS second_result, concat('7,8,', p_size) AS rtn_indx, {PIXEL} AS alarm_id, p_type AS units, 'V' AS units_in, 0.25::DOUBLE AS incr_in FROM part""")
def _(spark, sf):
    df = d.decode_mpr(frames(spark, sf, ["MPR"]))
    csv = lambda c: F.concat_ws(",", F.transform(c, lambda v: v.cast("string"))).alias(c)
    return _doubles(df.select(
        "path", F.col("TEST_NUM").alias("test_num"), F.col("RTN_ICNT").alias("rtn_icnt"), F.col("RSLT_CNT").alias("rslt_cnt"), csv("rtn_stat"),
        F.col("RTN_RSLT")[0].alias("first_result"), F.col("RTN_RSLT")[1].alias("second_result"), csv("rtn_indx"), F.col("ALARM_ID").alias("alarm_id"),
        F.col("UNITS").alias("units"), F.col("UNITS_IN").alias("units_in"), F.col("INCR_IN").alias("incr_in")), "first_result", "second_result", "incr_in")


@query("S5_decode_ftr", f"""
SELECT {PATH} AS path, p_partkey AS test_num, p_partkey AS cycl_cnt, p_size AS num_fail, -p_partkey AS xfail_ad, -p_size AS vect_off, concat('1,', p_size) AS pgm_indx,
       '3,4' AS pgm_stat, 9 AS fail_bits, '0180' AS fail_pin, p_type AS vect_nam, 'res' AS rslt_txt, 4 AS patg_num, upper(printf('%02x', p_size)) AS spin_map FROM part""")
def _(spark, sf):
    df = d.decode_ftr(frames(spark, sf, ["FTR"]))
    csv = lambda c: F.concat_ws(",", F.transform(c, lambda v: v.cast("string"))).alias(c)
    plain = [F.col(c).alias(c) for c in ("test_num", "cycl_cnt", "num_fail", "xfail_ad", "vect_off", "vect_nam", "rslt_txt", "patg_num")]
    return df.select(
        "path", *plain, csv("pgm_indx"), csv("pgm_stat"), F.col("FAIL_PIN.n_bits").alias("fail_bits"), F.hex("FAIL_PIN.bits").alias("fail_pin"), F.hex("SPIN_MAP.bits").alias("spin_map"))


@query("S6_decode_prr", f"""
SELECT {PATH} AS path, p_size AS site_num, CASE WHEN p_partkey % 2 = 1 THEN 8 ELSE 0 END AS part_flg, 3 AS num_test, p_partkey % 2 AS hard_bin, p_partkey % 3 AS soft_bin,
       p_size - 25 AS x_coord, -(p_partkey % 10) AS y_coord, p_partkey AS test_t, CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat('P', p_partkey) END AS part_id,
       concat('T', p_partkey) AS part_txt, 'ABCD' AS part_fix FROM part""")
def _(spark, sf):
    names = ["site_num", "part_flg", "num_test", "hard_bin", "soft_bin", "x_coord", "y_coord", "test_t", "part_id", "part_txt"]
    return d.decode_prr(frames(spark, sf, ["PRR"])).select("path", *[F.col(c).alias(c) for c in names], F.hex("PART_FIX").alias("part_fix"))


@query("S7_decode_bins", f"""
SELECT {PATH} AS path, 'hard' AS kind, p_partkey % 2 AS bin, p_size AS n, CASE WHEN p_partkey % 2 = 1 THEN 'P' ELSE 'F' END AS pf, p_brand AS name FROM part
UNION ALL SELECT {PATH}, 'soft', p_partkey % 3, p_size, 'F', p_type FROM part""")
def _(spark, sf):
    raw = frames(spark, sf, ["HBR", "SBR"])
    one = lambda df, kind, k: df.select(
        "path", F.lit(kind).alias("kind"), *[F.col(f"{k}BIN_{c}").alias(n) for c, n in (("NUM", "bin"), ("CNT", "n"), ("PF", "pf"), ("NAM", "name"))])
    return one(d.decode_hbr(raw), "hard", "H").unionByName(one(d.decode_sbr(raw), "soft", "S"))


@query("S8_decode_mir", f"""
SELECT {PATH} AS path, p_partkey AS setup_t, 1700000000 + p_partkey AS start_t, p_size AS stat_num, 'P' AS mode_cod, ' ' AS rtst_cod, p_brand AS lot_id, p_type AS part_typ,
       p_name AS job_nam, '' AS facil_id, concat('floor', p_partkey % 3) AS floor_id, 'last' AS supr_nam FROM part""")
def _(spark, sf):
    names = ["setup_t", "start_t", "stat_num", "mode_cod", "rtst_cod", "lot_id", "part_typ", "job_nam", "facil_id", "floor_id", "supr_nam"]
    return d.decode_mir(frames(spark, sf, ["MIR"])).select("path", *[F.col(c).alias(c) for c in names])


_SAMPLES = {
    ("FAR", "STDF_VER"): "'4'", ("ATR", "CMD_LINE"): "p_name", ("MRR", "FINISH_T"): "CAST(p_partkey + 10 AS VARCHAR)", ("PCR", "GOOD_CNT"): "CAST(p_size AS VARCHAR)",
    ("PMR", "CHAN_NAM"): "p_brand", ("PGR", "PMR_INDX"): "concat('1,', p_size, ',3')", ("PLR", "RTN_CHAR"): "concat(',', p_type)", ("PLR", "GRP_RADX"): "'2,16'",
    ("PLR", "RTN_CHAL"): "'a,b'", ("RDR", "RTST_BIN"): "concat(p_size, ',', p_partkey % 1000)", ("SDR", "SITE_NUM"): "concat('1,2,', p_size)", ("SDR", "HAND_TYP"): "p_type",
    ("WIR", "WAFER_ID"): "p_brand", ("WRR", "USR_DESC"): "p_name", ("WCR", "CENTER_X"): "CAST(-p_size AS VARCHAR)", ("WCR", "POS_Y"): "'U'",
    ("WCR", "DIE_HT"): "'0.500000'", ("PIR", "SITE_NUM"): "CAST(p_size AS VARCHAR)", ("TSR", "TEST_NAM"): "p_name", ("TSR", "OPT_FLAG"): "CAST(p_partkey % 64 AS VARCHAR)",
    ("BPS", "SEQ_NAME"): "p_name", ("GDR", "GEN_DATA"): "concat('U4:', p_partkey, ',Cn:', p_brand, ',I2:', -p_size, ',N1:', p_size % 16)", ("DTR", "TEXT_DAT"): "p_name",
}


@query("S9_decode_other", " UNION ALL ".join(
    f"SELECT {PATH} AS path, '{t}' AS record_type, '{f}' AS field, {sql} AS value FROM part" for (t, f), sql in _SAMPLES.items()
) + f" UNION ALL SELECT {PATH}, 'EPS', 'n_fields', '0' FROM part")
def _(spark, sf):
    texts = text_records(spark, sf, OTHER)
    wanted = F.create_map(*[c for t in OTHER for c in (F.lit(t), F.array(*[F.lit(f) for (s, f) in _SAMPLES if s == t]).cast("array<string>"))])
    fields = texts.select("path", "record_type", F.explode("fields").alias("field", "value")).filter(F.array_contains(wanted[F.col("record_type")], F.col("field")))
    empty = texts.filter(F.col("record_type") == "EPS").select("path", "record_type", F.lit("n_fields").alias("field"), F.size("fields").cast("string").alias("value"))
    return fields.unionByName(empty)


_PTR_TEXT = {
    "TEST_NUM": "CAST(p_partkey AS VARCHAR)", "SITE_NUM": "CAST(p_size AS VARCHAR)", "RESULT": f"printf('%.6f', {PRICE})", "TEST_TXT": "p_brand", "ALARM_ID": PIXEL,
    "LO_LIMIT": f"printf('%.6f', -{PRICE})", "UNITS": "p_type", "C_LLMFMT": "''", "HI_SPEC": "'1.500000'",
}
_MPR_TEXT = {"RTN_RSLT": f"concat(printf('%g', {PRICE}), ',', printf('%g', p_size::DOUBLE))", "RTN_STAT": "concat('1,', p_size % 16, ',15')", "RSLT_CNT": "'2'"}


@query("P14_record_fields", " UNION ALL ".join(
    f"SELECT {PATH} AS path, '{t}' AS record_type, '{f}' AS field, {sql} AS value FROM part"
    for t, texts in (("PTR", _PTR_TEXT), ("MPR", _MPR_TEXT)) for f, sql in texts.items()))
def _(spark, sf):
    keep = F.when(F.col("record_type") == "PTR", F.col("field").isin(*_PTR_TEXT)).otherwise(F.col("field").isin(*_MPR_TEXT))
    return text_records(spark, sf, ["PTR", "MPR"]).select("path", "record_type", F.explode("fields").alias("field", "value")).filter(keep)


@query("E1_register_record_type", "SELECT p_partkey, p_size AS a, p_name AS b, concat(p_size, ',', p_size + 1) AS c FROM part")
def _(spark, sf):
    register_record_type("XYZ", 180, 1, [("A", "U2"), ("B", "Cn"), ("N", "U1"), ("C", "xU2[N]")])
    try:
        text = F.encode("p_name", "UTF-8")
        u2 = lambda v: F.unhex(F.lpad(F.hex(v.cast("int")), 4, "0"))
        body = F.concat(u2(F.col("p_size")), F.unhex(F.lpad(F.hex(F.octet_length("p_name")), 2, "0")), text, F.unhex(F.lit("02")), u2(F.col("p_size")), u2(F.col("p_size") + 1))
        raw = table(spark, sf, "part").select(
            F.col("p_partkey").cast("string").alias("path"), F.col("p_partkey").alias("record_index"), F.lit(180).alias("rec_typ"), F.lit(1).alias("rec_sub"),
            F.lit(False).alias("little_endian"), body.alias("body"), F.lit(None).cast("string").alias("error"))
        out = d.decode(raw, "XYZ")
    finally:
        unregister_record_type("XYZ")
    return out.select(F.col("record_index").alias("p_partkey"), F.col("A").alias("a"), F.col("B").alias("b"), F.concat_ws(",", F.transform("C", lambda v: v.cast("string"))).alias("c"))


_CONFIG = {
    "field_extraction_rules": {
        "PTR": {"enabled": True, "fields": ["TEST_NUM", "RESULT", "NOT_A_FIELD"]},
        "MPR": {"enabled": False, "fields": []},
        "PRR": {"enabled": True, "fields": []},
    }
}
_PRR_FIELDS = len(layout_of("PRR").fields)


@query("P2_select_fields", f"""
SELECT {PATH} AS path, 'PTR' AS record_type, 2 AS n_fields, CAST(p_partkey AS VARCHAR) AS test_num FROM part
UNION ALL SELECT {PATH}, 'PRR', {_PRR_FIELDS}, NULL FROM part""")
def _(spark, sf):
    chosen = r.select_fields(text_records(spark, sf, ["PTR", "MPR", "PRR"]), _CONFIG)
    return chosen.select("path", "record_type", F.size("fields").alias("n_fields"), F.col("fields")["TEST_NUM"].alias("test_num"))


@query("P3_validate_fields", f"""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'QQQ' ELSE 'PTR' END AS record_type, CASE WHEN p_partkey % 3 = 1 THEN 'RESULT' ELSE upper(p_brand) END AS field,
       CASE WHEN p_partkey % 3 = 0 THEN 'unknown type' ELSE 'unknown field' END AS problem FROM part WHERE p_partkey % 3 <> 1""")
def _(spark, sf):
    key = F.col("p_partkey")
    asked = table(spark, sf, "part").select(
        key, F.when(key % 3 == 0, "QQQ").otherwise("PTR").alias("record_type"), F.when(key % 3 == 1, "RESULT").otherwise(F.upper("p_brand")).alias("field"))
    return r.unknown_fields(asked, registry_frame(spark)).select("p_partkey", "record_type", "field", "problem")


@query("A14_field_coverage", f"""
SELECT * FROM (VALUES ('PTR', {len(layout_of('PTR').fields)}, {len(layout_of('PTR').fields)}, {len(layout_of('PTR').fields)}, 1.0::DOUBLE, true),
  ('PRR', {_PRR_FIELDS}, {_PRR_FIELDS}, {_PRR_FIELDS}, 1.0::DOUBLE, true), ('EPS', 0, 1, 0, 0.0::DOUBLE, false)) AS v(record_type, n_fields, n_expected, n_found, coverage, covered)
WHERE (SELECT count(*) FROM part) > 0""")
def _(spark, sf):
    expected = registry_frame(spark).filter(F.col("record_type").isin("PTR", "PRR")).select("record_type", "field")
    missing = spark.createDataFrame([("EPS", "NOTHING")], "record_type string, field string")
    return r.field_coverage(text_records(spark, sf, ["PTR", "PRR", "EPS"]), expected.unionByName(missing))


@query("P11_flatten_tests", f"""
SELECT {PATH} AS path, t AS record_type, p_partkey AS test_num, p_size AS site_num, p_brand AS test_txt, CASE WHEN t = 'PTR' THEN printf('%.6f', {PRICE}) END AS result,
       CASE WHEN t = 'MPR' THEN '2' END AS rslt_cnt, CASE WHEN t = 'FTR' THEN CAST(p_size AS VARCHAR) END AS num_fail FROM part CROSS JOIN (VALUES ('PTR'), ('MPR'), ('FTR')) AS v(t)""")
def _(spark, sf):
    return flatten.flatten_tests(text_records(spark, sf, ["PTR", "MPR", "FTR"])).select(
        "path", "record_type", "test_num", "site_num", "test_txt", "result", "rslt_cnt", "num_fail")


@query("P11_flatten_parts", f"""
SELECT {PATH} AS path, t AS record_type, p_size AS site_num, CASE WHEN t = 'PRR' THEN CAST(p_partkey % 2 AS VARCHAR) END AS hard_bin,
       CASE WHEN t = 'HBR' THEN CAST(p_size AS VARCHAR) END AS hbin_cnt, CASE WHEN t = 'SBR' THEN p_type END AS sbin_nam FROM part CROSS JOIN (VALUES ('PRR'), ('HBR'), ('SBR')) AS v(t)""")
def _(spark, sf):
    return flatten.flatten_parts(text_records(spark, sf, ["PRR", "HBR", "SBR"])).select("path", "record_type", "site_num", "hard_bin", "hbin_cnt", "sbin_nam")


@query("P12_to_landing", f"""
SELECT {PATH} AS filename, t AS record_type, p_partkey AS test_num, '1' AS head_num, CAST(p_size AS VARCHAR) AS site_num, CAST(p_partkey % 4 AS VARCHAR) AS test_flag,
       {PIXEL} AS alarm_id, 'h' AS file_hash, CASE WHEN t = 'PTR' THEN CAST(printf('%.6f', {PRICE}) AS DOUBLE) ELSE CAST(printf('%g', {PRICE}) AS DOUBLE) END AS measurement_value,
       p_type AS measurement_unit, CAST(printf('%.6f', -{PRICE}) AS DOUBLE) AS low_limit, p_brand AS test_text, p_type AS json_units
FROM part CROSS JOIN (VALUES ('PTR'), ('MPR')) AS v(t)""")
def _(spark, sf):
    rows = landing.to_landing(text_records(spark, sf, ["PTR", "MPR"]), F.lit("2024-01-01"), F.lit("h"))
    return rows.select(
        "filename", "record_type", "test_num", "head_num", "site_num", "test_flag", "alarm_id", "file_hash", "measurement_value", "measurement_unit", "low_limit",
        "test_text", F.get_json_object("record_data", "$.UNITS").alias("json_units"))


@query("F14_names_of_frames", f"SELECT name AS record_type, count(*) AS n FROM part CROSS JOIN {_LOG} GROUP BY name")
def _(spark, sf):
    return frames(spark, sf).groupBy(record_type_name(F.col("rec_typ"), F.col("rec_sub")).alias("record_type")).agg(F.count("*").alias("n"))
