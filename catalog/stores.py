"""Sinks, stored tables and streams: written to the shared scratch folder and read back."""
from __future__ import annotations

from pyspark.sql import functions as F

from catalog.binaries import PATH, PIXEL, PRICE, text_records
from catalog.measures import WLD, WTP, devices, with_ids
from catalog.registry import query
from catalog.views import table, view, with_views
from dieflow.operators import dedup, dims, landing, measurements as m
from dieflow.plans import tables as t
from dieflow.plans.landing import load_landing
from dieflow.plans.load import LoadOptions, load_directory
from dieflow.session import scratch_path
from dieflow.sources import atdf, xtdf
from dieflow.sources.frames import stdf_frames
from dieflow.streaming.incremental import incremental_load
from dieflow.streaming.views import landing_stream, start_view
from fixtures.datalogs import datalog_files, lot_files, write_files

ATDF_NAMES = {"PTR": ["NAME", "SIZE", "TYPE"]}


@query("S10_read_atdf", """
SELECT 'PTR' AS record_type, p_name AS name, CAST(p_size AS VARCHAR) AS size, p_type AS type, count(*) AS n FROM part GROUP BY ALL""")
def _(spark, sf):
    path = scratch_path(spark, "atdf")
    view(spark, sf, "atdf_lines").write.text(path)
    rows = atdf.read_atdf(spark, path, ("PTR",), ATDF_NAMES, skip=3)
    field = F.col("fields")
    keys = [field["NAME"].alias("name"), field["SIZE"].alias("size"), field["TYPE"].alias("type")]
    return rows.groupBy("record_type", *keys).agg(F.count("*").alias("n"))


@query("S10_line_numbers", """
SELECT row_number() OVER (ORDER BY p_partkey) AS line, p_name AS name FROM part""")
def _(spark, sf):
    path = scratch_path(spark, "atdf")
    lines = view(spark, sf, "atdf_lines")
    lines.coalesce(1).sortWithinPartitions(F.split_part("line", F.lit("|"), F.lit(2)).try_cast("bigint")).write.text(path)
    rows = atdf.read_atdf(spark, path, ("PTR",), ATDF_NAMES, skip=3)
    return rows.select("line", F.col("fields")["NAME"].alias("name"))


@query("S11_write_atdf", """
SELECT concat_ws('|', 'PTR', CAST(p_partkey AS VARCHAR), p_name, CAST(p_size AS VARCHAR), p_type) AS value FROM part""")
def _(spark, sf):
    path = scratch_path(spark, "atdf")
    fields = F.create_map(F.lit("NAME"), "p_name", F.lit("SIZE"), F.col("p_size").cast("string"), F.lit("TYPE"), F.col("p_type"))
    records = table(spark, sf, "part").select(F.lit("f").alias("path"), F.col("p_partkey").alias("record_index"), F.lit("PTR").alias("record_type"), fields.alias("fields"))
    atdf.write_atdf(records, path, names=ATDF_NAMES)
    return spark.read.text(path)


@query("S11_write_dump", f"""
SELECT value FROM (SELECT unnest(['Record BPS (20,10):', concat(chr(9), 'SEQ_NAME: ', p_name)]) AS value FROM part)""")
def _(spark, sf):
    path = scratch_path(spark, "dump")
    atdf.write_atdf(text_records(spark, sf, ["BPS"]), path, form="dump")
    return spark.read.text(path)


@query("S11_write_dump_lengths", """
SELECT value FROM (SELECT unnest([concat('Record BPS ( 20, 10) ', 1 + strlen(p_name), ' bytes:'), concat(chr(9), 'SEQ_NAME: ', p_name)]) AS value FROM part)""")
def _(spark, sf):
    path = scratch_path(spark, "dump")
    lengths = stdf_frames(datalog_files(spark, sf), ["BPS"]).select("path", "record_index", "rec_len")
    atdf.write_atdf(text_records(spark, sf, ["BPS"]).join(lengths, ["path", "record_index"]), path, form="dump")
    return spark.read.text(path)


@query("S12_write_xtdf", f"SELECT {PATH} AS path, 'PTR' AS record_type, p_brand AS test_txt, {PIXEL} AS alarm_id, printf('%.6f', {PRICE}) AS result FROM part")
def _(spark, sf):
    path = scratch_path(spark, "xtdf")
    xtdf.write_xtdf(text_records(spark, sf, ["PTR"]), path)
    field = F.col("fields")
    return xtdf.read_xtdf(spark, path).select("path", "record_type", field["TEST_TXT"].alias("test_txt"), field["ALARM_ID"].alias("alarm_id"), field["RESULT"].alias("result"))


@query("S13_create_tables", """
SELECT 'device_mapping' AS name, (SELECT count(*) FROM supplier) AS n_rows UNION ALL SELECT 'parameter_info', 0 UNION ALL SELECT 'measurements', 0
UNION ALL SELECT 'device_info', 0 UNION ALL SELECT 'measurements_landing', (SELECT count(*) FROM events) UNION ALL SELECT 'measurements_ptr', 0
UNION ALL SELECT 'measurements_mpr', 0 UNION ALL SELECT 'file_ledger', 0 UNION ALL SELECT 'load_log', 0""")
def _(spark, sf):
    base = scratch_path(spark, "tables")
    names = t.create_tables(spark, base)
    t.write_dimensions(base, devices=table(spark, sf, "supplier").select(F.col("s_suppkey").alias("wld_id"), F.col("s_name").alias("wld_device_dmc")))
    t.write_landing(view(spark, sf, "landing_full"), base)
    counts = [t.read_table(spark, base, n).agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("name"), "n_rows") for n in names]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out


_FACT = f"{WLD} AS wld_id, {WTP} AS wtp_id, wp_pos_x, wp_pos_y, wptm_value, test_flag, segment, md5(path) AS file_hash"


def _fact(spark, sf):
    d, tt = with_ids(spark, sf)
    return m.to_fact(m.numbered_product(d, tt, keep=("wld_id", "wtp_id", "file_hash")), F.lit("2024-01-15 00:00:00"))


@query("S14_write_measurements", with_views(f"SELECT {_FACT}, 202401 AS yyyymm FROM seg", "seg"))
def _(spark, sf):
    base = scratch_path(spark, "tables")
    t.write_measurements(_fact(spark, sf), base)
    return t.read_table(spark, base, "measurements").drop("wptm_created_date").withColumn("test_flag", F.col("test_flag").cast("int"))


@query("S15_write_dimensions", with_views("""
SELECT wld_device_dmc, wld_id FROM existing_devices
UNION ALL SELECT wld_device_dmc, (SELECT max(wld_id) FROM existing_devices) + row_number() OVER (ORDER BY p, i) FROM (
  SELECT wld_device_dmc, min(path) AS p, arg_min(device_index, (path, device_index)) AS i FROM dev
  WHERE wld_device_dmc NOT IN (SELECT wld_device_dmc FROM existing_devices) GROUP BY wld_device_dmc)""", "dev", "existing_devices"))
def _(spark, sf):
    base = scratch_path(spark, "tables")
    t.write_dimensions(base, devices=view(spark, sf, "existing_devices"))
    for _ in range(2):  # the second round finds nothing new
        known = t.read_table(spark, base, "device_mapping")
        t.write_dimensions(base, devices=dims.assign_ids(devices(spark, sf), known, "wld_device_dmc", "wld_id", ("path", "device_index")))
    return t.read_table(spark, base, "device_mapping")


@query("S16_write_landing", with_views("""
SELECT wld_id, record_type, test_num, head_num, site_num, record_data, test_flag, alarm_id, part_txt, segment, file_hash,
       CAST(year(wptm_created_date) * 100 + month(wptm_created_date) AS INT) AS yyyymm FROM landing_full""", "landing_full"))
def _(spark, sf):
    base = scratch_path(spark, "tables")
    t.write_landing(view(spark, sf, "landing_full"), base)
    rows = t.read_table(spark, base, "measurements_landing").drop("wptm_created_date")
    return rows.withColumns({"head_num": F.col("head_num").cast("bigint"), "site_num": F.col("site_num").cast("bigint"), "test_flag": F.col("test_flag").cast("int")})


@query("S17_compact_dedup", with_views(f"SELECT DISTINCT {_FACT} FROM seg", "seg"))
def _(spark, sf):
    base = scratch_path(spark, "tables")
    for _ in range(2):
        t.write_measurements(_fact(spark, sf), base)
    t.compact_dedup(spark, base, "measurements", months=[202401])
    return t.read_table(spark, base, "measurements").drop("wptm_created_date", "yyyymm").withColumn("test_flag", F.col("test_flag").cast("int"))


@query("S17_drop_equal_rows", "SELECT DISTINCT text, lang FROM documents")
def _(spark, sf):
    return dedup.drop_equal_rows(table(spark, sf, "documents").select("text", "lang"))


_PTR_SQL = """
SELECT wld_id, TRY_CAST(record_data ->> '$.WTP_ID' AS BIGINT) AS wtp_id, test_num, head_num, site_num, coalesce(TRY_CAST(record_data ->> '$.RESULT' AS DOUBLE), 0.0) AS result,
       test_flag, record_data ->> '$.UNITS' AS units, TRY_CAST(record_data ->> '$.LO_LIMIT' AS DOUBLE) AS lo_limit, CAST(NULL AS DOUBLE) AS hi_limit, alarm_id,
       CAST(record_data ->> '$.WP_POS_X' AS INT) AS wp_pos_x, CAST(record_data ->> '$.WP_POS_Y' AS INT) AS wp_pos_y, segment, file_hash
FROM landing_full WHERE record_type = 'PTR'"""
_MPR_SQL = """
SELECT wld_id, TRY_CAST(record_data ->> '$.WTP_ID' AS BIGINT) AS wtp_id, test_num, head_num, site_num, CAST(record_data ->> '$.RSLT_CNT' AS INT) AS result_count,
       (record_data ->> '$.TEST_RESULTS[0]')::DOUBLE AS first_result, (record_data ->> '$.TEST_RESULTS[1]')::DOUBLE AS second_result,
       coalesce(len(TRY_CAST(record_data -> '$.RTN_STAT' AS INT[])), 0) AS n_states, test_flag, record_data ->> '$.UNITS' AS units,
       TRY_CAST(record_data ->> '$.LO_LIMIT' AS DOUBLE) AS lo_limit, alarm_id, CAST(record_data ->> '$.WP_POS_X' AS INT) AS wp_pos_x,
       CAST(record_data ->> '$.WP_POS_Y' AS INT) AS wp_pos_y, segment, file_hash
FROM landing_full WHERE record_type = 'MPR'"""


def _plain(df):
    casts = {"head_num": "bigint", "site_num": "bigint", "test_flag": "int"}
    return df.drop("wptm_created_date").withColumns({c: F.col(c).cast(k) for c, k in casts.items()})


def _mpr_plain(df):
    r = F.col("test_results")
    flat = df.withColumns({"first_result": r[0], "second_result": r[1], "n_states": F.size("return_states").cast("bigint")})
    return _plain(flat.drop("test_results", "return_states", "hi_limit"))


@query("T1_ptr_view", with_views(_PTR_SQL, "landing_full"))
def _(spark, sf):
    return _plain(landing.ptr_view(view(spark, sf, "landing_full")))


@query("T2_mpr_view", with_views(_MPR_SQL, "landing_full"))
def _(spark, sf):
    return _mpr_plain(landing.mpr_view(view(spark, sf, "landing_full")))


def _streamed(spark, sf, name):
    base, target, check = (scratch_path(spark, n) for n in ("tables", name, "check"))
    t.write_landing(view(spark, sf, "landing_full"), base)
    start_view(landing_stream(spark, base), target, name, check).awaitTermination()
    return spark.read.parquet(target)


@query("T1_ptr_view_stream", with_views(_PTR_SQL, "landing_full"))
def _(spark, sf):
    return _plain(_streamed(spark, sf, "measurements_ptr"))


@query("T2_mpr_view_stream", with_views(_MPR_SQL, "landing_full"))
def _(spark, sf):
    return _mpr_plain(_streamed(spark, sf, "measurements_mpr"))


@query("P12_landing_chain", f"""
SELECT 'PTR' AS kind, p_partkey AS test_num, p_name AS wtp_param_name, CAST(p_partkey % 4 AS INT) AS wp_pos_x, p_size % 8 AS wp_pos_y, CAST(p_partkey % 4 AS INT) AS test_flag,
       CAST(printf('%.6f', {PRICE}) AS DOUBLE) AS first_result, CAST(NULL AS DOUBLE) AS second_result, 0 AS n_results, CAST(NULL AS INT) AS second_state, 0 AS n_states, p_type AS units, 0 AS segment
FROM part
UNION ALL SELECT 'MPR', p_partkey, p_name, CAST(p_partkey % 4 AS INT), p_size % 8, CAST(p_partkey % 4 AS INT), {PRICE}, CAST(p_size AS DOUBLE), 2, p_size % 16, 3, p_type, 1 FROM part""")
def _(spark, sf):
    base, folder = scratch_path(spark, "tables"), scratch_path(spark, "incoming")
    t.create_tables(spark, base)
    write_files(datalog_files(spark, sf), folder)
    for _ in range(2):  # the second load finds nothing new
        load_landing(spark, folder, base, F.lit("2024-01-15 00:00:00"))
    names = t.read_table(spark, base, "parameter_info")
    number = lambda c: F.size(c).cast("bigint")
    ptr = t.read_table(spark, base, "measurements_ptr").withColumns({
        "kind": F.lit("PTR"), "first_result": F.col("result"), "second_result": F.lit(None).cast("double"), "n_results": F.lit(0).cast("bigint"),
        "second_state": F.lit(None).cast("int"), "n_states": F.lit(0).cast("bigint")})
    results, states = F.col("test_results"), F.col("return_states")
    mpr = t.read_table(spark, base, "measurements_mpr").withColumns({
        "kind": F.lit("MPR"), "first_result": results[0], "second_result": results[1], "n_results": number(results),
        "second_state": states[1].cast("int"), "n_states": number(states)})
    columns = ["kind", "test_num", "wtp_param_name", "wp_pos_x", "wp_pos_y", F.col("test_flag").cast("int").alias("test_flag"), "first_result", "second_result",
               "n_results", "second_state", "n_states", "units", "segment"]
    return ptr.join(names, "wtp_id").select(*columns).unionByName(mpr.join(names, "wtp_id").select(*columns))


# The same load with rows before columns and duplicates told apart by the raw test flag; all parts' pixels are named by their alarm.
@query("T3_load_options", f"""
SELECT wld_device_dmc, wtp_param_name, wp_pos_x, wp_pos_y, wptm_value,
       row_number() OVER (PARTITION BY lot, wld_device_dmc, wtp_param_name, wp_pos_x, wp_pos_y, flg ORDER BY s_suppkey, p_partkey, pos) - 1 AS segment
FROM (SELECT s_suppkey % 8 AS lot, s_suppkey, p_partkey, pos, CASE WHEN s_suppkey % 7 = 0 THEN concat('T', s_suppkey) ELSE concat('S', s_suppkey % 500) END AS wld_device_dmc,
        p_name AS wtp_param_name, p_size % 8 AS wp_pos_x, CAST(p_partkey % 4 AS INT) AS wp_pos_y, p_partkey % 4 AS flg,
        CASE WHEN p_partkey % 3 = 2 THEN 0.0 WHEN pos = 1 THEN p_size::DOUBLE ELSE {PRICE} END AS wptm_value
      FROM part JOIN supplier ON p_partkey % 8 = s_suppkey % 8 CROSS JOIN (VALUES (0), (1)) AS v(pos) WHERE pos = 0 OR p_partkey % 3 = 1)""")
def _(spark, sf):
    base, folder = scratch_path(spark, "tables"), scratch_path(spark, "incoming")
    write_files(lot_files(spark, sf, 8), folder)
    options = LoadOptions(pixel_mode="hints", param_source="alarm_only", axis_order="row_col", values="strict", mir_variant="direct", segment_flag="test_flg")
    load_directory(spark, folder, base, F.lit("2024-01-15 00:00:00"), options=options)
    fact = t.read_table(spark, base, "measurements")
    named = fact.join(t.read_table(spark, base, "device_mapping"), "wld_id").join(t.read_table(spark, base, "parameter_info"), "wtp_id")
    return named.select("wld_device_dmc", "wtp_param_name", "wp_pos_x", "wp_pos_y", "wptm_value", "segment")


@query("T3_incremental_load", f"""
SELECT wld_device_dmc, wtp_param_name, wp_pos_x, wp_pos_y, wptm_value, test_flag,
       row_number() OVER (PARTITION BY lot, wld_device_dmc, wtp_param_name, wp_pos_x, wp_pos_y, test_flag ORDER BY s_suppkey, p_partkey, pos) - 1 AS segment
FROM (SELECT s_suppkey % 8 AS lot, s_suppkey, p_partkey, pos, CASE WHEN s_suppkey % 7 = 0 THEN concat('T', s_suppkey) ELSE concat('S', s_suppkey % 500) END AS wld_device_dmc,
        p_name AS wtp_param_name, CAST(p_partkey % 4 AS INT) AS wp_pos_x, p_size % 8 AS wp_pos_y,
        CASE WHEN p_partkey % 3 = 2 THEN 0.0 WHEN pos = 1 THEN p_size::DOUBLE ELSE {PRICE} END AS wptm_value, CASE WHEN s_suppkey % 3 = 1 THEN 1 ELSE 0 END AS test_flag
      FROM part JOIN supplier ON p_partkey % 8 = s_suppkey % 8 CROSS JOIN (VALUES (0), (1)) AS v(pos) WHERE pos = 0 OR p_partkey % 3 = 1)""")
def _(spark, sf):
    base, folder, check = (scratch_path(spark, n) for n in ("tables", "incoming", "check"))
    write_files(lot_files(spark, sf, 8), folder, prefixes=("", "again-"))  # every content under two names
    incremental_load(spark, folder, base, f"{check}-1", F.lit("2024-01-15 00:00:00")).awaitTermination()
    # A restart that has lost its checkpoint sees every file again and must add nothing.
    incremental_load(spark, folder, base, f"{check}-2", F.lit("2024-01-15 00:00:00")).awaitTermination()
    fact = t.read_table(spark, base, "measurements")
    named = fact.join(t.read_table(spark, base, "device_mapping"), "wld_id").join(t.read_table(spark, base, "parameter_info"), "wtp_id")
    return named.select("wld_device_dmc", "wtp_param_name", "wp_pos_x", "wp_pos_y", "wptm_value", F.col("test_flag").cast("int").alias("test_flag"), "segment")
