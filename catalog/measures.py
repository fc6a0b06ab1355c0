"""Measurements, ids, segments and file dedup on the given tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query
from catalog.views import VALUES_SKIP, view, with_views
from dieflow import functions as fn
from dieflow.operators import dedup, dims, measurements as m, records as r

FLOW = [
    "path", "device_index", "record_index", "value_pos", "wld_device_dmc", "wtp_param_name", "wp_pos_x", "wp_pos_y", "wptm_value", "test_flag",
]


def devices(spark, sf):
    return m.device_context(view(spark, sf, "devices"))


def tests(spark, sf, **options):
    return m.prepare_tests(view(spark, sf, "test_records"), **options)


def product(spark, sf):
    return m.device_test_product(devices(spark, sf), tests(spark, sf))


def counted(spark, sf, *columns):
    """The product counted by some of its columns."""
    return m.counted_product(devices(spark, sf), tests(spark, sf), list(columns))


def with_ids(spark, sf):
    """Devices and tests with ids by name order, for the projections."""
    known = dims.attach_ids(devices(spark, sf), name_ids(devices(spark, sf), "wld_device_dmc", "wld_id"), "wld_device_dmc", "wld_id")
    named = dims.attach_ids(tests(spark, sf), name_ids(tests(spark, sf), "wtp_param_name", "wtp_id"), "wtp_param_name", "wtp_id")
    return known.withColumn("file_hash", F.md5("path")), named


def name_ids(df, name, id_column):
    """Repeatable ids without an order: the hash of the name."""
    return df.select(name).distinct().withColumn(id_column, F.conv(F.substring(F.md5(name), 1, 7), 16, 10).cast("bigint"))


_HEX = "(list_sum(list_transform(range(1, 8), lambda i: (strpos('0123456789abcdef', substr(md5({x}), i, 1)) - 1) * power(16, 7 - i)))::BIGINT)"
WLD, WTP = _HEX.format(x="wld_device_dmc"), _HEX.format(x="wtp_param_name")


@query("F6_test_values", with_views(f"""
SELECT path, record_index, len(v) AS n, v[1] AS first_value, v[len(v)] AS last_value FROM (
  SELECT path, record_index, CASE WHEN len(v) = 0 THEN [0.0] ELSE v END AS v FROM (
    SELECT path, record_index, CASE WHEN record_type = 'PTR' AND coalesce(TRY_CAST(result AS DOUBLE), 0) <> 0 THEN [CAST(result AS DOUBLE)]
      ELSE {VALUES_SKIP.format(x="coalesce(nullif(rtn_rslt, ''), nullif(result, ''), test_txt)")} END AS v FROM test_records))""", "test_records"))
def _(spark, sf):
    df = view(spark, sf, "test_records")
    v = F.col("v")
    return df.withColumn("v", m.test_values(df)).select(
        "path", "record_index", F.size(v).cast("bigint").alias("n"), v[0].alias("first_value"), F.element_at(v, -1).alias("last_value"))


@query("F6_test_values_text_first", with_views("""
SELECT path, record_index, CASE WHEN rtn_rslt <> '' THEN 3 ELSE 1 END AS n,
       CASE WHEN rtn_rslt <> '' THEN CAST(split_part(rtn_rslt, ',', 1) AS DOUBLE) ELSE 0.0 END AS first_value,
       CASE WHEN result <> '' THEN CAST(result AS DOUBLE) ELSE 0.0 END AS strict_value FROM test_records""", "test_records"))
def _(spark, sf):
    df = view(spark, sf, "test_records")
    return df.withColumn("v", m.test_values(df, "text_first")).withColumn("s", m.test_values(df, "strict")).select(
        "path", "record_index", F.size("v").cast("bigint").alias("n"), F.col("v")[0].alias("first_value"), F.col("s")[0].alias("strict_value"))


@query("P4_test_records", with_views("SELECT * FROM test_records WHERE record_type IN ('PTR', 'MPR')", "test_records"))
def _(spark, sf):
    return r.test_records(view(spark, sf, "test_records"), ("PTR", "MPR"))


@query("P5_pixel_tests", with_views("""
SELECT path, record_index, contains(alarm_id, 'Pixel=') OR contains(test_txt, 'Pixel=') AS strict,
       regexp_matches(alarm_id, '[Pp]ixel=') OR regexp_matches(test_txt, '[Pp]ixel=') AS either_case,
       regexp_matches(lower(concat(alarm_id, ' ', test_txt)), 'pixel=|r[0-9]+c[0-9]+|row.*col') AS hints FROM test_records""", "test_records"))
def _(spark, sf):
    a, t = F.col("alarm_id"), F.col("test_txt")
    return view(spark, sf, "test_records").select(
        "path", "record_index", *[fn.is_pixel_test(a, t, mode).alias(mode) for mode in ("strict", "either_case", "hints")])


@query("P6_mir_context", with_views("SELECT * FROM ctx", "ctx"))
def _(spark, sf):
    return m.mir_context(view(spark, sf, "headers"))


@query("P6_mir_context_direct", with_views("""
SELECT path, arg_min(facil_id, record_index) AS facility, arg_min(oper_frq, record_index) AS operation, arg_min(lot_id, record_index) AS lot_name,
       arg_min(node_nam, record_index) AS equipment, arg_min(job_nam, record_index) AS prog_name, arg_min(job_rev, record_index) AS prog_version,
       arg_min(CAST(start_t AS VARCHAR), record_index) AS start_time FROM headers GROUP BY path""", "headers"))
def _(spark, sf):
    return m.mir_context(view(spark, sf, "headers"), "direct")


@query("P7_device_context", with_views("SELECT * FROM dev", "dev"))
def _(spark, sf):
    return devices(spark, sf).withColumn("test_flag", F.col("test_flag").cast("int"))


@query("J1_device_test_product", with_views(f"SELECT {', '.join(FLOW)} FROM prod", "prod"))
def _(spark, sf):
    return product(spark, sf).select(*FLOW).withColumn("test_flag", F.col("test_flag").cast("int")).withColumn("value_pos", F.col("value_pos").cast("bigint"))


@query("J1_product_with_segment", with_views(f"SELECT {', '.join(FLOW)}, segment FROM seg", "seg"))
def _(spark, sf):
    rows = m.numbered_product(devices(spark, sf), tests(spark, sf)).select(*FLOW, "segment")
    return rows.withColumn("test_flag", F.col("test_flag").cast("int")).withColumn("value_pos", F.col("value_pos").cast("bigint"))


@query("W1_segment", with_views("SELECT path, device_index, record_index, value_pos, segment FROM seg", "seg"))
def _(spark, sf):
    return m.segment(product(spark, sf)).select("path", "device_index", "record_index", F.col("value_pos").cast("bigint").alias("value_pos"), "segment")


# Without the pixel filter: tests without a pixel take the device's own place.
_PIXEL_FILTER = "WHERE contains(alarm_id, 'Pixel=') OR contains(test_txt, 'Pixel=')"


@query("W1_segment_of_all_tests", with_views("SELECT path, device_index, record_index, value_pos, wp_pos_x, wp_pos_y, segment FROM seg", "seg").replace(_PIXEL_FILTER, ""))
def _(spark, sf):
    rows = m.numbered_product(devices(spark, sf), tests(spark, sf, pixel_mode=None))
    return rows.select("path", "device_index", "record_index", F.col("value_pos").cast("bigint").alias("value_pos"), "wp_pos_x", "wp_pos_y", "segment")


@query("W1_segment_by_raw_flag", with_views("""
SELECT path, device_index, record_index, value_pos, row_number() OVER (PARTITION BY path, wld_device_dmc, wtp_param_name, wp_pos_x, wp_pos_y, test_flg
       ORDER BY device_index, record_index, value_pos) - 1 AS segment FROM prod""", "prod"))
def _(spark, sf):
    key = [k for k in m.SEGMENT_KEY if k != "test_flag"] + ["test_flg"]
    return m.segment(product(spark, sf), key).select(
        "path", "device_index", "record_index", F.col("value_pos").cast("bigint").alias("value_pos"), "segment")


@query("P8_measurement_tuple", with_views(f"""
SELECT path, {WLD} AS wld_id, {WTP} AS wtp_id, wp_pos_x, wp_pos_y, wptm_value, test_flag, segment, md5(path) AS file_hash,
       wld_device_dmc, wtp_param_name, units, test_num, test_flg FROM seg""", "seg"))
def _(spark, sf):
    d, t = with_ids(spark, sf)
    rows = m.measurement_tuple(m.numbered_product(d, t, keep=("wld_id", "wtp_id", "file_hash")))
    return rows.withColumns({c: F.col(c).cast("int") for c in ("test_flag", "test_flg")})


_WIDE = f"""
SELECT p.path, c.facility AS wfi_facility, c.operation AS wfi_operation, c.lot_name AS wl_lot_name, c.equipment AS wfi_equipment,
       p.wld_device_dmc, p.bin_code AS wld_bin_code, p.wp_pos_x, p.wp_pos_y, p.wtp_param_name, p.wptm_value, {WTP} AS wtp_id, {WLD} AS wld_id,
       p.test_num, p.test_flg, p.test_flag, """


@query("P9_measurement_wide", with_views(_WIDE + """
       '' AS wld_phoenix_id, 'Y' AS wld_latest, p.bin_desc AS wld_bin_desc, c.prog_name AS wmp_prog_name, c.prog_version AS wmp_prog_version,
       c.start_time AS wptm_created_date, 'STDF_CPP' AS sft_name, 'STDF_CPP' AS sft_group, c.start_time AS wld_created_date, p.record_type
FROM prod p LEFT JOIN ctx c ON p.path = c.path""", "prod", "ctx"))
def _(spark, sf):
    d, t = with_ids(spark, sf)
    d = m.with_mir(d, m.mir_context(view(spark, sf, "headers")))
    rows = m.measurement_wide(m.device_test_product(d, t, keep=("wld_id", "wtp_id", *m.MIR_COLUMNS)))
    return rows.withColumns({c: F.col(c).cast("int") for c in ("test_flag", "test_flg")})


@query("P9_measurement_with_units", with_views(_WIDE + "p.units, p.segment, md5(p.path) AS file_hash FROM seg p LEFT JOIN ctx c ON p.path = c.path", "seg", "ctx"))
def _(spark, sf):
    d, t = with_ids(spark, sf)
    d = m.with_mir(d, m.mir_context(view(spark, sf, "headers")))
    rows = m.measurement_wide(m.numbered_product(d, t, keep=("wld_id", "wtp_id", "file_hash", *m.MIR_COLUMNS)), "with_units")
    return rows.withColumns({c: F.col(c).cast("int") for c in ("test_flag", "test_flg")})


@query("P10_to_fact", with_views(f"""
SELECT {WLD} AS wld_id, {WTP} AS wtp_id, wp_pos_x, wp_pos_y, wptm_value, 202401 AS created_month, test_flag, segment, md5(path) AS file_hash FROM seg""", "seg"))
def _(spark, sf):
    d, t = with_ids(spark, sf)
    fact = m.to_fact(m.numbered_product(d, t, keep=("wld_id", "wtp_id", "file_hash")), F.lit("2024-01-15 00:00:00"))
    return fact.withColumn("test_flag", F.col("test_flag").cast("int")).withColumn("created_month", fn.yyyymm(F.col("wptm_created_date"))).drop("wptm_created_date")


@query("J2_with_mir", with_views("""
SELECT d.path, d.device_index, d.wld_device_dmc, c.facility, c.operation, c.lot_name, c.equipment, c.prog_name, c.prog_version, c.start_time
FROM dev d LEFT JOIN ctx c ON d.path = c.path""", "dev", "ctx"))
def _(spark, sf):
    joined = m.with_mir(devices(spark, sf), m.mir_context(view(spark, sf, "headers")))
    return joined.select("path", "device_index", "wld_device_dmc", *m.MIR_COLUMNS)


@query("J3_attach_ids", with_views("""
SELECT d.path, d.device_index, d.wld_device_dmc, e.wld_id FROM dev d LEFT JOIN existing_devices e ON d.wld_device_dmc = e.wld_device_dmc""", "dev", "existing_devices"))
def _(spark, sf):
    known = view(spark, sf, "existing_devices")
    return dims.attach_ids(devices(spark, sf), known, "wld_device_dmc", "wld_id").select("path", "device_index", "wld_device_dmc", "wld_id")


@query("J4_new_keys", with_views("""
SELECT DISTINCT wld_device_dmc FROM dev WHERE wld_device_dmc NOT IN (SELECT wld_device_dmc FROM existing_devices)""", "dev", "existing_devices"))
def _(spark, sf):
    names = dims.first_seen(devices(spark, sf), "wld_device_dmc", ("path", "device_index"))
    return dims.new_keys(names, view(spark, sf, "existing_devices"), "wld_device_dmc").select("wld_device_dmc")


@query("J6_lookup_ids", with_views("""
SELECT wld_device_dmc, wld_id FROM existing_devices WHERE wld_device_dmc IN (SELECT wld_device_dmc FROM dev)""", "dev", "existing_devices"))
def _(spark, sf):
    return dims.lookup_ids(devices(spark, sf), view(spark, sf, "existing_devices"), "wld_device_dmc")


@query("W2_assign_ids", with_views("""
SELECT wld_device_dmc, (SELECT max(wld_id) FROM existing_devices) + row_number() OVER (ORDER BY p, i) AS wld_id FROM (
  SELECT wld_device_dmc, min(path) AS p, arg_min(device_index, (path, device_index)) AS i FROM dev
  WHERE wld_device_dmc NOT IN (SELECT wld_device_dmc FROM existing_devices) GROUP BY wld_device_dmc)""", "dev", "existing_devices"))
def _(spark, sf):
    return dims.assign_ids(devices(spark, sf), view(spark, sf, "existing_devices"), "wld_device_dmc", "wld_id", ("path", "device_index"))


@query("W2_assign_first_ids", with_views("""
SELECT wtp_param_name, row_number() OVER (ORDER BY p, i) - 1 AS wtp_id FROM (
  SELECT wtp_param_name, min(path) AS p, arg_min(record_index, (path, record_index)) AS i FROM prep GROUP BY wtp_param_name)""", "prep"))
def _(spark, sf):
    empty = spark.createDataFrame([], "wtp_id bigint, wtp_param_name string")
    return dims.assign_ids(tests(spark, sf), empty, "wtp_param_name", "wtp_id")


@query("J5_skip_loaded_files", with_views("""
SELECT min(path) AS path, md5(content) AS file_hash, any_value(length(content)) AS n_chars FROM files
WHERE md5(content) NOT IN (SELECT file_hash FROM loaded_hashes) GROUP BY md5(content)""", "files", "loaded_hashes"))
def _(spark, sf):
    files = view(spark, sf, "files")
    manifest = files.select("path", fn.file_hash(F.col("content")).alias("file_hash"))
    kept = dedup.skip_loaded_files(files, view(spark, sf, "loaded_hashes"), manifest)
    return kept.select("path", "file_hash", F.length("content").cast("bigint").alias("n_chars"))


_KEY = ["wld_device_dmc", "wtp_param_name", "wp_pos_x", "wp_pos_y", "test_flg"]


@query("A13_duplicate_summary", with_views(f"""
SELECT count(*) AS unique_keys, max(n) - 1 AS max_segment, count(*) FILTER (n > 6) AS keys_over_limit, sum(greatest(n - 6, 0))::BIGINT AS segments_over_limit
FROM (SELECT count(*) AS n FROM prod GROUP BY {', '.join(_KEY)})""", "prod"))
def _(spark, sf):
    d, t = m.alike_names(devices(spark, sf), tests(spark, sf), _KEY)
    rows = m.counted_product(d, t, [*_KEY, "_devices_alike", "_tests_alike"])
    rows = rows.withColumn("n_keys", F.col("_devices_alike") * F.col("_tests_alike"))
    return dedup.duplicate_summary(rows, _KEY, limit=5, rows="n_rows", keys="n_keys")


@query("A13_top_duplicates", with_views(f"""
SELECT {', '.join(_KEY)}, count(*) AS n_rows, count(*) - 1 AS max_segment FROM prod GROUP BY {', '.join(_KEY)}
ORDER BY max_segment DESC, {', '.join(_KEY)} LIMIT 10""", "prod"))
def _(spark, sf):
    rows = m.counted_product(*m.alike_names(devices(spark, sf), tests(spark, sf), _KEY, 10), _KEY)
    return dedup.top_duplicates(rows, _KEY, 10, "n_rows").withColumn("test_flg", F.col("test_flg").cast("int"))
