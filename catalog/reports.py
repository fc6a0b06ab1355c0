"""Reports, validation and comparison on the given tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from catalog.measures import counted, devices, tests
from catalog.registry import query
from catalog.views import numbered_wafer_parts, view, with_views
from dieflow.operators import quality, records as r, stats, wafer
from dieflow.operators.measurements import MIR_COLUMNS, mir_context, with_mir


@query("A1_record_stats", with_views("""
SELECT coalesce(path, 'TOTAL') AS path, coalesce(record_type, 'TOTAL') AS record_type, count(*) AS n_records
FROM record_log GROUP BY ROLLUP (path, record_type)""", "record_log"))
def _(spark, sf):
    return stats.record_stats(view(spark, sf, "record_log"))


_SEVEN = "'PTR', 'MPR', 'FTR', 'HBR', 'SBR', 'MIR', 'PRR'"


@query("A2_parse_counts", with_views(
    f"SELECT path, count(*) AS total_records, count(*) FILTER (record_type IN ({_SEVEN})) AS parsed_records FROM record_log GROUP BY path", "record_log"))
def _(spark, sf):
    return stats.parse_counts(view(spark, sf, "record_log"))


@query("P1_filter_record_types", with_views(f"SELECT * FROM record_log WHERE record_type IN ({_SEVEN})", "record_log"))
def _(spark, sf):
    return r.filter_record_types(view(spark, sf, "record_log"))


@query("A3_distinct_entities", with_views("""
SELECT 'wld_device_dmc' AS entity, count(DISTINCT wld_device_dmc) AS n_distinct FROM prod WHERE wld_device_dmc <> ''
UNION ALL SELECT 'wtp_param_name', count(DISTINCT wtp_param_name) FROM prod WHERE wtp_param_name <> ''
UNION ALL SELECT 'test_num', count(DISTINCT test_num) FROM prod""", "prod"))
def _(spark, sf):
    first, *others = [stats.distinct_entities(counted(spark, sf, c), [c]) for c in ("wld_device_dmc", "wtp_param_name", "test_num")]
    for other in others:
        first = first.unionByName(other)
    return first


@query("A4_measurement_stats", with_views("""
SELECT count(*) AS total, count(*) FILTER (record_type = 'PTR') AS ptr, count(*) FILTER (record_type = 'MPR') AS mpr,
       count(*) FILTER (record_type = 'FTR') AS ftr FROM prod""", "prod"))
def _(spark, sf):
    return stats.measurement_stats(counted(spark, sf, "record_type"), "n_rows")


@query("A4_flag_distribution", with_views("SELECT test_flg, count(*) AS n FROM prod GROUP BY test_flg", "prod"))
def _(spark, sf):
    return stats.flag_distribution(counted(spark, sf, "test_flg"), "n_rows").withColumn("test_flg", F.col("test_flg").cast("int"))


@query("A5_id_distribution", with_views(
    "SELECT wld_device_dmc, count(*) AS n, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM prod) AS percent FROM prod GROUP BY wld_device_dmc", "prod"))
def _(spark, sf):
    return stats.id_distribution(counted(spark, sf, "wld_device_dmc"), "wld_device_dmc", rows="n_rows")


@query("A5_id_distribution_top", with_views("""
WITH s AS (SELECT * FROM test_records ORDER BY path, record_index LIMIT 500)
SELECT test_num, count(*) AS n, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM s) AS percent FROM s GROUP BY test_num ORDER BY n DESC, test_num LIMIT 20
""".replace("WITH s AS", ", s AS", 1), "test_records"))
def _(spark, sf):
    return stats.id_distribution(view(spark, sf, "test_records"), "test_num", 20, 500, ["path", "record_index"])


@query("A6_bin_distribution", with_views("""
SELECT * FROM (SELECT 'hard' AS kind, CAST(hard_bin AS VARCHAR) AS bin, count(*) AS n, (SELECT count(*) FROM wafer_parts) AS parts_tested
               FROM wafer_parts GROUP BY hard_bin ORDER BY n DESC, bin LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'soft', CAST(soft_bin AS VARCHAR) AS bin, count(*) AS n, (SELECT count(*) FROM wafer_parts)
               FROM wafer_parts GROUP BY soft_bin ORDER BY n DESC, bin LIMIT 5)""", "wafer_parts"))
def _(spark, sf):
    return stats.bin_distribution(view(spark, sf, "wafer_parts"))


@query("A7_device_info", with_views("""
SELECT d.device_index % 10 AS wld_id, arg_min(d.wld_device_dmc, (d.path, d.device_index)) AS wld_device_dmc, '' AS wld_phoenix_id, '' AS wld_latest,
       arg_min(d.bin_code, (d.path, d.device_index)) AS wld_bin_code, arg_min(d.bin_desc, (d.path, d.device_index)) AS wld_bin_desc,
       arg_min(c.facility, (d.path, d.device_index)) AS wfi_facility, arg_min(c.operation, (d.path, d.device_index)) AS wfi_operation,
       arg_min(c.lot_name, (d.path, d.device_index)) AS wl_lot_name, arg_min(c.prog_name, (d.path, d.device_index)) AS wmp_prog_name,
       arg_min(c.prog_version, (d.path, d.device_index)) AS wmp_prog_version, arg_min(c.equipment, (d.path, d.device_index)) AS wfi_equipment,
       '' AS sft_name, '' AS sft_group, arg_min(c.start_time, (d.path, d.device_index)) AS wld_created_date
FROM dev d LEFT JOIN ctx c ON d.path = c.path GROUP BY d.device_index % 10""", "dev", "ctx"))
def _(spark, sf):
    names = ("wfi_facility", "wfi_operation", "wl_lot_name", "wfi_equipment", "wmp_prog_name", "wmp_prog_version", "wld_created_date")
    rows = with_mir(devices(spark, sf), mir_context(view(spark, sf, "headers")))
    shaped = rows.withColumnsRenamed({**dict(zip(MIR_COLUMNS, names)), "bin_code": "wld_bin_code", "bin_desc": "wld_bin_desc"})
    return stats.device_info(shaped.withColumn("wld_id", F.col("device_index") % 10), ("path", "device_index"))


@query("A8_wafer_extent", with_views("""
SELECT *, x_max - x_min + 1 AS x_range, y_max - y_min + 1 AS y_range FROM (
  SELECT path, least(min(x_coord), 0) AS x_min, greatest(max(x_coord), 0) AS x_max, least(min(y_coord), 0) AS y_min, greatest(max(y_coord), 0) AS y_max
  FROM wafer_parts GROUP BY path)""", "wafer_parts"))
def _(spark, sf):
    return wafer.wafer_extent(view(spark, sf, "wafer_parts"))


@query("A9_wafer_map", with_views("""
SELECT path, x_coord, y_coord, arg_max(hard_bin, record_index) AS hard_bin, arg_max(soft_bin, record_index) AS soft_bin
FROM wafer_parts GROUP BY ALL""", "wafer_parts"))
def _(spark, sf):
    return wafer.wafer_map(numbered_wafer_parts(spark, sf))


@query("A9_wafer_grid", with_views("""
SELECT path, y_coord, """ + ", ".join(f'coalesce(max(b) FILTER (x_coord = {x}), 0) AS "{x}"' for x in range(-2, 5)) + """
FROM (SELECT path, x_coord, y_coord, arg_max(hard_bin, record_index) AS b FROM wafer_parts GROUP BY ALL) GROUP BY path, y_coord""", "wafer_parts"))
def _(spark, sf):
    return wafer.wafer_grid(wafer.wafer_map(numbered_wafer_parts(spark, sf)), list(range(-2, 5)))


@query("A10_multi_value_ratio", with_views("""
SELECT count(*) FILTER (len(vals) > 1) AS multi_value, count(*) FILTER (len(vals) <= 1) AS single_value,
       count(*) FILTER (len(vals) > 1) * 100.0::DOUBLE / count(*) AS percent_multi FROM prep""", "prep"))
def _(spark, sf):
    return stats.multi_value_ratio(tests(spark, sf))


@query("A11_per_device_counts", with_views("""
SELECT path, device_index, wld_device_dmc, count(*) AS n_measurements, count(*)::DOUBLE / count(DISTINCT record_index) AS avg_per_test
FROM prod GROUP BY path, device_index, wld_device_dmc""", "prod"))
def _(spark, sf):
    return stats.per_device_counts(devices(spark, sf), tests(spark, sf))


@query("A12_load_summary", with_views("""
SELECT status, count(*) AS files, sum(measurements)::BIGINT AS measurements, sum(elapsed) AS elapsed, sum(measurements)::DOUBLE / sum(elapsed) AS rows_per_second,
       avg(elapsed) AS seconds_per_file
FROM (SELECT CASE WHEN doc_id % 10 = 0 THEN 'failed' WHEN file_hash IS NOT NULL THEN 'skipped' ELSE 'processed' END AS status,
             length(content) AS measurements, 0.25 AS elapsed FROM files LEFT JOIN loaded_hashes ON md5(content) = file_hash) GROUP BY status""", "files", "loaded_hashes"))
def _(spark, sf):
    files, loaded = view(spark, sf, "files"), view(spark, sf, "loaded_hashes")
    status = F.when(F.col("doc_id") % 10 == 0, "failed").when(F.col("file_hash").isNotNull(), "skipped").otherwise("processed")
    log = files.join(loaded, F.md5("content") == F.col("file_hash"), "left").select(
        status.alias("status"), F.length("content").cast("bigint").alias("measurements"), F.lit(0.25).alias("elapsed"))
    return stats.load_summary(log)


@query("A15_partition_counts", with_views("SELECT wld_device_dmc, count(*) AS n_rows FROM prod GROUP BY wld_device_dmc", "prod"))
def _(spark, sf):
    return stats.partition_counts(counted(spark, sf, "wld_device_dmc"), "wld_device_dmc", "n_rows")


@query("O1_order_by_count", with_views("SELECT record_type, count(*) AS n FROM record_log GROUP BY record_type ORDER BY n DESC, record_type", "record_log"))
def _(spark, sf):
    return stats.order_by_count(view(spark, sf, "record_log"))


@query("O2_top_k", with_views("SELECT units, count(*) AS n FROM test_records GROUP BY units ORDER BY n DESC, units LIMIT 3", "test_records"))
def _(spark, sf):
    return stats.top_k(view(spark, sf, "test_records"), "units", 3)


@query("O3_first_k", with_views("SELECT * FROM test_records ORDER BY path, record_index LIMIT 25", "test_records"))
def _(spark, sf):
    return stats.first_k(view(spark, sf, "test_records"), 25, ["path", "record_index"])


@query("U1_union_tests", with_views("""
SELECT path, record_index, record_type, test_num, test_flg, alarm_id, test_txt, result, CAST(NULL AS VARCHAR) AS rtn_rslt, units FROM test_records WHERE record_type = 'PTR'
UNION ALL SELECT path, record_index, record_type, test_num, test_flg, alarm_id, test_txt, NULL, rtn_rslt, units FROM test_records WHERE record_type = 'MPR'
UNION ALL SELECT path, record_index, record_type, test_num, test_flg, alarm_id, test_txt, NULL, NULL, NULL FROM test_records WHERE record_type = 'FTR'""", "test_records"))
def _(spark, sf):
    df = view(spark, sf, "test_records")
    ptr, mpr, ftr = [df.filter(F.col("record_type") == t) for t in ("PTR", "MPR", "FTR")]
    return r.union_tests(ptr.drop("rtn_rslt"), mpr.drop("result"), ftr.drop("result", "rtn_rslt", "units"))


@query("U2_union_entities", with_views("""
SELECT wld_device_dmc AS name FROM dev UNION SELECT wld_device_dmc FROM existing_devices""", "dev", "existing_devices"))
def _(spark, sf):
    return stats.union_entities(devices(spark, sf).select(F.col("wld_device_dmc").alias("name")), view(spark, sf, "existing_devices").select("wld_device_dmc"))


@query("U3_field_set_ops", with_views("""
SELECT name, 'common' AS side FROM (SELECT wld_device_dmc AS name FROM dev INTERSECT SELECT wld_device_dmc FROM existing_devices)
UNION ALL SELECT name, 'left' FROM (SELECT wld_device_dmc AS name FROM dev EXCEPT SELECT wld_device_dmc FROM existing_devices)
UNION ALL SELECT name, 'right' FROM (SELECT wld_device_dmc AS name FROM existing_devices EXCEPT SELECT wld_device_dmc FROM dev)""", "dev", "existing_devices"))
def _(spark, sf):
    left = devices(spark, sf).select(F.col("wld_device_dmc").alias("name"))
    return stats.field_set_ops(left, view(spark, sf, "existing_devices").select("wld_device_dmc"))


@query("W3_first_n_per_type", with_views("""
SELECT path, record_index, record_type FROM record_log QUALIFY row_number() OVER (PARTITION BY record_type ORDER BY path, record_index) <= 5""", "record_log"))
def _(spark, sf):
    return r.first_n_per_type(view(spark, sf, "record_log"), 5)


def _validation_sql(strict: bool) -> str:
    known = "'FAR','ATR','MIR','MRR','PCR','HBR','SBR','PMR','PGR','PLR','RDR','SDR','WIR','WRR','WCR','PIR','PRR','TSR','PTR','MPR','FTR','BPS','EPS','GDR'"
    known += "" if strict else ",'DTR'"
    skip = 2 if strict else 1
    return with_views(rf"""
, files_seq AS (SELECT path, string_agg(record_type, ' ' ORDER BY record_index) AS seq FROM record_log GROUP BY path),
cut AS (SELECT path, seq, regexp_extract(seq, '^FAR( ATR)*') AS head, regexp_extract(seq, '^FAR( ATR)* MIR( RDR)?( SDR)*') AS intro FROM files_seq),
body AS (SELECT *, list_filter(string_split(substr(seq, length(intro) + 2), ' ')[{skip}:], lambda z: z <> '') AS rest FROM cut),
bad AS (SELECT *, list_filter(list_transform(range(1, len(rest) + 1), lambda i: CASE
    WHEN rest[i] IN ('FAR', 'ATR', 'MIR', 'RDR', 'SDR') THEN 'outside of initial sequence'
    WHEN rest[i] = 'MRR' AND len(list_filter(rest[1:i], lambda z: z = 'MRR')) = 2 THEN 'more than one MRR'
    WHEN rest[i] = 'WCR' AND len(list_filter(rest[1:i], lambda z: z = 'WCR')) = 2 THEN 'more than one WCR'
    WHEN rest[i] NOT IN ({known}) THEN 'unknown record' END), lambda z: z IS NOT NULL) AS problems FROM body)
SELECT path, CASE WHEN seq NOT LIKE 'FAR%' THEN 'first record is not FAR' WHEN head = seq THEN 'initial sequence not found'
    WHEN substr(seq, length(head) + 2, 3) <> 'MIR' THEN 'MIR not located' WHEN intro = seq THEN 'EOF after initial sequence'
    WHEN len(problems) > 0 THEN problems[1] WHEN right(seq, 3) <> 'MRR' THEN 'MRR not last' ELSE 'valid' END AS message,
    coalesce(seq LIKE 'FAR%' AND head <> seq AND substr(seq, length(head) + 2, 3) = 'MIR' AND intro <> seq AND len(problems) = 0 AND right(seq, 3) = 'MRR', false) AS valid
FROM bad""", "record_log")


@query("W4_validate_files", _validation_sql(False))
def _(spark, sf):
    return quality.validate_files(view(spark, sf, "record_log"))


@query("W4_validate_files_strict", _validation_sql(True))
def _(spark, sf):
    return quality.validate_files(view(spark, sf, "record_log"), strict=True)


def _second_log(spark, sf):
    log = view(spark, sf, "record_log")
    return log.filter(F.substring("path", 2, 20).cast("bigint") % 9 != 0)


_COUNTS = """
, b AS (SELECT * FROM record_log WHERE CAST(substr(path, 2) AS BIGINT) % 9 <> 0),
c AS (SELECT coalesce(x.record_type, y.record_type) AS record_type, coalesce(x.n, 0) AS left_count, coalesce(y.n, 0) AS right_count
      FROM (SELECT record_type, count(*) AS n FROM record_log GROUP BY 1) x FULL JOIN (SELECT record_type, count(*) AS n FROM b GROUP BY 1) y ON x.record_type = y.record_type)
"""


@query("J7_compare_record_counts", with_views(_COUNTS + """
SELECT *, right_count - left_count AS diff, CASE WHEN right_count = left_count THEN 'equal' WHEN abs(right_count - left_count) < 100 THEN 'close' ELSE 'different' END AS status,
       CASE WHEN right_count = 0 THEN 'missing' WHEN left_count = 0 THEN 'unexpected' ELSE 'both' END AS presence FROM c""", "record_log"))
def _(spark, sf):
    return quality.compare_record_counts(view(spark, sf, "record_log"), _second_log(spark, sf))


@query("J7_compare_summary", with_views(_COUNTS + """
SELECT sum(left_count)::BIGINT AS left_total, sum(right_count)::BIGINT AS right_total, abs(sum(right_count) - sum(left_count))::BIGINT AS total_diff,
       (1 - abs(sum(right_count) - sum(left_count))::DOUBLE / greatest(sum(left_count), sum(right_count))::DOUBLE) * 100.0 AS accuracy_percent,
       count(*) FILTER (left_count = right_count) * 100.0::DOUBLE / count(*) AS exact_match_percent,
       CASE WHEN sum(left_count) = sum(right_count) THEN 'perfect' WHEN abs(sum(right_count) - sum(left_count)) < 100 THEN 'excellent'
            WHEN abs(sum(right_count) - sum(left_count)) < 1000 THEN 'good' ELSE 'different' END AS rating FROM c""", "record_log"))
def _(spark, sf):
    return quality.compare_summary(quality.compare_record_counts(view(spark, sf, "record_log"), _second_log(spark, sf)))


def _two_spellings(spark, sf):
    """The same tests with two spellings of the field names, and two differences."""
    df = view(spark, sf, "test_records")
    names = {"TEST_NUM": "test_num", "TEST_FLG": "test_flg", "ALARM_ID": "alarm_id", "UNITS": "units"}
    keys = ["path", "record_index", "record_type"]

    def fields(spell, extra):
        return F.create_map(*[c for n, source in names.items() for c in (F.lit(spell(n)), F.col(source).cast("string"))], *extra)

    left = df.select(*keys, fields(str.lower, [F.lit("stdf_result"), F.col("result")]).alias("fields"))
    changed = df.withColumn("test_flg", F.when(F.col("test_num") % 10 == 0, F.col("test_flg") + 1).otherwise(F.col("test_flg")))
    right = changed.select(*keys, fields(lambda n: f"rec_{n}", [F.lit("TEST_TXT"), F.concat(F.lit(" "), "test_txt")]).alias("fields"))
    return left, right


_FIELDS = """
, f AS (
  SELECT path, record_index, record_type, 'test_num' AS field, CAST(test_num AS VARCHAR) AS left_value, CAST(test_num AS VARCHAR) AS right_value FROM test_records
  UNION ALL SELECT path, record_index, record_type, 'test_flg', CAST(test_flg AS VARCHAR), CAST(CASE WHEN test_num % 10 = 0 THEN test_flg + 1 ELSE test_flg END AS VARCHAR) FROM test_records
  UNION ALL SELECT path, record_index, record_type, 'alarm_id', alarm_id, alarm_id FROM test_records
  UNION ALL SELECT path, record_index, record_type, 'units', units, units FROM test_records
  UNION ALL SELECT path, record_index, record_type, 'result', result, NULL FROM test_records
  UNION ALL SELECT path, record_index, record_type, 'test_txt', NULL, test_txt FROM test_records),
g AS (SELECT *, CASE WHEN right_value IS NULL THEN 'left' WHEN left_value IS NULL THEN 'right' WHEN left_value = right_value THEN 'equal' ELSE 'different' END AS status,
      field IN ('test_flg', 'test_num', 'head_num', 'site_num', 'result') AS is_key FROM f)
"""


@query("J8_compare_fields", with_views(_FIELDS + "SELECT path, record_index, record_type, field, status, left_value, right_value, is_key FROM g", "test_records"))
def _(spark, sf):
    return quality.compare_fields(*_two_spellings(spark, sf))


@query("J8_compare_fields_summary", with_views(_FIELDS + """
SELECT record_type, field, is_key, count(*) FILTER (status = 'equal') AS n_equal, count(*) FILTER (status = 'different') AS n_different,
       count(*) FILTER (status = 'left') AS n_left, count(*) FILTER (status = 'right') AS n_right FROM g GROUP BY ALL""", "test_records"))
def _(spark, sf):
    return quality.compare_fields_summary(quality.compare_fields(*_two_spellings(spark, sf)))
