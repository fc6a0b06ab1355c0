"""Test inputs over the given tables. One SELECT text serves Spark and SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dieflow.operators.numbering import number_in_order

TABLES = ("part", "supplier", "orders", "lineitem", "events", "documents")

VIEWS = {
    "devices": """
SELECT concat('f', CAST(s_suppkey % 4 AS STRING)) AS path, CAST(s_suppkey AS BIGINT) AS record_index,
       CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE s_name END AS part_id, concat('TXT', CAST(s_suppkey AS STRING)) AS part_txt,
       CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE CAST(s_suppkey % 3 AS STRING) END AS soft_bin,
       CAST(s_suppkey % 2 AS STRING) AS hard_bin,
       CAST(s_suppkey % 10 AS INT) AS x_coord, CAST(s_suppkey % 6 AS INT) AS y_coord
FROM supplier""",
    "test_records": """
SELECT concat('f', CAST(p_partkey % 4 AS STRING)) AS path, CAST(p_partkey + 100000 AS BIGINT) AS record_index,
       CASE p_partkey % 3 WHEN 0 THEN 'PTR' WHEN 1 THEN 'MPR' ELSE 'FTR' END AS record_type,
       CAST(p_partkey % 50 AS BIGINT) AS test_num, CAST(p_partkey % 4 AS INT) AS test_flg,
       CASE WHEN p_partkey % 11 = 0 THEN ''
            WHEN p_partkey % 5 = 0 THEN p_name
            WHEN p_partkey % 2 = 0 THEN concat('Pixel=R', CAST(p_size % 8 AS STRING), 'C', CAST(p_partkey % 4 AS STRING), ';', p_name)
            ELSE concat(p_name, ';Pixel=R', CAST(p_size % 8 AS STRING), 'C', CAST(p_partkey % 4 AS STRING)) END AS alarm_id,
       CASE WHEN p_partkey % 11 = 0 THEN concat(p_brand, ';Pixel=R1C2') ELSE p_brand END AS test_txt,
       CASE WHEN p_partkey % 3 = 0 THEN CAST(p_retailprice AS STRING) ELSE '' END AS result,
       CASE WHEN p_partkey % 3 = 1 THEN concat(CAST(p_retailprice AS STRING), ', ', CAST(p_size AS STRING), ',bad') ELSE '' END AS rtn_rslt,
       p_type AS units
FROM part""",
    "landing": """
SELECT event_id, user_id AS wld_id, CASE WHEN event_id % 2 = 0 THEN 'PTR' ELSE 'MPR' END AS record_type,
       CAST(event_id % 50 AS BIGINT) AS test_num, ts AS wptm_created_date, props AS record_data,
       CAST(event_id % 2 AS INT) AS test_flag, event_type AS alarm_id, value
FROM events""",
    # Landing rows whose JSON holds the fields of the typed views; some absent, quoted or malformed.
    "landing_full": """
SELECT event_id, user_id AS wld_id, CASE WHEN event_id % 2 = 0 THEN 'PTR' ELSE 'MPR' END AS record_type,
       CAST(event_id % 50 AS BIGINT) AS test_num, CAST(event_id % 3 AS BIGINT) AS head_num, CAST(event_id % 7 AS BIGINT) AS site_num,
       ts AS wptm_created_date, CAST(event_id % 2 AS INT) AS test_flag, event_type AS alarm_id, '' AS part_txt,
       CAST(event_id % 4 AS BIGINT) AS segment, concat('h', CAST(user_id AS STRING)) AS file_hash,
       concat('{"WTP_ID": ', CASE WHEN event_id % 3 = 0 THEN concat('"', CAST(user_id AS STRING), '"') ELSE CAST(user_id AS STRING) END,
              ', "RESULT": ', CASE WHEN event_id % 13 = 0 THEN '"n/a"' ELSE CAST(value AS STRING) END,
              ', "UNITS": "', event_type, '"',
              CASE WHEN event_id % 5 = 0 THEN '' ELSE concat(', "LO_LIMIT": ', CAST(event_id % 10 AS STRING)) END,
              ', "RSLT_CNT": ', CAST(event_id % 4 AS STRING),
              ', "TEST_RESULTS": [', CAST(event_id % 100 AS STRING), ', ', CAST(event_id % 7 AS STRING), ']',
              CASE WHEN event_id % 11 = 0 THEN '' ELSE ', "RTN_STAT": [1, 2]' END,
              ', "WP_POS_X": ', CAST(event_id % 9 - 4 AS STRING), ', "WP_POS_Y": "', CAST(event_id % 6 AS STRING), '"}') AS record_data
FROM events""",
    "files": """
SELECT concat('doc', CAST(doc_id AS STRING)) AS path, text AS content, CAST(doc_id AS BIGINT) AS doc_id FROM documents""",
    "record_log": """
SELECT concat('o', CAST(o_orderkey AS STRING)) AS path,
       CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY v.i) AS BIGINT) AS record_index, v.t AS record_type
FROM orders CROSS JOIN (VALUES (1,'FAR'),(2,'ATR'),(3,'MIR'),(4,'RDR'),(5,'SDR'),(6,'PIR'),(7,'PTR'),(8,'MPR'),(9,'FTR'),(10,'PRR'),
     (11,'HBR'),(12,'SBR'),(13,'MIR'),(14,'DTR'),(15,'MRR'),(16,'MRR'),(17,'PCR')) AS v(i, t)
WHERE (v.i <> 1 OR o_orderkey % 7 <> 1) AND (v.i <> 2 OR o_orderkey % 2 = 0) AND (v.i <> 4 OR o_orderkey % 3 = 0)
  AND (v.i <> 5 OR o_orderkey % 5 <> 0) AND (v.i <> 13 OR o_orderkey % 7 = 2) AND (v.i <> 14 OR o_orderkey % 7 = 3)
  AND (v.i <> 15 OR o_orderkey % 7 <> 4) AND (v.i <> 16 OR o_orderkey % 7 = 5) AND (v.i <> 17 OR o_orderkey % 7 = 6)""",
    "wafer_parts": """
SELECT concat('w', CAST(l_suppkey % 4 AS STRING)) AS path,
       CAST(row_number() OVER (PARTITION BY l_suppkey % 4 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS BIGINT) AS record_index,
       CAST(l_linenumber - 3 AS INT) AS x_coord, CAST(l_quantity AS INT) % 10 AS y_coord,
       CAST(l_partkey % 8 AS INT) AS hard_bin, CAST(l_partkey % 20 AS INT) AS soft_bin
FROM lineitem""",
    "existing_devices": """
SELECT s_name AS wld_device_dmc, CAST(s_suppkey AS BIGINT) AS wld_id FROM supplier WHERE s_suppkey % 2 = 0""",
    "loaded_hashes": """
SELECT DISTINCT md5(text) AS file_hash FROM documents WHERE doc_id % 3 = 0""",
    "atdf_lines": """
SELECT concat_ws('|', 'PTR', CAST(p_partkey AS STRING), concat('f', CAST(p_partkey % 4 AS STRING)), p_name, CAST(p_size AS STRING), p_type) AS line FROM part""",
    # One file-header row per path and order of appearance.
    "headers": """
SELECT concat('f', CAST(s_suppkey % 4 AS STRING)) AS path, CAST(s_suppkey AS BIGINT) AS record_index,
       CASE WHEN s_suppkey % 4 = 1 THEN '' ELSE 'FAB1' END AS facil_id, concat('FLOOR', CAST(s_nationkey AS STRING)) AS floor_id,
       CASE WHEN s_suppkey % 4 = 2 THEN '' ELSE 'OPER' END AS oper_nam, 'SPEC' AS spec_nam, s_name AS lot_id, 'TYPE' AS part_typ,
       CASE WHEN s_suppkey % 4 = 3 THEN '' ELSE 'NODE' END AS node_nam, 'JOB' AS job_nam, 'REV1' AS job_rev, 'SUB1' AS sblot_id,
       '25C' AS oper_frq, CAST(1700000000 + s_suppkey AS BIGINT) AS start_t
FROM supplier""",
}

# Devices and prepared tests as the library shapes them, in SQL.
_BIN = r"TRY_CAST(regexp_extract(coalesce(nullif(soft_bin, ''), nullif(hard_bin, ''), ''), '^\s*([+-]?\d+)', 1) AS INT)"
_NUM = r"'^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)'"
_STRICT = r"'^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$'"
NUMBER_PREFIX = "TRY_CAST(regexp_extract({x}, " + _NUM + ", 1) AS DOUBLE)"
SAFE_FLOAT = "CASE WHEN regexp_matches({x}, " + _STRICT + ") THEN coalesce(TRY_CAST(trim({x}) AS DOUBLE), 0.0) ELSE 0.0 END"
VALUES_SKIP = (
    "list_filter(list_transform(string_split({x}, ','), lambda z: " + NUMBER_PREFIX.format(x="z") + "), lambda z: z IS NOT NULL)"
)

SQL_VIEWS = {
    "dev": f"""
SELECT path, record_index AS device_index, coalesce(nullif(part_id, ''), nullif(part_txt, ''), '') AS wld_device_dmc,
       coalesce(nullif(soft_bin, ''), nullif(hard_bin, ''), '') AS bin_code,
       CASE WHEN {_BIN} = 1 THEN 'PASS' ELSE 'FAIL' END AS bin_desc,
       CASE WHEN {_BIN} = 1 THEN 1 ELSE 0 END AS test_flag, x_coord AS default_x, y_coord AS default_y
FROM devices""",
    "prep0": rf"""
SELECT *, CASE WHEN alarm_id <> '' THEN alarm_id ELSE test_txt END AS p,
       CASE WHEN regexp_matches(alarm_id, 'Pixel=R\d+C\d+') THEN alarm_id ELSE test_txt END AS pix,
       CASE WHEN record_type = 'PTR' AND {SAFE_FLOAT.format(x='result')} <> 0 THEN [{SAFE_FLOAT.format(x='result')}]
            ELSE {VALUES_SKIP.format(x="coalesce(nullif(rtn_rslt, ''), nullif(result, ''), test_txt)")} END AS vals
FROM test_records WHERE contains(alarm_id, 'Pixel=') OR contains(test_txt, 'Pixel=')""",
    "prep": r"""
SELECT path, record_index, record_type, test_num, test_flg, units,
       regexp_replace(regexp_replace(p, ';Pixel=R\d+C\d+', '', 'g'), '^Pixel=R\d+C\d+;', '') AS wtp_param_name,
       TRY_CAST(nullif(regexp_extract(pix, 'Pixel=R(\d+)C(\d+)', 2), '') AS INT) AS pixel_x,
       TRY_CAST(nullif(regexp_extract(pix, 'Pixel=R(\d+)C(\d+)', 1), '') AS INT) AS pixel_y,
       CASE WHEN len(vals) = 0 THEN [0.0] ELSE vals END AS vals
FROM prep0""",
    "prod": """
SELECT d.path, d.device_index, t.record_index, u.pos AS value_pos, d.wld_device_dmc, t.wtp_param_name,
       coalesce(t.pixel_x, d.default_x) AS wp_pos_x, coalesce(t.pixel_y, d.default_y) AS wp_pos_y,
       t.vals[u.pos + 1] AS wptm_value, d.test_flag, t.units, t.test_num, t.test_flg, t.record_type, d.bin_code, d.bin_desc
FROM dev d JOIN prep t ON d.path = t.path, LATERAL (SELECT unnest(range(len(t.vals))) AS pos) u""",
    "seg": """
SELECT *, row_number() OVER (PARTITION BY path, wld_device_dmc, wtp_param_name, wp_pos_x, wp_pos_y, test_flag
                             ORDER BY device_index, record_index, value_pos) - 1 AS segment
FROM prod""",
    "ctx": """
SELECT path, arg_min(coalesce(nullif(facil_id, ''), floor_id), record_index) AS facility,
       arg_min(coalesce(nullif(oper_nam, ''), spec_nam), record_index) AS operation,
       arg_min(coalesce(nullif(lot_id, ''), part_typ), record_index) AS lot_name,
       arg_min(coalesce(nullif(node_nam, ''), job_nam), record_index) AS equipment,
       arg_min(job_rev, record_index) AS prog_name, arg_min(sblot_id, record_index) AS prog_version,
       arg_min(CAST(start_t AS VARCHAR), record_index) AS start_time
FROM headers GROUP BY path""",
}
_NEEDS = {
    "dev": ["devices"], "prep0": ["test_records"], "prep": ["prep0"], "prod": ["dev", "prep"], "seg": ["prod"], "ctx": ["headers"],
}


def with_views(sql: str, *names: str) -> str:
    """SQL with the named views, and what they need, in front as CTEs.

    A body starting with a comma continues the CTE list.
    """
    order: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, []):
            need(other)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    ctes = ",\n".join(f"{n} AS ({(VIEWS.get(n) or SQL_VIEWS[n]).strip()})" for n in order)
    return f"WITH {ctes}\n{sql.strip()}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test input as a DataFrame."""
    sql = VIEWS[name]
    for t in TABLES:
        if f" {t}" in sql:
            table(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(sql)


_WAFER_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
_WAFER_NUMBER = f"row_number() OVER (PARTITION BY l_suppkey % 4 ORDER BY {', '.join(_WAFER_ORDER)})"


def numbered_wafer_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view ``wafer_parts`` whose records are numbered without a task that sorts a whole wafer."""
    used = [*_WAFER_ORDER, "l_quantity"]
    lines = table(spark, sf_dir, "lineitem").select(*used, (F.col("l_suppkey") % 4).alias("_wafer"))
    number_in_order(lines, ["_wafer"], _WAFER_ORDER, "_number").createOrReplaceTempView("numbered_lines")
    return spark.sql(VIEWS["wafer_parts"].replace(_WAFER_NUMBER, "_number").replace("FROM lineitem", "FROM numbered_lines"))
