"""Physical plans: what is shuffled, pushed down and pruned."""
import re

import pytest
from pyspark.sql import functions as F

from dieflow.operators import measurements as m, product, records as r, stats
from dieflow.operators.landing import ptr_view
from dieflow.plans import tables as t
from test_measurements import DEV, made


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"Exchange (?:hash|range|Single)", text))


@pytest.mark.parametrize("loose", [0.0, 0.3])
def test_segments_do_not_shuffle_the_product(spark, loose):
    devices, _, _, tests = made(spark, 3, loose=loose)
    # Devices away from the pixels, or at one place per name.
    for place in (lambda d: (9, 9), lambda d: (int(d[2][1:]) % 3, 0)):
        moved = spark.createDataFrame([(*d[:6], *place(d)) for d in devices], DEV)
        text = plan(m.numbered_product(moved, tests))
        assert "posexplode" in text and "Window" not in text[: text.index("SortMergeJoin")]
        for branch in text.split("posexplode")[:-1]:
            above = branch[branch.rfind("Scan parquet") + 1 :]
            assert "Exchange" not in above and "Window" not in above


def test_tasks_of_the_product_are_its_shares(spark, monkeypatch):
    monkeypatch.setattr(product, "LEAST_ROWS", 50)
    _, _, devices, tests = made(spark, 3)
    df = m.device_test_product(devices, tests, cell_rows=50)
    assert "shufflepartitionidpassthrough" in plan(df) and df.rdd.getNumPartitions() == 8


def test_first_rows_are_limited_before_the_shuffle(spark):
    kind = F.when(F.col("id") % 2 == 0, "PTR").otherwise("MPR")
    df = spark.range(100).select(F.lit("p").alias("path"), F.col("id").alias("record_index"), kind.alias("record_type"))
    text = plan(r.first_n_per_type(df, 3))
    assert text.count("WindowGroupLimit") == 2


def test_top_k_sorts_no_more_than_k(spark):
    assert "TakeOrderedAndProject" in plan(stats.top_k(spark.range(100).withColumn("c", F.col("id") % 7), "c", 3))


def test_compaction_needs_one_shuffle(spark, tmp_path):
    one = "1L wld_id, 1L wtp_id, 0 wp_pos_x, 0 wp_pos_y, 1.0D wptm_value, timestamp'2024-01-02' wptm_created_date, 1 test_flag, 0L segment, 'h' file_hash"
    t.write_measurements(spark.sql(f"SELECT {one}"), str(tmp_path))
    rows = t.read_table(spark, str(tmp_path), "measurements").filter(F.col("yyyymm").isin(202401))
    order = ["yyyymm", *t.TABLES["measurements"].order]
    text = plan(rows.repartitionByRange(4, *order).distinct())
    assert shuffles(text) == 1 and "Filter (" not in text  # the month is chosen by partition, not by row


def test_views_read_their_rows_and_columns_only(spark, tmp_path):
    t.create_tables(spark, str(tmp_path))
    text = plan(ptr_view(t.read_table(spark, str(tmp_path), "measurements_landing")).select("wld_id", "result"))
    assert "EqualTo(record_type,PTR)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert schema == "wld_id:bigint,record_type:string,record_data:string"
