"""Timed headline queries; prints one JSON line.

Inputs are prepared before the clock starts; every query runs once untimed at the same
size, and its best of two timed runs is reported. Results are computed in full
(``noop`` sink or a written table).
"""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from catalog import measures  # noqa: E402
from catalog.views import view  # noqa: E402
from dieflow.operators import landing, measurements as m, quality, stats, wafer  # noqa: E402
from dieflow.plans import load, tables as t  # noqa: E402
from dieflow.session import scratch_path, session  # noqa: E402
from dieflow.sources import decode as d  # noqa: E402
from dieflow.sources.files import stdf_files  # noqa: E402
from dieflow.sources.frames import stdf_frames  # noqa: E402
from fixtures.datalogs import SEQUENCE, datalog_files, lot_files, write_files  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = session(
        "bench", spark__master=f"local[{CPUS}]", spark__sql__shuffle__partitions=str(2 * int(CPUS)), spark__driver__memory="16g",
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def stored(df, name):
        path = scratch_path(spark, name)
        df.repartition(int(CPUS)).write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    logs = stored(datalog_files(spark, SF_DIR), "logs")
    product = stored(m.device_test_product(measures.devices(spark, SF_DIR), measures.tests(spark, SF_DIR)), "product")
    records = stored(view(spark, SF_DIR, "record_log"), "record_log")
    parts = stored(view(spark, SF_DIR, "wafer_parts"), "wafer_parts")
    rows = stored(view(spark, SF_DIR, "landing_full"), "landing")
    n_product, n_records, n_log, n_landing = product.count(), logs.count() * (len(SEQUENCE) + 1), records.count(), rows.count()

    # A directory of real files, loaded twice; the second load must add nothing.
    folder, base = scratch_path(spark, "incoming"), scratch_path(spark, "tables")
    write_files(lot_files(spark, SF_DIR, 8), folder)
    t.create_tables(spark, base)
    stamp = F.lit("2024-01-15 00:00:00")

    def directory_load():
        return load.load_files(spark, stdf_files(spark, folder), base, stamp)

    def typed_views():
        run(landing.ptr_view(rows))
        run(landing.mpr_view(rows))

    benches = {
        "product_explode": (n_product, lambda: run(measures.product(spark, SF_DIR))),
        "product_with_segment": (n_product, lambda: run(m.numbered_product(measures.devices(spark, SF_DIR), measures.tests(spark, SF_DIR)))),
        "segment_window": (n_product, lambda: run(m.segment(product))),
        "write_fact": (n_product, lambda: t.write_measurements(
            m.to_fact(product.withColumns({"wld_id": F.col("device_index"), "wtp_id": F.col("test_num"), "segment": F.lit(0), "file_hash": F.col("path")}), stamp),
            scratch_path(spark, "fact"))),
        "frames": (n_records, lambda: run(stdf_frames(logs))),
        "frames_decode": (n_records, lambda: run(d.read_records(logs, load.LOAD_FIELDS))),
        "typed_views": (n_landing, typed_views),
        "record_stats": (n_log, lambda: run(stats.record_stats(records))),
        "validate_files": (n_log, lambda: run(quality.validate_files(records))),
        "wafer_map": (parts.count(), lambda: run(wafer.wafer_map(parts))),
    }
    seconds, rates = {}, {}
    for name, (n, fn) in benches.items():
        fn()
        best = min(_timed(fn) for _ in range(2))
        seconds[name], rates[name] = round(best, 3), round(n / best)
    seconds["load_directory"] = round(_timed(directory_load), 3)
    n_loaded = t.read_table(spark, base, "measurements").count()
    rates["load_directory"] = round(n_loaded / seconds["load_directory"])
    seconds["load_duplicate"] = round(_timed(directory_load), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "rows_per_second": rates, "rows": {**{name: n for name, (n, _) in benches.items()}, "load_directory": n_loaded}, "cpus": int(CPUS), "sf": SF_DIR.rsplit("sf", 1)[-1],
    }))


def _timed(fn) -> float:
    began = time.time()
    fn()
    return time.time() - began


if __name__ == "__main__":
    main()
