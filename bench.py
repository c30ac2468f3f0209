"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from rodovia.session import configure
from rodovia.workload.catalog import QUERIES

HEADLINE = [
    "r1_monthly_revenue", "r2_top_clients", "r3_cancellation_rate", "r4_yard_use", "r7_never_rented",
    "dedup_latest", "conf_reserva", "conf_locacao", "conf_cobranca", "fato_locacao", "assign_keys", "upsert_scd1",
    "calendar", "q03_staging_duplicates", "i6_foreign_keys", "vw_clientes_mais_frequentes", "z_per_second_batch",
    "z_session", "z_usage", "z_clip_join", "z_tumbling", "warehouse_load",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = configure(SparkSession.builder.master(f"local[{cpus}]").appName("bench"), **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false"}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # warm-up
    times = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - began, 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else None}))
    spark.stop()


if __name__ == "__main__":
    main()
