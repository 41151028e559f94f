"""Headline timings; prints one JSON line.

Every query is planned and run from the raw tables (no cache between queries). The
first pass warms the JVM and is reported as ``cold``; ``queries`` holds the second.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from waybill.plans import catalog
from waybill.plans.monthly import run_month
from waybill.sources import orders

HEADLINE = (
    "dq_audit", "dq_quarantine", "fct_full", "m1_speed", "m2_revenue", "m3_flow",
    "m4_corridors", "m5_vendor_trust", "m6_executive", "fk_orphans", "raw_profile",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("waybill-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.log.level", "ERROR")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    queries = catalog.queries()

    def run(name: str) -> float:
        begun = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - begun, 3)

    def month() -> float:
        out = tempfile.mkdtemp(prefix="waybill-bench-")
        begun = time.perf_counter()
        run_month(
            orders.ORDER_PROFILE,
            orders.trips(spark, folder),
            orders.zones(spark, folder),
            out,
        )
        return round(time.perf_counter() - begun, 3)

    cold = {name: run(name) for name in HEADLINE} | {"whole_month": month()}
    warm = {name: run(name) for name in HEADLINE} | {"whole_month": month()}
    print(
        json.dumps(
            {
                "metric": "headline query total, second pass",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
