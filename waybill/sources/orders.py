"""Trip-shaped view of the order tables used as test input.

Maps line items to trips, nations to zones. Every trip column is a deterministic
function of the order tables, and together they break every quality rule.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.profile import FlowLimits, Period, Profile, Thresholds

ORDER_PROFILE = Profile(
    period=Period(datetime(1996, 1, 1), datetime(2001, 1, 1), "2000_12"),
    thresholds=Thresholds(valid_max_location_id=23),
    zone_id_range=(1, 23),
    min_zone_rows=25,
    cbd_zone_ids=(1, 2, 3, 4, 5),
    corridors=((5, "Hub 5"), (10, "Hub 10"), (15, "Hub 15")),
    other_corridor="No Hub",
    flow=FlowLimits(min_volume=2000, critical=500),
    policy={
        "passenger_count_nulls": "Kept; left out of per-passenger figures only.",
        "ratecode_id_nulls": "Mapped to rate code 99.",
        "quarantine_policy": "Trips that break a rule are set apart with their reasons.",
    },
)


# Only the columns read; naming types up front saves a footer job per table.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def zones(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = _table(spark, folder, "nation"), _table(spark, folder, "region")
    return nation.join(region, F.expr("n_regionkey = r_regionkey")).selectExpr(
        "n_nationkey + 1 AS LocationID",
        "r_name AS Borough",
        "n_name AS Zone",
        "r_name AS service_zone",
    )


def _items(lineitem: DataFrame) -> DataFrame:
    """What follows from the line item alone, computed before anything is joined."""
    coded = lineitem.selectExpr(
        "*",
        "CASE WHEN l_orderkey % 7 < 2 THEN 0L ELSE 1 + l_orderkey % 4 END AS pay",
        "IF(l_returnflag = 'R' AND l_discount > 0.095D, -l_extendedprice / 1000D,"
        " l_extendedprice / 1000D) AS fare",
    )
    return coded.selectExpr(
        "l_orderkey",
        "l_suppkey",
        "l_linenumber AS VendorID",
        "CAST((l_orderkey * 997 + l_linenumber * 3571) % 86400 AS INT) AS offset",
        "CAST(CASE WHEN l_partkey % 97 = 0 THEN -300 WHEN l_partkey % 89 = 0 THEN 90000"
        " WHEN l_partkey % 53 = 0 THEN 75"
        " ELSE (l_partkey * 37 + l_orderkey * 11) % 3600 END AS INT) AS seconds",
        "IF(pay <> 0, 1 + l_suppkey % 4, NULL) AS passenger_count",
        "CASE WHEN l_partkey % 83 = 0 THEN 160D WHEN l_partkey % 79 = 0 THEN 0D"
        " ELSE l_quantity / 5D END AS trip_distance",
        "IF(pay <> 0, 1 + l_linenumber % 6, NULL) AS RatecodeID",
        "IF(pay <> 0, IF(l_linestatus = 'F', 'Y', 'N'), NULL) AS store_and_fwd_flag",
        "pay AS payment_type",
        "fare AS fare_amount",
        "IF(pay = 1, fare * l_discount, 0D) AS tip_amount",
        "l_tax * 10D AS tolls_amount",
        "fare * (1D + l_tax) * IF(l_partkey % 71 = 0, 15D, 1D) AS total_amount",
    )


def trips(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with their order, customer zone and supplier zone.

    Orders meet customers before they meet line items, so the largest table is
    exchanged once per key it joins on and never for the customer key. Line items and
    orders are both facts, so that join is always a merge join, which spills and whose
    skewed keys adaptive execution splits; the other sides are broadcast while they
    fit the planner's threshold and merge-joined beyond it.
    """
    placed = (
        _table(spark, folder, "orders")
        .join(_table(spark, folder, "customer"), F.expr("o_custkey = c_custkey"))
        .selectExpr("o_orderkey", "o_orderdate", "c_nationkey + 1 AS DOLocationID")
    )
    shippers = _table(spark, folder, "supplier").selectExpr(
        "s_suppkey", "s_nationkey + 1 AS PULocationID"
    )
    return (
        _items(_table(spark, folder, "lineitem"))
        .join(placed.hint("merge"), F.expr("l_orderkey = o_orderkey"))
        .join(shippers, F.expr("l_suppkey = s_suppkey"))
        .selectExpr(
            "VendorID",
            "o_orderdate + offset * INTERVAL '1' SECOND AS tpep_pickup_datetime",
            "o_orderdate + (offset + seconds) * INTERVAL '1' SECOND AS tpep_dropoff_datetime",
            "passenger_count",
            "trip_distance",
            "RatecodeID",
            "store_and_fwd_flag",
            "PULocationID",
            "DOLocationID",
            "payment_type",
            "fare_amount",
            "0.5D AS extra",
            "0.5D AS mta_tax",
            "tip_amount",
            "tolls_amount",
            "1D AS improvement_surcharge",
            "total_amount",
            "IF(payment_type <> 0, 2.5D, NULL) AS congestion_surcharge",
            "IF(payment_type <> 0, IF(PULocationID = 5, 1.75D, 0D), NULL) AS Airport_fee",
            "IF(payment_type <> 0, 0.75D, NULL) AS cbd_congestion_fee",
        )
    )
