"""Trip and zone inputs, and readers for finished outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions.numeric import text
from waybill.profile import Profile
from waybill.sources.publish import EXECUTIVE, MissingOutput, committed, latest_month

__all__ = ["EXECUTIVE", "MissingOutput", "latest_month"]

# The trip feed's columns, in order.
TRIP_COLUMNS = {
    "VendorID": "bigint",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "bigint",
    "trip_distance": "double",
    "RatecodeID": "bigint",
    "store_and_fwd_flag": "string",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "bigint",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "Airport_fee": "double",
    "cbd_congestion_fee": "double",
}
# Fees that came into the feed over the years: older files lack them.
OPTIONAL = ("congestion_surcharge", "Airport_fee", "cbd_congestion_fee")
ZONE_COLUMNS = {
    "LocationID": "int",
    "Borough": "string",
    "Zone": "string",
    "service_zone": "string",
}
# Names of the published tables.
SPEED = "metric_1_congestion_speed"
REVENUE = "metric_2_revenue_productivity"
FLOW = "metric_3_zone_flow_imbalance"
CORRIDORS = "metric_4_airport_corridor"
TRUST = "metric_5_data_trust_vendor"
AUDIT = "validation_audit_report"
# Columns of the published tables.
PUBLISHED = {
    SPEED: "pickup_borough string, time_window string, trip_count bigint,"
    " avg_duration_min double, avg_distance_miles double, median_speed_mph double,"
    " p10_speed_mph double, p90_speed_mph double",
    REVENUE: "pickup_borough string, is_weekend boolean, time_window string,"
    " trip_count bigint, total_gross_revenue double, avg_fare_per_trip double,"
    " avg_revenue_per_active_min double, median_revenue_per_active_min double,"
    " avg_tip_amount double, avg_cc_tip_pct double",
    FLOW: "location_id int, borough string, zone_name string, total_pickups bigint,"
    " total_dropoffs bigint, net_passenger_flow bigint, flow_ratio double,"
    " operational_status string",
    CORRIDORS: "airport_corridor string, total_trips bigint, pct_of_all_trips double,"
    " avg_distance_miles double, avg_duration_min double, median_speed_mph double,"
    " avg_total_fare double, total_revenue double, avg_airport_fee double, avg_tolls double,"
    " avg_revenue_per_min double",
    TRUST: "vendor_name string, total_records_received bigint, passed_records bigint,"
    " quarantined_records bigint, trust_score_pct double, quarantine_rate_pct double,"
    " zero_dist_count bigint, non_positive_fare_count bigint, short_duration_count bigint,"
    " implausible_speed_count bigint",
    EXECUTIVE: "clean_trip_volume bigint, total_passenger_expenditure_usd double,"
    " overall_avg_trip_fare_usd double, overall_avg_distance_miles double,"
    " overall_avg_duration_minutes double, overall_median_speed_mph double,"
    " overall_avg_revenue_per_active_min double,"
    " total_mta_congestion_surcharge_collected double,"
    " total_airport_access_fees_collected double",
}
AUDIT_COLUMNS = (
    "total_records bigint, clean_records bigint, clean_rate_pct double,"
    " quarantined_records bigint, quarantine_rate_pct double,"
    " violations_by_rule map<string, bigint>, fde_assumptions_and_policy map<string, string>"
)


class IncompleteSource(ValueError):
    """A source that fails its completeness check."""


def conform_trips(trips: DataFrame) -> DataFrame:
    """Any trip-shaped frame with the feed's columns in the feed's types.

    Names match in any case; a fee column that is absent is NULL. Integers that come as
    doubles, as some tools write columns with gaps, are NULL where they are NaN. A cast
    that changes nothing disappears from the plan.
    """
    types = {c.lower(): t for c, t in trips.dtypes}
    missing = [c for c in TRIP_COLUMNS if c.lower() not in types and c not in OPTIONAL]
    if missing:
        raise IncompleteSource(f"trip columns missing: {', '.join(missing)}")

    def conformed(column: str, wanted: str) -> str:
        given = types.get(column.lower())
        if given is None:
            return f"CAST(NULL AS {wanted}) AS {column}"
        if wanted == "bigint" and given in ("float", "double"):
            return f"try_cast(nanvl({column}, NULL) AS {wanted}) AS {column}"
        return f"CAST({column} AS {wanted}) AS {column}"

    return trips.selectExpr(*[conformed(c, t) for c, t in TRIP_COLUMNS.items()])


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Lazy scan of the zone CSV. ``N/A`` stays a string."""
    schema = ", ".join(f"{c} {t}" for c, t in ZONE_COLUMNS.items())
    return spark.read.schema(schema).option("enforceSchema", False).csv(path, header=True)


def source_counts(trips: DataFrame, zones: DataFrame) -> DataFrame:
    n = F.expr("count(*) AS row_count")
    counted = trips.agg(n).selectExpr("'raw_trips' AS source", "row_count")
    return counted.unionByName(zones.agg(n).selectExpr("'raw_zones' AS source", "row_count"))


def zone_completeness(zones: DataFrame, profile: Profile) -> DataFrame:
    """One row: enough zones, and every required column present?"""
    absent = sorted(set(ZONE_COLUMNS) - set(zones.columns))
    enough = f"record_count >= {profile.min_zone_rows} AND {not absent}"
    return zones.agg(F.expr("count(*) AS record_count")).selectExpr(
        "record_count",
        f"{profile.min_zone_rows} AS expected_min_records",
        f"{text(', '.join(absent))} AS missing_columns",
        f"IF({enough}, 'VERIFIED_COMPLETE', 'INCOMPLETE') AS status",
    )


def require_complete_zones(zones: DataFrame, profile: Profile) -> None:
    check = zone_completeness(zones, profile).first()
    if check["status"] != "VERIFIED_COMPLETE":
        raise IncompleteSource(
            f"zones: {check['record_count']} rows, expected {check['expected_min_records']}"
            f" or more; missing columns: {check['missing_columns'] or 'none'}"
        )


def read_kpi(spark: SparkSession, out: str, name: str, label: str) -> DataFrame:
    """One published KPI table."""
    path = committed(spark, out, label).path(name, "csv")
    return spark.read.schema(PUBLISHED[name]).options(header=True, enforceSchema=False).csv(path)


def read_audit(spark: SparkSession, out: str, label: str) -> DataFrame:
    """One published audit; rules and policy notes as maps."""
    return spark.read.schema(AUDIT_COLUMNS).json(committed(spark, out, label).path(AUDIT, "json"))
