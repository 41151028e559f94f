"""Profile queries over raw and clean trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.numeric import UnitTotal, percent, round_half, text
from waybill.operators.gate import measure
from waybill.operators.rules import DROPOFF, PICKUP, TRIP_SECONDS
from waybill.plans.kpis import CARD_TIP_PCT, CARD_TIPS
from waybill.profile import CASH_PAYMENT

# The columns that digital dispatch leaves empty.
DISPATCH_COLUMNS = (
    "passenger_count",
    "RatecodeID",
    "store_and_fwd_flag",
    "congestion_surcharge",
    "Airport_fee",
)


def _measures(df: DataFrame, *aggregates: str) -> DataFrame:
    return df.agg(*map(F.expr, aggregates))


def raw_profile(trips: DataFrame) -> DataFrame:
    """Totals, missing values and anomalies of the raw rows, one row."""
    return _measures(
        trips,
        "count(*) AS total_records",
        "count_if(passenger_count IS NULL) AS null_passenger_count",
        "count_if(RatecodeID IS NULL) AS null_ratecode_id",
        "count_if(congestion_surcharge IS NULL) AS null_congestion_surcharge",
        f"count_if({DROPOFF} < {PICKUP}) AS negative_duration",
        "count_if(trip_distance <= 0) AS zero_or_neg_distance",
        "count_if(fare_amount < 0) AS negative_fare",
        "count_if(total_amount < 0) AS negative_total",
    )


def transposed(one_row: DataFrame) -> DataFrame:
    """(metric, value) per column of a one-row table."""
    pairs = ", ".join(f"{text(c)}, CAST({c} AS DOUBLE)" for c in one_row.columns)
    return one_row.selectExpr(f"stack({len(one_row.columns)}, {pairs}) AS (metric, value)")


def null_cooccurrence(trips: DataFrame) -> DataFrame:
    """Which dispatch columns are missing together, per payment type."""
    patterns = [f"{c}_missing" for c in DISPATCH_COLUMNS]
    marked = trips.selectExpr(
        "payment_type", *[f"{c} IS NULL AS {p}" for c, p in zip(DISPATCH_COLUMNS, patterns)]
    )
    counts = marked.groupBy(*patterns, "payment_type").agg(F.expr("count(*) AS records"))
    # A scalar subquery over the counts, whose exchange is reused: no second scan, and no
    # window that would bring every pattern into one task.
    everything = counts.agg(F.sum("records").alias("n")).scalar()
    shared = counts.withColumn("all_records", everything)
    shared = shared.selectExpr("*", f"{percent('records', 'all_records')} AS share")
    return shared.selectExpr(
        *counts.columns, f"{round_half('share', 2)} AS pct_of_records"
    )


def null_rows_revenue(trips: DataFrame) -> DataFrame:
    """Rows without passenger count and the money they carry."""
    spend = UnitTotal("spend", "total_amount")
    unmanned = trips.filter("passenger_count IS NULL")
    return (
        _measures(unmanned, "count(*) AS records", *spend.lanes())
        .selectExpr("records", *spend.results())
        .selectExpr("records", f"{round_half('spend_total', 2)} AS total_amount_usd")
    )


def zero_second_trips(trips: DataFrame) -> DataFrame:
    return _measures(
        trips.selectExpr(f"{TRIP_SECONDS} AS seconds"),
        "count_if(seconds < 60) AS under_one_minute",
        "count_if(seconds = 0) AS zero_seconds",
    )


def extreme_outlier(trips: DataFrame) -> DataFrame:
    """The longest trip; among equals the fastest, then the latest."""
    ranked = (
        f"struct(trip_distance, effective_speed_mph, {PICKUP}, total_amount, duration_seconds)"
    )
    known = measure(trips).filter("trip_distance IS NOT NULL")
    return _measures(known, f"max({ranked}) AS top").select("top.*")


def card_tip_share(fact: DataFrame) -> DataFrame:
    """Average card tip as a percentage of the fare over all clean trips."""
    return (
        _measures(fact.selectExpr(CARD_TIP_PCT), *CARD_TIPS.lanes())
        .selectExpr("card_tips_seen AS card_trips", *CARD_TIPS.results())
        .selectExpr("card_trips", f"{round_half('card_tips_mean', 1)} AS avg_card_tip_pct")
    )


def cash_zero_tip_share(trips: DataFrame) -> DataFrame:
    return (
        _measures(
            trips.filter(f"payment_type = {CASH_PAYMENT}"),
            "count(*) AS cash_trips",
            "count_if(tip_amount = 0) AS zero_tip_trips",
        )
        .selectExpr("*", f"{percent('zero_tip_trips', 'cash_trips')} AS share")
        .selectExpr(
            "cash_trips", "zero_tip_trips", f"{round_half('share', 2)} AS zero_tip_pct"
        )
    )


def preview(fact: DataFrame, rows: int = 5) -> DataFrame:
    """The first few fact rows by pickup time, then by the columns shown."""
    columns = [
        "pickup_datetime",
        "time_window",
        "duration_minutes",
        "trip_distance_miles",
        "effective_speed_mph",
        "total_amount",
        "revenue_per_minute",
        "is_airport_trip",
    ]
    return fact.select(*columns).orderBy(*columns).limit(rows)
