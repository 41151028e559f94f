"""Report series over the finished KPI tables (at most a few hundred rows each)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions.labels import lookup_or_key
from waybill.functions.numeric import ratio, round_exact, text
from waybill.operators.rules import trip_rules
from waybill.profile import TRUSTED_ABOVE_PCT, WINDOW_ORDER, Profile
from waybill.sources import readers


def kpi_cards(executive: DataFrame, audit_row: DataFrame) -> DataFrame:
    """The headline figures: executive summary and audit side by side in one row."""
    # Two one-row tables meet by union and fold, which needs no join.
    both = executive.unionByName(audit_row, allowMissingColumns=True)
    row = both.agg(*[F.expr(f"max({c}) AS {c}") for c in both.columns])
    scaled = row.selectExpr(
        "*",
        "total_passenger_expenditure_usd / 1e6D AS spend_m",
        "overall_avg_revenue_per_active_min * 60D AS per_hour",
        "total_mta_congestion_surcharge_collected / 1e6D AS surcharge_m",
    )
    return scaled.selectExpr(
        "clean_trip_volume",
        "clean_rate_pct",
        "quarantined_records",
        "quarantine_rate_pct",
        f"{round_exact('spend_m', 2)} AS total_spend_millions",
        f"{round_exact('overall_avg_trip_fare_usd', 2)} AS avg_trip_fare",
        "overall_avg_distance_miles AS avg_distance_miles",
        f"{round_exact('overall_median_speed_mph', 1)} AS median_speed_mph",
        f"{round_exact('overall_avg_duration_minutes', 1)} AS avg_duration_minutes",
        f"{round_exact('overall_avg_revenue_per_active_min', 2)} AS revenue_per_minute",
        f"{round_exact('per_hour', 2)} AS revenue_per_hour",
        f"{round_exact('surcharge_m', 2)} AS congestion_surcharge_millions",
        f"{round_exact('total_airport_access_fees_collected', 0)} AS airport_fees",
    )


def _by_window(table: DataFrame, key: str, value: str) -> DataFrame:
    """One column per time window, in report order, 0 where there is no value.

    ``value`` is an aggregate that reads ``{here}`` as the window's condition.
    """
    cells = {
        w: f"coalesce({value.format(here=f'time_window = {text(w)}')}, 0D) AS `{w}`"
        for w in WINDOW_ORDER
    }
    return table.groupBy(key).agg(*map(F.expr, cells.values()))


def speed_series(speed_index: DataFrame, boroughs: Sequence[str] | None = None) -> DataFrame:
    """Median speed per borough and time window."""
    table = speed_index
    if boroughs is not None:
        table = table.filter(F.col("pickup_borough").isin(list(boroughs)))
    rounded = table.selectExpr(
        "pickup_borough", "time_window", f"{round_exact('median_speed_mph', 2)} AS speed"
    )
    return _by_window(rounded, "pickup_borough", "max(speed) FILTER (WHERE {here})")


def revenue_series(revenue: DataFrame) -> DataFrame:
    """Trip-weighted revenue per minute, weekdays against weekends, by time window."""
    # A borough without a rate adds trips but no revenue.
    weighed = (
        revenue.groupBy("is_weekend", "time_window")
        .agg(
            F.expr("sum(avg_revenue_per_active_min * trip_count) AS earned"),
            F.expr("sum(trip_count) AS trips"),
        )
        .selectExpr("is_weekend", "time_window", f"{ratio('earned', 'trips')} AS rate")
        .selectExpr("is_weekend", "time_window", f"{round_exact('rate', 2)} AS rate")
    )
    return _by_window(weighed, "is_weekend", "max(rate) FILTER (WHERE {here})")


def violation_labels(violations: DataFrame, profile: Profile) -> DataFrame:
    """(rule, violation_count) with display labels, the raw key where none is known."""
    labels = {r.audit_key: r.label for r in trip_rules(profile)}
    return violations.selectExpr("*", f"{lookup_or_key('rule', labels)} AS label")


def _top_flow(flow: DataFrame, sign: str, rows: int) -> DataFrame:
    return (
        flow.filter(f"net_passenger_flow {sign} 0")
        .orderBy(F.expr("abs(net_passenger_flow)").desc(), "location_id")
        .limit(rows)
        .select("zone_name", "borough", "total_pickups", "total_dropoffs", "net_passenger_flow")
    )


def top_sources(flow: DataFrame, rows: int = 5) -> DataFrame:
    return _top_flow(flow, ">", rows)


def top_sinks(flow: DataFrame, rows: int = 5) -> DataFrame:
    return _top_flow(flow, "<", rows)


def corridor_feed(corridors: DataFrame) -> DataFrame:
    return corridors.select(
        "airport_corridor",
        "total_trips",
        "pct_of_all_trips",
        "avg_distance_miles",
        "avg_total_fare",
        "median_speed_mph",
        "avg_revenue_per_min",
    )


def vendor_feed(trust: DataFrame) -> DataFrame:
    return trust.selectExpr(
        "vendor_name",
        "total_records_received",
        "passed_records",
        "quarantined_records",
        "trust_score_pct",
        f"IF(trust_score_pct > {TRUSTED_ABOVE_PCT}D, 'trusted', 'at risk') AS trust_class",
        "quarantine_rate_pct",
        "zero_dist_count",
        "non_positive_fare_count",
        "short_duration_count",
    )


def month_report(
    spark: SparkSession,
    out: str,
    profile: Profile,
    boroughs: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Every report series from what a run published for the profile's period.

    Raises ``MissingOutput`` where that period was never run.
    """
    label = profile.period.label
    audit = readers.read_audit(spark, out, label)
    tables = {name: readers.read_kpi(spark, out, name, label) for name in readers.PUBLISHED}
    rates = audit.drop("violations_by_rule", "fde_assumptions_and_policy")
    violations = audit.selectExpr("explode(violations_by_rule) AS (rule, violation_count)")
    return {
        "kpi_cards": kpi_cards(tables[readers.EXECUTIVE], rates),
        "speed_series": speed_series(tables[readers.SPEED], boroughs),
        "revenue_series": revenue_series(tables[readers.REVENUE]),
        "violation_labels": violation_labels(violations, profile),
        "top_sources": top_sources(tables[readers.FLOW]),
        "top_sinks": top_sinks(tables[readers.FLOW]),
        "corridor_feed": corridor_feed(tables[readers.CORRIDORS]),
        "vendor_feed": vendor_feed(tables[readers.TRUST]),
    }
