"""Arrivals against departures per zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.numeric import ratio, round_half, text
from waybill.functions.ordering import sorted_small
from waybill.profile import FlowLimits

# Flow states.
DEFICIT = "Critical Deficit (Demand Source)"
SURPLUS = "Critical Surplus (Fleet Sink)"
BALANCED = "Balanced Flow"


def pair_counts(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Trips per origin-destination pair."""
    return fact.groupBy("pickup_location_id", "dropoff_location_id", *by).agg(F.expr("count(*) AS n"))


def endpoint_counts(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Pickups and dropoffs per zone: the few pair counts unfolded into their two ends."""
    ends = pairs.selectExpr(
        *by,
        "stack(2, pickup_location_id, n, 0L, dropoff_location_id, 0L, n)"
        " AS (location_id, pickups, dropoffs)",
    )
    return ends.groupBy("location_id", *by).agg(
        F.expr("sum(pickups) AS pickups"), F.expr("sum(dropoffs) AS dropoffs")
    )


def zone_flow(
    dim_zones: DataFrame, fact: DataFrame, limits: FlowLimits, by: Sequence[str] = ()
) -> DataFrame:
    """Zones busier than the volume limit, largest imbalance first, in one scan of the fact.

    With ``by`` the grain is (zone, by) and only combinations with trips appear.
    """
    return zone_flow_of(dim_zones, pair_counts(fact, by), limits, by)


def zone_flow_of(
    dim_zones: DataFrame, pairs: DataFrame, limits: FlowLimits, by: Sequence[str] = ()
) -> DataFrame:
    ends = endpoint_counts(pairs, by)
    counted = dim_zones.join(ends, "location_id", "inner" if by else "left").selectExpr(
        "location_id",
        "borough",
        "zone_name",
        *by,
        "coalesce(pickups, 0L) AS total_pickups",
        "coalesce(dropoffs, 0L) AS total_dropoffs",
    )
    netted = counted.filter(f"total_pickups + total_dropoffs > {limits.min_volume}").selectExpr(
        "*",
        "total_pickups - total_dropoffs AS net_passenger_flow",
        f"{ratio('total_pickups', 'total_dropoffs')} AS raw_ratio",
    )
    state = (
        f"CASE WHEN net_passenger_flow > {limits.critical} THEN {text(DEFICIT)}"
        f" WHEN net_passenger_flow < {-limits.critical} THEN {text(SURPLUS)}"
        f" ELSE {text(BALANCED)} END"
    )
    table = netted.selectExpr(
        *counted.columns,
        "net_passenger_flow",
        f"{round_half('raw_ratio', 3)} AS flow_ratio",
        f"{state} AS operational_status",
    )
    return sorted_small(table, F.expr("abs(net_passenger_flow)").desc(), "location_id", *by)
