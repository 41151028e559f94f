"""The KPI tables.

Five of them come from cells of the fact: speed cells by borough (speed index), speed cells
by corridor (corridors and executive summary), revenue cells (revenue productivity) and
origin-destination counts (zone flow). ``shared_cells`` makes all of these in one scan, by
grouping sets; a table computed alone makes its own. Either way the cells are written before
they are summarised. Vendor trust comes from the gate's rollup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.numeric import UnitTotal, percent, round_half, text
from waybill.functions.ordering import sorted_small
from waybill.functions.temporal import window_rank
from waybill.operators.cells import CELL_ROWS, summarise, value_cells
from waybill.operators.flow import zone_flow, zone_flow_of
from waybill.profile import CARD_PAYMENT, Profile
from waybill.sources.sinks import scratch_folder, staged

SPEED, RATE = "effective_speed_mph", "revenue_per_minute"

MINUTES = UnitTotal("minutes", "duration_minutes", digits=2)
MILES = UnitTotal("miles", "trip_distance_miles", digits=2)
EARNINGS = UnitTotal("earnings", RATE, digits=3)
SPEND = UnitTotal("spend", "total_amount")
TIPS = UnitTotal("tips", "tip_amount")
TOLLS = UnitTotal("tolls", "tolls_amount")
AIRPORT_FEES = UnitTotal("airport_fees", "airport_fee")
CONGESTION = UnitTotal("congestion", "congestion_surcharge")
# Tip in percent of the fare, for card payments with a positive fare.
CARD_TIP_PCT = (
    f"IF(payment_type_id = {CARD_PAYMENT} AND fare_amount > 0,"
    " try_divide(tip_amount, fare_amount) * 100D, NULL) AS card_tip_pct"
)
CARD_TIPS = UnitTotal("card_tips", "card_tip_pct")

SPEED_INDEX = [MINUTES, MILES]
CORRIDOR = [MILES, MINUTES, SPEND, AIRPORT_FEES, TOLLS, EARNINGS]
EXECUTIVE = [SPEND, MILES, MINUTES, EARNINGS, CONGESTION, AIRPORT_FEES]
REVENUE = [SPEND, EARNINGS, TIPS, CARD_TIPS]
CORRIDOR_AND_EXECUTIVE = [*CORRIDOR, CONGESTION]


def corridor(profile: Profile) -> str:
    """The first corridor in priority order that either end of the trip touches."""
    cases = " ".join(
        f"WHEN pickup_location_id = {zone} OR dropoff_location_id = {zone} THEN {text(label)}"
        for zone, label in profile.corridors
    )
    return f"CASE {cases} ELSE {text(profile.other_corridor)} END AS airport_corridor"


def with_pickup_borough(fact: DataFrame, dim_zones: DataFrame) -> DataFrame:
    side = dim_zones.selectExpr(
        "location_id AS pickup_location_id", "borough AS pickup_borough"
    )
    return fact.join(side, "pickup_location_id")


def _written(cells: DataFrame, scratch: str | None) -> DataFrame:
    return staged(cells, scratch or scratch_folder(cells.sparkSession), "cells")


def shared_cells(fact: DataFrame, dim_zones: DataFrame, profile: Profile, folder: str) -> dict[str, DataFrame]:
    """The cells of every table, from one scan of the fact: a written part for each.

    A row is counted once under each grouping set before anything is shuffled. A trip whose
    pickup zone the dimension does not hold is left out of the tables by borough alone.
    """
    side = dim_zones.selectExpr("location_id AS zone", "borough AS pickup_borough", "TRUE AS known")
    rows = fact.join(side, F.expr("pickup_location_id = zone"), "left").selectExpr(
        "*", CARD_TIP_PCT, corridor(profile)
    )
    totals = [MINUTES, MILES, EARNINGS, SPEND, TIPS, TOLLS, AIRPORT_FEES, CONGESTION, CARD_TIPS]
    sets = {
        "speed": ["known", "pickup_borough", "time_window", SPEED],
        "revenue": ["known", "pickup_borough", "is_weekend", "time_window", RATE],
        "corridor": ["airport_corridor", SPEED],
        "pairs": ["pickup_location_id", "dropoff_location_id"],
    }
    columns = list(dict.fromkeys(c for s in sets.values() for c in s))
    # One bit a column, the first one highest: set where the column is not part of the row's set.
    level = {
        sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in of): name
        for name, of in sets.items()
    }
    which = " ".join(f"WHEN {k}L THEN '{name}'" for k, name in level.items())
    # Lanes are worked out once a row, then summed under each set.
    lanes = {name: call for t in totals for call, name in (lane.rsplit(" AS ", 1) for lane in t.lanes())}
    inner = {name: call.split("(", 1)[1].removesuffix(")") for name, call in lanes.items()}
    rows = rows.selectExpr(*columns, *[f"{of} AS {name}" for name, of in inner.items()])
    lanes = [f"count(*) AS {CELL_ROWS}", *[f"{call.split('(', 1)[0]}({name}) AS {name}" for name, call in lanes.items()]]
    counted = rows.groupingSets([[F.col(c) for c in s] for s in sets.values()], *columns).agg(
        *map(F.expr, lanes), F.grouping_id().alias("level")
    )
    named = counted.selectExpr("* EXCEPT (level)", f"CASE level {which} END AS cells")
    written = staged(named, folder, "cells", by="cells")
    parts = {name: written.filter(f"cells = '{name}'") for name in sets}
    known = {name: parts[name].filter("known") for name in ("speed", "revenue")}
    return parts | known


def speed_index(fact: DataFrame, dim_zones: DataFrame, scratch: str | None = None) -> DataFrame:
    keys = ["pickup_borough", "time_window"]
    cells = value_cells(with_pickup_borough(fact, dim_zones), keys, SPEED, SPEED_INDEX)
    return speed_index_of(_written(cells, scratch))


def speed_index_of(cells: DataFrame) -> DataFrame:
    keys, points = ["pickup_borough", "time_window"], {"p10": 0.1, "p50": 0.5, "p90": 0.9}
    table = summarise(cells, keys, SPEED, SPEED_INDEX, points).selectExpr(
        *keys,
        "n AS trip_count",
        f"{round_half('minutes_mean', 1)} AS avg_duration_min",
        f"{round_half('miles_mean', 2)} AS avg_distance_miles",
        f"{round_half('p50', 2)} AS median_speed_mph",
        f"{round_half('p10', 2)} AS p10_speed_mph",
        f"{round_half('p90', 2)} AS p90_speed_mph",
    )
    return sorted_small(table, *speed_order())


def speed_order() -> list[Column]:
    """By borough, then time window in report order."""
    return [F.asc_nulls_last("pickup_borough"), F.expr(window_rank("time_window")).asc()]


def revenue_productivity(fact: DataFrame, dim_zones: DataFrame, scratch: str | None = None) -> DataFrame:
    keys = ["pickup_borough", "is_weekend", "time_window"]
    rows = with_pickup_borough(fact, dim_zones).selectExpr("*", CARD_TIP_PCT)
    return revenue_productivity_of(_written(value_cells(rows, keys, RATE, REVENUE), scratch))


def revenue_productivity_of(cells: DataFrame) -> DataFrame:
    keys = ["pickup_borough", "is_weekend", "time_window"]
    table = summarise(cells, keys, RATE, REVENUE, {"p50": 0.5}).selectExpr(
        *keys,
        "n AS trip_count",
        f"{round_half('spend_total', 2)} AS total_gross_revenue",
        f"{round_half('spend_mean', 2)} AS avg_fare_per_trip",
        f"{round_half('earnings_mean', 2)} AS avg_revenue_per_active_min",
        f"{round_half('p50', 2)} AS median_revenue_per_active_min",
        f"{round_half('tips_mean', 2)} AS avg_tip_amount",
        f"{round_half('card_tips_mean', 1)} AS avg_cc_tip_pct",
    )
    return sorted_small(table, *[F.asc_nulls_last(k) for k in keys])


def zone_flow_imbalance(fact: DataFrame, dim_zones: DataFrame, profile: Profile) -> DataFrame:
    return zone_flow(dim_zones, fact, profile.flow)


def zone_flow_imbalance_of(pairs: DataFrame, dim_zones: DataFrame, profile: Profile) -> DataFrame:
    ends = pairs.selectExpr("pickup_location_id", "dropoff_location_id", f"{CELL_ROWS} AS n")
    return zone_flow_of(dim_zones, ends, profile.flow)


def corridor_cells(fact: DataFrame, profile: Profile) -> DataFrame:
    """One scan of the fact for both the corridors and the executive summary."""
    rows = fact.selectExpr("*", corridor(profile))
    return value_cells(rows, ["airport_corridor"], SPEED, CORRIDOR_AND_EXECUTIVE)


def airport_corridors(fact: DataFrame, profile: Profile) -> DataFrame:
    rows = fact.selectExpr("*", corridor(profile))
    return airport_corridors_of(_written(value_cells(rows, ["airport_corridor"], SPEED, CORRIDOR), None))


def airport_corridors_of(cells: DataFrame) -> DataFrame:
    summary = summarise(cells, ["airport_corridor"], SPEED, CORRIDOR, {"p50": 0.5})
    # Over the summary's rows: one a corridor, and the profile lists the corridors.
    every = summary.selectExpr("*", "sum(n) OVER () AS every")
    shared = every.selectExpr("*", f"{percent('n', 'every')} AS share")
    table = shared.selectExpr(
        "airport_corridor",
        "n AS total_trips",
        f"{round_half('share', 2)} AS pct_of_all_trips",
        f"{round_half('miles_mean', 2)} AS avg_distance_miles",
        f"{round_half('minutes_mean', 1)} AS avg_duration_min",
        f"{round_half('p50', 2)} AS median_speed_mph",
        f"{round_half('spend_mean', 2)} AS avg_total_fare",
        f"{round_half('spend_total', 2)} AS total_revenue",
        f"{round_half('airport_fees_mean', 2)} AS avg_airport_fee",
        f"{round_half('tolls_mean', 2)} AS avg_tolls",
        f"{round_half('earnings_mean', 2)} AS avg_revenue_per_min",
    )
    return sorted_small(table, F.desc("total_trips"), "airport_corridor")


def vendor_trust(rollup: DataFrame, dim_vendors: DataFrame) -> DataFrame:
    """Trust per vendor name over all received rows; unmapped ids share a NULL name."""
    sums = {
        "records": "total_records_received",
        "clean": "passed_records",
        "quarantined": "quarantined_records",
        "flag_zero_or_neg_distance": "zero_dist_count",
        "flag_negative_or_zero_fare": "non_positive_fare_count",
        "flag_duration_too_short": "short_duration_count",
        "flag_implausible_speed": "implausible_speed_count",
    }
    shared = (
        rollup.join(dim_vendors, F.expr("VendorID = vendor_id"), "left")
        .groupBy("vendor_name")
        .agg(*[F.expr(f"sum({c}) AS {name}") for c, name in sums.items()])
        .selectExpr(
            "*",
            f"{percent('passed_records', 'total_records_received')} AS trust_share",
            f"{percent('quarantined_records', 'total_records_received')} AS quarantine_share",
        )
    )
    table = shared.selectExpr(
        "vendor_name",
        "total_records_received",
        "passed_records",
        "quarantined_records",
        f"{round_half('trust_share', 2)} AS trust_score_pct",
        f"{round_half('quarantine_share', 2)} AS quarantine_rate_pct",
        "zero_dist_count",
        "non_positive_fare_count",
        "short_duration_count",
        "implausible_speed_count",
    )
    return sorted_small(
        table, F.desc("total_records_received"), F.asc_nulls_last("vendor_name")
    )


def executive_summary(fact: DataFrame) -> DataFrame:
    return executive_summary_of(_written(value_cells(fact, [], SPEED, EXECUTIVE), None))


def executive_summary_of(cells: DataFrame) -> DataFrame:
    return summarise(cells, [], SPEED, EXECUTIVE, {"p50": 0.5}).selectExpr(
        "coalesce(n, 0L) AS clean_trip_volume",
        f"{round_half('spend_total', 2)} AS total_passenger_expenditure_usd",
        f"{round_half('spend_mean', 2)} AS overall_avg_trip_fare_usd",
        f"{round_half('miles_mean', 2)} AS overall_avg_distance_miles",
        f"{round_half('minutes_mean', 1)} AS overall_avg_duration_minutes",
        f"{round_half('p50', 2)} AS overall_median_speed_mph",
        f"{round_half('earnings_mean', 2)} AS overall_avg_revenue_per_active_min",
        f"{round_half('congestion_total', 2)} AS total_mta_congestion_surcharge_collected",
        f"{round_half('airport_fees_total', 2)} AS total_airport_access_fees_collected",
    )
