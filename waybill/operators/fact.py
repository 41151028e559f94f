"""The enriched trip fact."""

from __future__ import annotations

from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.numeric import ieee_ratio, round_half, text
from waybill.functions.temporal import day_name, hour_of, is_weekend, iso_weekday, time_window
from waybill.operators.dimensions import in_zones
from waybill.operators.gate import measure, passing
from waybill.operators.rules import DROPOFF, PICKUP
from waybill.profile import UNASSIGNED_RATE_CODE, Profile


FACT_COLUMNS = (
    "vendor_id", "rate_code_id", "payment_type_id", "pickup_location_id", "dropoff_location_id",
    "pickup_datetime", "dropoff_datetime", "pickup_hour", "pickup_day_name",
    "pickup_day_of_week", "is_weekend", "time_window", "duration_minutes",
    "trip_distance_miles", "effective_speed_mph", "passenger_count", "fare_amount", "extra",
    "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge",
    "airport_fee", "cbd_congestion_fee", "total_amount", "revenue_per_minute",
    "is_intra_borough", "is_airport_trip", "is_cbd_involved",
)


def trip_measures(trips: DataFrame, profile: Profile) -> DataFrame:
    """One row per passing trip with every fact column that needs no dimension.

    This is all the KPI tables read, so computing one of them straight from raw trips
    pays for no zone lookup it does not use.
    """
    airports = profile.airport_zone_ids
    rated = measure(passing(trips, profile)).selectExpr(
        "*",
        "duration_seconds / 60D AS raw_minutes",
        f"{ieee_ratio('total_amount', '(duration_seconds / 60D)')} AS raw_rate",
    )
    return rated.selectExpr(
        *(c for c in trips.columns if c == "trip_id"),
        "VendorID AS vendor_id",
        f"coalesce(RatecodeID, {UNASSIGNED_RATE_CODE}) AS rate_code_id",
        "payment_type AS payment_type_id",
        "PULocationID AS pickup_location_id",
        "DOLocationID AS dropoff_location_id",
        f"{PICKUP} AS pickup_datetime",
        f"{DROPOFF} AS dropoff_datetime",
        f"{hour_of(PICKUP)} AS pickup_hour",
        f"{day_name(PICKUP)} AS pickup_day_name",
        f"{iso_weekday(PICKUP)} AS pickup_day_of_week",
        f"{is_weekend(PICKUP)} AS is_weekend",
        f"{time_window(PICKUP)} AS time_window",
        f"{round_half('raw_minutes', 2)} AS duration_minutes",
        f"{round_half('trip_distance', 2)} AS trip_distance_miles",
        f"{round_half('effective_speed_mph', 2)} AS effective_speed_mph",
        "passenger_count",
        "fare_amount",
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "improvement_surcharge",
        "coalesce(congestion_surcharge, 0D) AS congestion_surcharge",
        "coalesce(Airport_fee, 0D) AS airport_fee",
        "coalesce(cbd_congestion_fee, 0D) AS cbd_congestion_fee",
        "total_amount",
        f"{round_half('raw_rate', 3)} AS revenue_per_minute",
        f"coalesce({in_zones('PULocationID', airports)}"
        f" OR {in_zones('DOLocationID', airports)}, FALSE) AS is_airport_trip",
    )


def trip_fact(trips: DataFrame, dim_zones: DataFrame, profile: Profile) -> DataFrame:
    """The fact: trip measures plus the zone flags, and the key of trips that have one.

    The zone dimension is joined twice (pickup, dropoff) and carries no broadcast
    hint: it is broadcast when its known size is under the session threshold, and
    merge-joined with adaptive skew splitting otherwise.
    """

    def side(prefix: str) -> DataFrame:
        return dim_zones.selectExpr(
            f"location_id AS {prefix}_id",
            f"borough AS {prefix}_borough",
            f"is_manhattan_cbd AS {prefix}_cbd",
        )

    return (
        trip_measures(trips, profile)
        .join(side("pu"), F.expr("pickup_location_id = pu_id"), "left")
        .join(side("do"), F.expr("dropoff_location_id = do_id"), "left")
        .selectExpr(
            "*",
            "coalesce(pu_borough = do_borough, FALSE) AS is_intra_borough",
            "coalesce(pu_cbd OR do_cbd, FALSE) AS is_cbd_involved",
        )
        .select(*(c for c in trips.columns if c == "trip_id"), *FACT_COLUMNS)
    )


def with_trip_id(written: DataFrame) -> DataFrame:
    """Rows read from written Parquet files, with ``trip_id`` from 1 to their number.

    Two passes: the rows of each file are counted, which reads no column, and a row's id is its
    place in its file plus the rows of the files before. Only a number a file reaches the driver
    and comes back, no row is moved, and a task that runs again finds the same places.
    """
    rows = written.selectExpr("*", "_metadata.file_path AS id_file", "_metadata.row_index AS id_place")
    counts = written.groupBy("_metadata.file_path").agg(F.expr("count(*) AS n")).collect()
    before = list(accumulate((r["n"] for r in counts), initial=1))[: len(counts)]
    files = pa.array([r["file_path"] for r in counts], pa.string())
    # A local relation, whose size the planner knows.
    starts = written.sparkSession.createDataFrame(
        pa.table({"start_file": files, "id_start": pa.array(before, pa.int64())})
    )
    numbered = rows.join(starts, F.expr("id_file = start_file"))
    return numbered.selectExpr("id_start + id_place AS trip_id", *written.columns)


def orphan_keys(
    fact: DataFrame, references: dict[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Rows and distinct keys per foreign key that its dimension does not hold.

    ``references`` maps a fact column to (dimension, dimension key). One scan: every
    row is unfolded into its keys and counted per key before the shuffle, so a hot
    key costs no more than a rare one. NULL keys reference nothing. Every foreign key has
    a row, also over an empty fact.
    """
    pairs = ", ".join(f"{text(c)}, CAST({c} AS BIGINT)" for c in references)
    used = (
        fact.selectExpr(f"stack({len(references)}, {pairs}) AS (foreign_key, key_id)")
        .groupBy("foreign_key", "key_id")
        .agg(F.expr("count(*) AS n"))
    )
    known = None
    for column, (dim, key) in references.items():
        part = dim.selectExpr(
            f"{text(column)} AS foreign_key", f"CAST({key} AS BIGINT) AS key_id", "TRUE AS found"
        ).distinct()
        known = part if known is None else known.unionByName(part)
    counted = (
        used.join(known, ["foreign_key", "key_id"], "left")
        .selectExpr("*", "key_id IS NOT NULL AND found IS NULL AS is_orphan")
        .groupBy("foreign_key")
        .agg(
            F.expr("sum(n) AS fact_rows"),
            F.expr("sum(IF(is_orphan, n, 0L)) AS orphan_rows"),
            F.expr("count_if(is_orphan) AS orphan_keys"),
        )
    )
    names = ", ".join(text(c) for c in references)
    every = fact.sparkSession.sql(f"SELECT explode(array({names})) AS foreign_key")
    return every.join(counted, "foreign_key", "left").na.fill(0)


def key_usage(dim: DataFrame, key: str, fact: DataFrame, foreign_key: str) -> DataFrame:
    """The dimension with the number of fact rows that reference each member."""
    counts = fact.groupBy(foreign_key).agg(F.expr("count(*) AS n"))
    return dim.join(counts.withColumnRenamed(foreign_key, key), key, "left").selectExpr(
        *dim.columns, "coalesce(n, 0L) AS fact_rows"
    )
