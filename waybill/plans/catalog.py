"""Every query by name, over the order tables of one folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta
from functools import cached_property, reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.operators import dimensions, fact, flow, gate
from waybill.operators.rules import DROPOFF, PICKUP, trip_rules
from waybill.plans import kpis, monthly, profiling, report
from waybill.profile import FlowLimits, Period, Thresholds
from waybill.sources import manifest, orders, publish, readers, sinks

PROFILE = orders.ORDER_PROFILE
STRICT = Thresholds(
    min_duration_seconds=300,
    max_duration_seconds=3000,
    min_distance_miles=1.0,
    max_distance_miles=8.0,
    max_implausible_speed_mph=40.0,
    min_fare_amount=5.0,
    max_total_amount=90.0,
    valid_min_location_id=3,
    valid_max_location_id=20,
)
BAND_FLOW = FlowLimits(min_volume=0, critical=100)
TRIP_KEY = ["VendorID", PICKUP, DROPOFF, "PULocationID", "DOLocationID", "total_amount"]


class Workbench:
    """The lazy frames the queries start from."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def trips(self) -> DataFrame:
        return orders.trips(self.spark, self.folder)

    @cached_property
    def zones(self) -> DataFrame:
        return orders.zones(self.spark, self.folder)

    @cached_property
    def dim_zones(self) -> DataFrame:
        return dimensions.zones(self.zones, PROFILE)

    @cached_property
    def rollup(self) -> DataFrame:
        return gate.vendor_rollup(self.trips, PROFILE)

    @cached_property
    def audit(self) -> DataFrame:
        return gate.audit(self.rollup, PROFILE)

    @cached_property
    def fact(self) -> DataFrame:
        return fact.trip_fact(self.trips, self.dim_zones, PROFILE)

    @cached_property
    def measures(self) -> DataFrame:
        return fact.trip_measures(self.trips, PROFILE)

    @cached_property
    def m1(self) -> DataFrame:
        return kpis.speed_index(self.measures, self.dim_zones)

    @cached_property
    def m2(self) -> DataFrame:
        return kpis.revenue_productivity(self.measures, self.dim_zones)

    @cached_property
    def m3(self) -> DataFrame:
        return kpis.zone_flow_imbalance(self.measures, self.dim_zones, PROFILE)

    @cached_property
    def m4(self) -> DataFrame:
        return kpis.airport_corridors(self.measures, PROFILE)

    @cached_property
    def m5(self) -> DataFrame:
        return kpis.vendor_trust(self.rollup, dimensions.vendors(self.spark, PROFILE))

    @cached_property
    def m6(self) -> DataFrame:
        return kpis.executive_summary(self.measures)

    @property
    def flags(self) -> list[str]:
        return [r.flag for r in trip_rules(PROFILE)]

    # Queries with more to them than one call.

    def manifest_summary(self) -> DataFrame:
        return manifest.file_manifest(self.spark, self.folder, hashed=False).selectExpr(
            "file_name",
            "num_rows",
            "num_columns",
            "array_join(schema_columns, ',') AS columns",
            "status",
        )

    def latest_month(self) -> DataFrame:
        """A record for each month of the fact, finished when its last trip ended, and one of
        an earlier attempt at each; the month that the ledger then names."""
        out = sinks.scratch_folder(self.spark)
        months = self.measures.groupBy(F.expr("date_format(pickup_datetime, 'yyyy_MM') AS label")).agg(
            F.expr("CAST(max(dropoff_datetime) AS TIMESTAMP) AS finished"), F.expr("count(*) AS n")
        )
        runs = months.selectExpr("*", "stack(2, 'first', INTERVAL '90' DAY, 'second', INTERVAL '0' DAY) AS (run, age)")
        publish.append(
            runs.selectExpr(
                "label", "run", "finished - age AS finished",
                f"concat('runs/', run, '/{publish.EXECUTIVE}_', label, '.csv') AS summary",
                "n AS total_records", "n AS clean_records", "0L AS quarantined_records",
            ),
            out,
        )
        return publish.latest_month(self.spark, out, "1970-01")

    def strict_audit(self) -> DataFrame:
        strict = replace(PROFILE, thresholds=STRICT)
        return gate.audit(gate.vendor_rollup(self.trips, strict), strict)

    def usage(self, dim, key: str) -> DataFrame:
        return fact.key_usage(dim(self.spark, PROFILE), key, self.measures, key)

    def orphans(self) -> DataFrame:
        spark = self.spark
        return fact.orphan_keys(
            self.measures,
            {
                "vendor_id": (dimensions.vendors(spark, PROFILE), "vendor_id"),
                "rate_code_id": (dimensions.rate_codes(spark, PROFILE), "rate_code_id"),
                "payment_type_id": (dimensions.payment_types(spark, PROFILE), "payment_type_id"),
                "pickup_location_id": (self.dim_zones, "location_id"),
                "dropoff_location_id": (self.dim_zones, "location_id"),
            },
        )

    def build_counts(self) -> DataFrame:
        n = F.expr("count(*) AS row_count")
        facts = self.fact.agg(n).selectExpr("'fct_trips' AS table_name", "row_count")
        zones = self.dim_zones.agg(n).selectExpr("'dim_zones' AS table_name", "row_count")
        return facts.unionByName(zones)

    def trip_id_check(self) -> DataFrame:
        written = sinks.staged(self.fact, sinks.scratch_folder(self.spark), "fact")
        return fact.with_trip_id(written).agg(
            F.expr("count(*) AS fact_rows"),
            F.expr("count(DISTINCT trip_id) AS trip_ids"),
            F.expr("min(trip_id) AS first_id"),
            F.expr("max(trip_id) AS last_id"),
        )

    def attempt(self) -> publish.Attempt:
        return publish.begin(self.spark, sinks.scratch_folder(self.spark), PROFILE.period.label)

    def quarantine_roundtrip(self) -> DataFrame:
        run = self.attempt()
        run.table(gate.quarantined(self.trips, PROFILE), "quarantined_trips")
        run.commit()
        return publish.read_table(self.spark, run.out, "quarantined_trips", run.label)

    def fact_roundtrip(self) -> DataFrame:
        run = self.attempt()
        run.table(self.fact, "fct_trips")
        run.commit()
        return publish.read_table(self.spark, run.out, "fct_trips", run.label)

    def kpi_roundtrip(self) -> DataFrame:
        return self.kpi_published(self.m1, readers.SPEED)

    def kpi_published(self, table: DataFrame, name: str) -> DataFrame:
        run = self.attempt()
        run.kpi(table, name)
        run.commit()
        return readers.read_kpi(self.spark, run.out, name, run.label)

    def audit_roundtrip(self) -> DataFrame:
        run = self.attempt()
        run.report(gate.audit_report(self.audit, PROFILE), readers.AUDIT)
        run.commit()
        maps = {
            "violations_by_rule": [r.audit_key for r in trip_rules(PROFILE)],
            "fde_assumptions_and_policy": list(PROFILE.policy),
        }
        return readers.read_audit(self.spark, run.out, run.label).selectExpr(
            "total_records",
            "clean_records",
            "clean_rate_pct",
            "quarantined_records",
            "quarantine_rate_pct",
            *[f"{column}['{key}'] AS {key}" for column, keys in maps.items() for key in keys],
        )

    def december_audit(self) -> DataFrame:
        """One month, whose period ends in the next year."""
        december = replace(PROFILE, period=Period.month("1997-12"))
        return gate.audit(gate.vendor_rollup(self.trips, december), december)

    def no_trips_orphans(self) -> DataFrame:
        empty = Workbench(self.spark, self.folder)
        empty.trips = self.trips.filter(f"{PICKUP} < TIMESTAMP_NTZ '1900-01-01'")
        return empty.orphans()

    def rerun_replaces(self) -> DataFrame:
        """Two labels are published, then one of them again with rows that all fail; a last
        attempt at the other one is never committed."""
        out = sinks.scratch_folder(self.spark)
        trips = sinks.staged(self.trips, out, "trips")
        none_pass = replace(PROFILE, thresholds=Thresholds(min_distance_miles=1e6))
        tables = {"clean": gate.clean, "quarantine": gate.quarantined}
        attempts = [
            (publish.begin(self.spark, out, label), profile, ends)
            for label, profile, ends in (
                ("kept", PROFILE, True), ("rerun", PROFILE, True), ("rerun", none_pass, True), ("kept", none_pass, False),
            )
        ]
        # No attempt sees another's folder, so all are written at once; they are committed in turn.
        monthly._together(
            self.spark,
            *(
                lambda run=run, profile=profile, name=name, part=part: run.table(part(trips, profile), name)
                for run, profile, _ in attempts
                for name, part in tables.items()
            ),
        )
        for run, _, ends in attempts:
            if ends:
                run.commit()
        counts = [
            publish.read_table(self.spark, out, name, label)
            .agg(F.count("*").alias("row_count"))
            .select(F.lit(label).alias("label"), F.lit(name).alias("table_name"), "row_count")
            for label in ("kept", "rerun")
            for name in tables
        ]
        return reduce(DataFrame.unionByName, counts)

    def trip_folder(self) -> DataFrame:
        """Trips written as three files that differ as published ones do, read back as one."""
        out = sinks.scratch_folder(self.spark)
        trips = sinks.staged(readers.conform_trips(self.trips), out, "trips")
        as_int = [f"CAST({c} AS INT) AS {c}" for c in ("PULocationID", "DOLocationID")]
        as_double = [
            f"coalesce(CAST({c} AS DOUBLE), double('nan')) AS {c}"
            for c in ("passenger_count", "RatecodeID")
        ]
        narrow = trips.drop("PULocationID", "DOLocationID", "cbd_congestion_fee", "Airport_fee")
        shapes = (
            trips,
            trips.selectExpr(*narrow.columns, *as_int, "Airport_fee AS airport_fee"),
            trips.selectExpr(*trips.drop("passenger_count", "RatecodeID").columns, *as_double),
        )
        for i, shape in enumerate(shapes):
            shape.filter(f"VendorID % 3 = {i}").write.mode("append").parquet(f"{out}/mixed")
        return manifest.verified_trips(self.spark, f"{out}/mixed").groupBy("VendorID").agg(
            F.expr("count(*) AS records"),
            F.expr("sum(passenger_count) AS passengers"),
            F.expr("sum(RatecodeID) AS rate_codes"),
            F.expr("sum(PULocationID) + sum(DOLocationID) AS zones"),
            F.expr("sum(Airport_fee) AS airport_fees"),
            F.expr("sum(cbd_congestion_fee) AS cbd_fees"),
            F.expr("max(tpep_dropoff_datetime) AS last_dropoff"),
        )

    def zone_csv(self) -> DataFrame:
        path = sinks.scratch_folder(self.spark) + "/zones.csv"
        self.zones.write.option("header", True).csv(path)
        return readers.read_zones(self.spark, path)

    def published_revenue(self) -> DataFrame:
        return self.kpi_published(self.m2, readers.REVENUE)

    def published(self, series: str) -> DataFrame:
        """A series of the whole period, which is run once a session and folder."""
        key = self.spark.sparkContext.applicationId, self.folder
        if key not in _PERIODS:
            out = sinks.scratch_folder(self.spark)
            monthly.run_month(PROFILE, self.trips, self.zones, out)
            _PERIODS[key] = out
        return report.month_report(self.spark, _PERIODS[key], PROFILE)[series]

    def memory_gate(self) -> DataFrame:
        """The gate over trips that no file holds: one for each zone, made on the driver, which
        holds the zones of any period anyway. The farther zones are too far for a quarter hour."""
        rows = self.zones.toPandas()[["LocationID"]].assign(VendorID=1, passenger_count=1, RatecodeID=1, payment_type=1)
        begun = PROFILE.period.start
        rows = rows.assign(
            tpep_pickup_datetime=begun, tpep_dropoff_datetime=begun + timedelta(minutes=15),
            trip_distance=rows["LocationID"] - 1.0, store_and_fwd_flag="N", PULocationID=rows["LocationID"],
            DOLocationID=rows["LocationID"], fare_amount=10.0, total_amount=12.5, extra=0.5, mta_tax=0.5,
            tip_amount=0.0, tolls_amount=0.0, improvement_surcharge=1.0,
        )
        trips = readers.conform_trips(self.spark.createDataFrame(pa.Table.from_pandas(rows, preserve_index=False)))
        return gate.audit(gate.vendor_rollup(trips, PROFILE), PROFILE).select(
            "total_records", "quarantined_records", "distance_under_0_05mi", "speed_over_85mph", "unknown_or_unmapped_zone"
        )


#: Output folders of whole periods by session and input.
_PERIODS: dict[tuple[str, str], str] = {}
_CALENDAR = ["pickup_hour", "pickup_day_name", "pickup_day_of_week", "is_weekend", "time_window"]
_MONEY = [
    "rate_code_id", "fare_amount", "total_amount", "congestion_surcharge", "airport_fee",
    "cbd_congestion_fee", "duration_minutes", "trip_distance_miles", "effective_speed_mph",
    "revenue_per_minute",
]
_ZONE_FLAGS = [
    "pickup_location_id", "dropoff_location_id", "is_intra_borough", "is_airport_trip",
    "is_cbd_involved",
]

_QUERIES: dict[str, Callable[[Workbench], DataFrame]] = {
    "source_counts": lambda w: readers.source_counts(w.trips, w.zones),
    "zone_completeness": lambda w: readers.zone_completeness(w.zones, PROFILE),
    "file_manifest": lambda w: manifest.file_manifest(w.spark, w.folder),
    "manifest_summary": Workbench.manifest_summary,
    "file_hashes": lambda w: manifest.hash_checks(w.spark, w.folder),
    "latest_month": Workbench.latest_month,
    "memory_gate": Workbench.memory_gate,
    "raw_profile": lambda w: profiling.raw_profile(w.trips),
    "profile_long": lambda w: profiling.transposed(profiling.raw_profile(w.trips)),
    "dq_duration_speed": lambda w: gate.measure(w.trips).select(
        *TRIP_KEY, "duration_seconds", "effective_speed_mph"
    ),
    "dq_rule_flags": lambda w: gate.flag(w.trips, PROFILE).select(*TRIP_KEY, *w.flags),
    "dq_reasons": lambda w: gate.tag(w.trips, PROFILE).select(
        *TRIP_KEY, "total_violations", "quarantine_reasons"
    ),
    "dq_clean": lambda w: gate.clean(w.trips, PROFILE),
    "dq_quarantine": lambda w: gate.quarantined(w.trips, PROFILE),
    "dq_audit": lambda w: w.audit,
    "dq_violations_long": lambda w: gate.violations_long(w.audit, PROFILE),
    "dq_strict_rules": Workbench.strict_audit,
    "dim_vendors": lambda w: w.usage(dimensions.vendors, "vendor_id"),
    "dim_rate_codes": lambda w: w.usage(dimensions.rate_codes, "rate_code_id"),
    "dim_payment_types": lambda w: w.usage(dimensions.payment_types, "payment_type_id"),
    "dim_zones": lambda w: w.dim_zones,
    "fct_calendar": lambda w: w.measures.select("pickup_datetime", *_CALENDAR),
    "fct_money": lambda w: w.measures.select(*_MONEY),
    "fct_flags": lambda w: w.fact.select(*_ZONE_FLAGS),
    "fct_full": lambda w: w.fact,
    "fct_preview": lambda w: profiling.preview(w.measures),
    "fct_surrogate_key_check": Workbench.trip_id_check,
    "build_counts": Workbench.build_counts,
    "fk_orphans": Workbench.orphans,
    "m1_speed": lambda w: w.m1,
    "m1_head": lambda w: w.m1.orderBy(*kpis.speed_order()).limit(10),
    "m2_revenue": lambda w: w.m2,
    "m3_flow": lambda w: w.m3,
    "m3_flow_by_band": lambda w: flow.zone_flow(w.dim_zones, w.measures, BAND_FLOW, ["time_window"]),
    "m4_corridors": lambda w: w.m4,
    "m5_vendor_trust": lambda w: w.m5,
    "m6_executive": lambda w: w.m6,
    "m6_transposed": lambda w: profiling.transposed(w.m6),
    "null_cooccurrence": lambda w: profiling.null_cooccurrence(w.trips),
    "null_rows_revenue": lambda w: profiling.null_rows_revenue(w.trips),
    "zero_second_trips": lambda w: profiling.zero_second_trips(w.trips),
    "extreme_outlier": lambda w: profiling.extreme_outlier(w.trips),
    "card_tip_share": lambda w: profiling.card_tip_share(w.measures),
    "cash_zero_tip_share": lambda w: profiling.cash_zero_tip_share(w.trips),
    "kpi_cards": lambda w: report.kpi_cards(w.m6, w.audit),
    "speed_series": lambda w: report.speed_series(w.m1),
    "revenue_series": lambda w: report.revenue_series(w.m2),
    "violation_labels": lambda w: report.violation_labels(
        gate.violations_long(w.audit, PROFILE), PROFILE
    ),
    "top_sources": lambda w: report.top_sources(w.m3),
    "top_sinks": lambda w: report.top_sinks(w.m3),
    "corridor_feed": lambda w: report.corridor_feed(w.m4),
    "vendor_feed": lambda w: report.vendor_feed(w.m5),
    "quarantine_roundtrip": Workbench.quarantine_roundtrip,
    "fact_roundtrip": Workbench.fact_roundtrip,
    "kpi_roundtrip": Workbench.kpi_roundtrip,
    "audit_roundtrip": Workbench.audit_roundtrip,
    "published_cards": lambda w: w.published("kpi_cards"),
    "published_violations": lambda w: w.published("violation_labels"),
    "published_revenue": Workbench.published_revenue,
    "published_revenue_series": lambda w: w.published("revenue_series"),
    "published_flow": lambda w: w.published("top_sources"),
    "published_feeds": lambda w: w.published("vendor_feed"),
    "dq_december": Workbench.december_audit,
    "fk_no_trips": Workbench.no_trips_orphans,
    "rerun_replaces": Workbench.rerun_replaces,
    "trip_folder": Workbench.trip_folder,
    "zone_csv": Workbench.zone_csv,
    "m2_head": lambda w: w.m2.limit(10),
    "m4_head": lambda w: w.m4.limit(2),
    "m5_head": lambda w: w.m5.limit(3),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build):
        return lambda spark, folder: build(Workbench(spark, folder))

    return {name: bound(build) for name, build in _QUERIES.items()}
