"""One period from raw trips to published tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from waybill.operators import dimensions, gate
from waybill.operators.fact import trip_fact, with_trip_id
from waybill.plans import kpis
from waybill.profile import Profile
from waybill.sources import publish, readers, sinks
from waybill.sources.publish import Attempt


@dataclass(frozen=True)
class Published:
    """The folder a run wrote to, its audit row and the files of its KPI tables."""

    folder: str
    label: str
    audit: DataFrame
    kpis: dict[str, str]


def _together(spark: SparkSession, *actions: Callable[[], object]) -> list:
    """Submit independent Spark actions at once, so that the tail of one does not idle
    the cluster. After a failure the jobs of the others are cancelled and it is raised."""
    tag = f"waybill-{os.urandom(4).hex()}"

    def tagged(action: Callable[[], object]) -> object:
        spark.sparkContext.addJobTag(tag)
        return action()

    with ThreadPoolExecutor(len(actions)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(tagged), action) for action in actions]
        done, _ = wait(running, return_when=FIRST_EXCEPTION)
        if any(action.exception() for action in done):
            spark.sparkContext.cancelJobsWithTag(tag)
            raise next(e for e in (action.exception() for action in running if action in done) if e)
        return [action.result() for action in running]


def run_month(
    profile: Profile, trips: DataFrame, zones: DataFrame, out: str, *, one_scan: bool = False
) -> Published:
    """Gate, model and measure one period; then it replaces what was published for it.

    The trips are scanned once, whatever they are: the rows are written with a partition for
    each verdict. The quarantine is tagged from its side alone, the audit counts come from the
    written quarantine and the number of clean rows, and the fact is made of the other side.
    Nothing is published before all of it is written, and scratch tables are removed at the end,
    also of a run that fails.

    By default each KPI table reads the columns it needs of the written fact. With ``one_scan``
    all of them come from one scan by grouping sets, which counts each row four times with the
    totals of all tables: worth it where reading costs more than counting.
    """
    spark, label = trips.sparkSession, profile.period.label
    readers.require_complete_zones(zones, profile)
    trips = readers.conform_trips(trips)
    attempt, scratch = publish.begin(spark, out, label), sinks.scratch_folder(spark)
    try:
        done = _run(profile, trips, zones, attempt, scratch, one_scan)
    finally:
        sinks.discard(spark, scratch)
    return done


def _run(
    profile: Profile, trips: DataFrame, zones: DataFrame, attempt: Attempt, scratch: str, one_scan: bool
) -> Published:
    spark = attempt.spark
    dim_vendors = dimensions.vendors(spark, profile)

    def write_dimensions() -> DataFrame:
        for name, dim in (
            ("dim_vendors", dim_vendors),
            ("dim_rate_codes", dimensions.rate_codes(spark, profile)),
            ("dim_payment_types", dimensions.payment_types(spark, profile)),
        ):
            attempt.table(dim.coalesce(1), name)
        return attempt.table(dimensions.zones(zones, profile).coalesce(1), "dim_zones")

    dim_zones, split = _together(
        spark,
        write_dimensions,
        lambda: sinks.staged(gate.judged(trips, profile), scratch, "judged", by="verdict"),
    )
    clean, held = (
        split.filter(f"verdict = '{side}'").select(*readers.TRIP_COLUMNS) for side in (gate.CLEAN, gate.HELD)
    )

    def write_fact() -> DataFrame:
        return attempt.table(trip_fact(with_trip_id(clean), dim_zones, profile), "fct_trips")

    def write_quarantine_and_rollup() -> DataFrame:
        whole = sinks.packed(held, f"{scratch}/judged/verdict={gate.HELD}")
        tagged = attempt.table(gate.tag(whole, profile), "quarantined_trips")
        return attempt.table(gate.rollup_of(tagged, clean, profile).coalesce(1), "vendor_rollup")

    fact, rollup = _together(spark, write_fact, write_quarantine_and_rollup)
    audit_row = gate.audit(rollup, profile)
    cells = kpis.shared_cells(fact, dim_zones, profile, scratch) if one_scan else {}

    def speed() -> DataFrame:
        if one_scan:
            return kpis.speed_index_of(cells["speed"])
        return kpis.speed_index(fact, dim_zones, f"{scratch}/speed")

    def revenue() -> DataFrame:
        if one_scan:
            return kpis.revenue_productivity_of(cells["revenue"])
        return kpis.revenue_productivity(fact, dim_zones, f"{scratch}/revenue")

    def flow() -> DataFrame:
        if one_scan:
            return kpis.zone_flow_imbalance_of(cells["pairs"], dim_zones, profile)
        return kpis.zone_flow_imbalance(fact, dim_zones, profile)

    def write_corridors_and_executive() -> dict[str, str]:
        part = cells.get("corridor") or sinks.staged(kpis.corridor_cells(fact, profile), scratch, "corridors")
        both = {readers.CORRIDORS: kpis.airport_corridors_of, readers.EXECUTIVE: kpis.executive_summary_of}
        paths = _together(spark, *[lambda name=name, of=of: attempt.kpi(of(part), name) for name, of in both.items()])
        return dict(zip(both, paths))

    tables = {
        readers.REVENUE: revenue,
        readers.SPEED: speed,
        readers.FLOW: flow,
        readers.TRUST: lambda: kpis.vendor_trust(rollup, dim_vendors),
    }
    pair, *single, _ = _together(
        spark,
        write_corridors_and_executive,
        *[lambda name=name, table=table: attempt.kpi(table(), name) for name, table in tables.items()],
        lambda: attempt.report(gate.audit_report(audit_row, profile), readers.AUDIT),
    )
    attempt.commit(audit_row)
    return Published(attempt.folder, attempt.label, audit_row, {**dict(zip(tables, single)), **pair})
