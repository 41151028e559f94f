"""The plans are part of the contract: what is pushed down, joined and exchanged."""

from __future__ import annotations

import re
import threading
from datetime import datetime

import pytest

from tests.conftest import trip
from waybill.operators import dimensions, gate
from waybill.operators.cells import value_cells
from waybill.operators.fact import trip_fact, trip_measures, with_trip_id
from waybill.plans import catalog, kpis
from waybill.sources import orders, manifest, readers, sinks

DATA = "/root/testdata/sf0.001"


def explained(df, mode: str = "formatted") -> str:
    jvm = df.sparkSession._jvm
    level = jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    return df._jdf.queryExecution().explainString(level)


@pytest.fixture(scope="module")
def trip_files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("files") / "trips")
    schema = ", ".join(f"{c} {t}" for c, t in readers.TRIP_COLUMNS.items())
    spark.createDataFrame([tuple(trip().values())] * 10, schema).write.parquet(path)
    return manifest.verified_trips(spark, path)


def test_rules_reach_the_scan(trip_files, january):
    plan = explained(gate.passing(trip_files, january))
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    for column in (
        "tpep_pickup_datetime", "trip_distance", "fare_amount", "total_amount", "PULocationID",
        "DOLocationID",
    ):
        assert f"({column}," in pushed, column


def test_columns_are_pruned(trip_files, january):
    rollup = explained(gate.vendor_rollup(trip_files, january))
    read = re.search(r"ReadSchema: struct<(.*)>", rollup).group(1)
    assert read.count(":") == 8 and "tip_amount" not in read
    summary = explained(value_cells(trip_measures(trip_files, january), [], kpis.SPEED, kpis.EXECUTIVE))
    assert "extra" not in re.search(r"ReadSchema: struct<(.*)>", summary).group(1)


def test_fact_is_narrow(spark, trip_files, make_zones, january, tmp_path):
    path = str(tmp_path / "zones")
    make_zones().write.parquet(path)
    dim = dimensions.zones(spark.read.parquet(path), january)
    plan = explained(trip_fact(trip_files, dim, january))
    assert plan.count("BroadcastHashJoin LeftOuter") >= 2
    assert not re.search(r"^\(\d+\) Exchange$", plan, re.M)


def test_dimensions_join_without_hint_or_shuffle(spark, trip_files, january):
    plan = explained(kpis.vendor_trust(
        gate.vendor_rollup(trip_files, january), dimensions.vendors(spark, january)))
    assert "BroadcastHashJoin LeftOuter" in plan


def test_quantiles_keep_no_values(spark, trip_files, make_zones, january, tmp_path):
    """Rows become cells by a hash aggregate; no aggregate collects what grows with the values,
    and only buckets and the cells of a few of them are ordered."""
    cells = value_cells(trip_measures(trip_files, january), [], kpis.SPEED, kpis.EXECUTIVE)
    assert "ObjectHashAggregate" not in explained(cells)
    plan = explained(kpis.executive_summary(trip_measures(trip_files, january)))
    for word in ("ObjectHashAggregate", "percentile", "collect_", "NestedLoop"):
        assert word not in plan


def test_one_scan_of_the_fact_feeds_every_table(spark, trip_files, make_zones, january, tmp_path, monkeypatch):
    path = str(tmp_path / "zones")
    make_zones().write.parquet(path)
    dim = dimensions.zones(spark.read.parquet(path), january)
    fact = trip_fact(trip_files, dim, january)
    seen = []
    grouped = type(fact).groupingSets
    monkeypatch.setattr(type(fact), "groupingSets", lambda self, *a: seen.append(self) or grouped(self, *a))
    parts = kpis.shared_cells(fact, dim, january, str(tmp_path / "scratch"))
    assert set(parts) == {"speed", "revenue", "corridor", "pairs"} and len(seen) == 1
    files = {f for part in parts.values() for f in part.inputFiles()}
    assert all("/scratch/cells/" in f for f in files)
    for table in (kpis.speed_index_of(parts["speed"]), kpis.executive_summary_of(parts["corridor"])):
        assert "/scratch/cells" in explained(table) and "files" not in re.findall(r"Location: .*", explained(table))


def test_dense_ids_need_no_single_task(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).selectExpr("id * 7 % 1000 AS x").repartition(5).write.parquet(path)
    spark.range(0).selectExpr("id AS x").write.mode("append").parquet(path)
    rows = with_trip_id(spark.read.parquet(path))
    plan = explained(rows)
    assert "Window" not in plan and "SinglePartition" not in plan and "LocalTableScan" in plan
    found = [(r["trip_id"], r["x"]) for r in rows.collect()]
    assert sorted(i for i, _ in found) == list(range(1, 1001)) and {x for _, x in found} == set(range(1000))
    assert sorted(found) == sorted((r["trip_id"], r["x"]) for r in with_trip_id(spark.read.parquet(path)).collect())


@pytest.mark.parametrize(
    "name", [n for n in catalog.queries() if n not in ("latest_month", "file_manifest",
                                                        "manifest_summary", "file_hashes")
             and not n.endswith("roundtrip") and not n.startswith("published")]
)
def test_every_query_plan(spark, name):
    """No nested-loop or cross join, no Python, and code small enough for the JIT."""
    df = catalog.queries()[name](spark, DATA)
    plan = explained(df)
    for word in ("CartesianProduct", "NestedLoop", "Python", "MapInPandas", "localCheckpoint"):
        assert word not in plan
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        code = explained(catalog.queries()[name](spark, DATA), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert max(sizes, default=0) < 8000


def test_line_items_meet_orders_by_merge(spark):
    plan = explained(orders.trips(spark, DATA))
    assert "SortMergeJoin Inner" in plan


def test_attempts_are_written_at_once_and_count_in_turn(spark, make_trips, monkeypatch):
    passes = trip(
        tpep_pickup_datetime=datetime(1997, 1, 1, 10), tpep_dropoff_datetime=datetime(1997, 1, 1, 10, 15),
        PULocationID=3, DOLocationID=4,
    )
    work, all_begun, real = catalog.Workbench(spark, ""), threading.Barrier(8), sinks.staged
    work.trips = make_trips(passes, passes, trip())

    def meeting(df, folder, name, **options):
        if "/runs/" in folder:
            all_begun.wait(60)
        return real(df, folder, name, **options)

    monkeypatch.setattr(sinks, "staged", meeting)
    found = sorted(map(tuple, work.rerun_replaces().collect()))
    assert found == [("kept", "clean", 2), ("kept", "quarantine", 1), ("rerun", "clean", 0), ("rerun", "quarantine", 3)]


@pytest.mark.parametrize("hot", ["l_orderkey", "l_suppkey"])
def test_hot_key_is_split(spark, tmp_path, hot):
    """A third of all line items on one order or supplier, tables past any broadcast:
    adaptive execution splits the hot key and nothing is lost."""
    for name, schema in orders.TABLES.items():
        frame = spark.read.schema(schema).parquet(f"{DATA}/{name}.parquet")
        if name == "lineitem":
            frame = frame.crossJoin(spark.range(40)).selectExpr(
                f"IF(id % 3 = 0, 7L, {hot}) AS {hot}",
                *[c for c in frame.columns if c != hot],
            ).repartition(8)
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    saved = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        trips = orders.trips(spark, str(tmp_path))
        counted = trips.groupBy("VendorID").count()
        total = sum(r["count"] for r in counted.collect())
        assert total == 6000 * 40
        final = explained(counted, "simple").split("Initial Plan")[0]
        assert "skew=true" in final, final
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize(
    "name", ["m1_speed", "m2_revenue", "m3_flow_by_band", "m5_vendor_trust", "fct_flags", "fk_orphans"]
)
def test_results_without_any_broadcast(spark, name):
    """Tables past the broadcast threshold take merge joins and give the same rows."""
    query = catalog.queries()[name]
    want = sorted(map(repr, query(spark, DATA).collect()))
    key = "spark.sql.autoBroadcastJoinThreshold"
    saved = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        df = query(spark, DATA)
        assert "BroadcastHashJoin" not in explained(df)
        assert sorted(map(repr, df.collect())) == want
    finally:
        spark.conf.set(key, saved)
