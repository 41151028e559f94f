from __future__ import annotations

import random
from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import trip
from waybill.functions.numeric import UnitTotal
from waybill.operators import dimensions, gate
from waybill.operators.cells import summarise, value_cells
from waybill.operators.fact import (
    FACT_COLUMNS,
    key_usage,
    orphan_keys,
    trip_fact,
    trip_measures,
    with_trip_id,
)
from waybill.operators.flow import BALANCED, DEFICIT, SURPLUS, endpoint_counts, pair_counts, zone_flow
from waybill.plans import kpis, profiling, report
from waybill.profile import FlowLimits
from waybill.sources.readers import source_counts
from waybill.sources.sinks import staged

T0 = datetime(2026, 1, 22, 10)


@pytest.fixture
def star(make_trips, make_zones, january):
    def build(*rows, zones=None):
        trips = make_trips(*rows)
        dim = dimensions.zones(zones or make_zones(), january)
        return trips, dim, trip_fact(trips, dim, january)

    return build


def test_dimensions(spark, make_zones, january):
    dim = dimensions.zones(make_zones(), january)
    rows = {r["location_id"]: r for r in dim.collect()}
    assert set(rows) == set(range(1, 264))
    assert {i for i, r in rows.items() if r["is_airport_zone"]} == {1, 132, 138}
    assert sum(r["is_manhattan_cbd"] for r in rows.values()) == 62
    assert dimensions.vendors(spark, january).count() == 4
    assert dimensions.rate_codes(spark, january).count() == 7
    payments = dimensions.payment_types(spark, january).collect()
    assert [r["payment_type_id"] for r in payments if r["is_electronic_tip_recorded"]] == [1]


def test_dictionary_text_is_literal(spark):
    got = dimensions.dictionary(spark, {1: "it's", 2: "a\\b"}, "k", "v").collect()
    assert [r["v"] for r in got] == ["it's", "a\\b"]


def test_fact_row(star):
    _, _, fact = star(
        trip(RatecodeID=None, passenger_count=None, congestion_surcharge=None, Airport_fee=None,
             cbd_congestion_fee=None, PULocationID=132, DOLocationID=4, trip_distance=2.555),
    )
    assert tuple(fact.columns) == FACT_COLUMNS
    row = fact.first()
    assert row["rate_code_id"] == 99 and row["passenger_count"] is None
    assert row["congestion_surcharge"] == row["airport_fee"] == row["cbd_congestion_fee"] == 0.0
    assert (row["pickup_day_name"], row["pickup_day_of_week"], row["is_weekend"]) == (
        "Thursday", 4, False,
    )
    assert (row["pickup_hour"], row["time_window"]) == (10, "Midday (10-16)")
    assert (row["duration_minutes"], row["effective_speed_mph"]) == (15.0, 10.22)
    assert row["revenue_per_minute"] == 1.3
    # Zones 132 and 4 share a borough in the fixture; 4 lies in the central district.
    assert (row["is_intra_borough"], row["is_airport_trip"], row["is_cbd_involved"]) == (
        True, True, True,
    )


def test_missing_zone_gives_false_not_null(star, make_zones):
    zones = make_zones().filter("LocationID <> 100")
    row = star(trip(PULocationID=100, DOLocationID=200), zones=zones)[2].first()
    assert (row["is_intra_borough"], row["is_cbd_involved"]) == (False, False)
    nowhere = star(trip(PULocationID=None, DOLocationID=None))[2].first()
    assert (nowhere["is_intra_borough"], nowhere["is_airport_trip"], nowhere["is_cbd_involved"]) == (
        False, False, False,
    )


def test_trip_ids_are_dense_across_files(star, tmp_path):
    written = staged(star(*[trip() for _ in range(500)])[2].repartition(7), str(tmp_path), "fact")
    fact = with_trip_id(written)
    assert len(fact.columns) == 31
    assert sorted(r["trip_id"] for r in fact.select("trip_id").collect()) == list(range(1, 501))
    assert profiling.preview(fact).count() == 5


def test_orphans_and_usage(spark, star, january):
    _, dim, fact = star(
        trip(), trip(VendorID=3), trip(VendorID=3), trip(VendorID=4), trip(RatecodeID=None),
        trip(VendorID=None), trip(payment_type=9),
    )
    found = orphan_keys(
        fact,
        {
            "vendor_id": (dimensions.vendors(spark, january), "vendor_id"),
            "rate_code_id": (dimensions.rate_codes(spark, january), "rate_code_id"),
            "payment_type_id": (dimensions.payment_types(spark, january), "payment_type_id"),
            "pickup_location_id": (dim, "location_id"),
        },
    )
    got = {r["foreign_key"]: (r["fact_rows"], r["orphan_rows"], r["orphan_keys"]) for r in found.collect()}
    assert got == {
        "vendor_id": (7, 3, 2), "rate_code_id": (7, 0, 0), "payment_type_id": (7, 1, 1),
        "pickup_location_id": (7, 0, 0),
    }
    usage = key_usage(dimensions.vendors(spark, january), "vendor_id", fact, "vendor_id")
    assert {r["vendor_id"]: r["fact_rows"] for r in usage.collect()} == {1: 3, 2: 0, 6: 0, 7: 0}


@pytest.fixture(scope="module")
def skewed():
    """A third of all trips share zone, hour and speed; the rest is spread out."""
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        if i % 3 == 0:
            rows.append(trip(tip_amount=rng.randint(0, 900) / 100))
            continue
        begin = T0.replace(day=rng.randint(1, 28), hour=rng.randint(0, 23))
        rows.append(
            trip(
                VendorID=rng.choice([1, 2, 3, 6]),
                tpep_pickup_datetime=begin,
                tpep_dropoff_datetime=begin + timedelta(seconds=rng.randint(60, 4000)),
                trip_distance=rng.randint(5, 600) / 100,
                PULocationID=rng.randint(1, 263),
                DOLocationID=rng.randint(1, 263),
                payment_type=rng.choice([0, 1, 2]),
                fare_amount=rng.randint(0, 9000) / 100,
                tip_amount=rng.randint(0, 900) / 100,
                tolls_amount=rng.choice([0.0, 6.94]),
                total_amount=rng.randint(1, 12000) / 100,
                Airport_fee=rng.choice([None, 0.0, 1.75]),
            )
        )
    return rows


def _close(got, want):
    assert got == pytest.approx(want, abs=0.0051)


def test_kpis_against_brute_force(star, skewed, january):
    trips, dim, fact = star(*skewed)
    pdf = fact.toPandas()
    zones = dim.toPandas().set_index("location_id")["borough"]
    pdf["borough"] = pdf["pickup_location_id"].map(zones)
    assert len(pdf) > 2000

    speed = {(r["pickup_borough"], r["time_window"]): r for r in kpis.speed_index(fact, dim).collect()}
    groups = dict(list(pdf.groupby(["borough", "time_window"])))
    assert speed.keys() == groups.keys()
    for key, part in groups.items():
        assert speed[key]["trip_count"] == len(part)
        for name, p in (("p10", 10), ("median", 50), ("p90", 90)):
            _close(speed[key][f"{name}_speed_mph"], np.percentile(part["effective_speed_mph"], p))
        _close(speed[key]["avg_distance_miles"], part["trip_distance_miles"].mean())

    revenue = {
        (r["pickup_borough"], r["is_weekend"], r["time_window"]): r
        for r in kpis.revenue_productivity(fact, dim).collect()
    }
    groups = dict(list(pdf.groupby(["borough", "is_weekend", "time_window"])))
    assert revenue.keys() == groups.keys()
    for key, part in groups.items():
        card = part[(part["payment_type_id"] == 1) & (part["fare_amount"] > 0)]
        got = revenue[key]
        _close(got["total_gross_revenue"], part["total_amount"].sum())
        _close(got["median_revenue_per_active_min"], part["revenue_per_minute"].median())
        _close(got["avg_tip_amount"], part["tip_amount"].mean())
        if len(card):
            want = (card["tip_amount"] / card["fare_amount"] * 100).mean()
            assert got["avg_cc_tip_pct"] == pytest.approx(want, abs=0.051)
        else:
            assert got["avg_cc_tip_pct"] is None

    summary = kpis.executive_summary(fact).first()
    assert summary["clean_trip_volume"] == len(pdf)
    _close(summary["total_passenger_expenditure_usd"], pdf["total_amount"].sum())
    _close(summary["overall_median_speed_mph"], pdf["effective_speed_mph"].median())
    _close(summary["total_airport_access_fees_collected"], pdf["airport_fee"].sum())

    corridors = kpis.airport_corridors(fact, january).collect()
    ends = list(zip(pdf["pickup_location_id"], pdf["dropoff_location_id"]))
    names = {132: "JFK International Airport", 138: "LaGuardia Airport (LGA)", 1: "Newark Airport (EWR)"}
    pdf["corridor"] = [
        next((label for zone, label in names.items() if zone in pair), "Citywide Non-Airport")
        for pair in ends
    ]
    assert {r["airport_corridor"]: r["total_trips"] for r in corridors} == dict(
        pdf["corridor"].value_counts()
    )
    assert sum(r["pct_of_all_trips"] for r in corridors) == pytest.approx(100, abs=0.02)
    counts = [r["total_trips"] for r in corridors]
    assert counts == sorted(counts, reverse=True)

    # Totals agree across tables.
    volume = summary["clean_trip_volume"]
    assert sum(r["trip_count"] for r in speed.values()) == volume
    assert sum(r["trip_count"] for r in revenue.values()) == volume
    assert sum(counts) == volume
    assert sum(r["total_revenue"] for r in corridors) == pytest.approx(
        summary["total_passenger_expenditure_usd"], abs=0.02
    )


def test_kpis_do_not_depend_on_layout(star, skewed):
    _, dim, fact = star(*skewed)
    first = kpis.revenue_productivity(fact, dim).collect()
    assert kpis.revenue_productivity(fact.repartition(13, "tip_amount"), dim).collect() == first


def test_measures_and_fact_give_the_same_kpis(make_trips, make_zones, skewed, january):
    trips, dim = make_trips(*skewed), dimensions.zones(make_zones(), january)
    full, lean = trip_fact(trips, dim, january), trip_measures(trips, january)
    cells = kpis.corridor_cells(full, january)
    assert kpis.executive_summary_of(cells).collect() == kpis.executive_summary(lean).collect()
    assert (
        kpis.airport_corridors_of(cells).collect() == kpis.airport_corridors(lean, january).collect()
    )
    assert kpis.speed_index(full, dim).collect() == kpis.speed_index(lean, dim).collect()


def test_report_order_of_speed_index(star, skewed):
    _, dim, fact = star(*skewed)
    rows = [(r["pickup_borough"], r["time_window"][:7]) for r in kpis.speed_index(fact, dim).collect()]
    boroughs = [b for b, _ in rows]
    assert boroughs == sorted(boroughs)
    assert [w for b, w in rows if b == "Queens"] == ["Morning", "Midday ", "Evening", "Night /"]


def test_null_speed_counts_but_has_no_quantile(star):
    _, dim, fact = star(trip(trip_distance=None), trip(trip_distance=None))
    row = kpis.speed_index(fact, dim).first()
    assert (row["trip_count"], row["median_speed_mph"], row["avg_distance_miles"]) == (2, None, None)


def test_no_trips(star, january):
    _, dim, fact = star(trip(total_amount=-1.0))
    row = kpis.executive_summary(fact).first()
    assert row["clean_trip_volume"] == 0 and row["total_passenger_expenditure_usd"] is None
    assert kpis.speed_index(fact, dim).count() == kpis.airport_corridors(fact, january).count() == 0


def test_corridor_priority(star, january):
    _, _, fact = star(
        trip(PULocationID=138, DOLocationID=132), trip(PULocationID=1, DOLocationID=138),
        trip(PULocationID=1, DOLocationID=2), trip(),
    )
    got = {r["airport_corridor"]: r["total_trips"] for r in kpis.airport_corridors(fact, january).collect()}
    assert got == {
        "JFK International Airport": 1, "LaGuardia Airport (LGA)": 1, "Newark Airport (EWR)": 1,
        "Citywide Non-Airport": 1,
    }


def test_zone_flow(star):
    rows = [trip(PULocationID=10, DOLocationID=20)] * 6 + [trip(PULocationID=20, DOLocationID=30)] * 4
    _, dim, fact = star(*rows)
    flow = zone_flow(dim, fact, FlowLimits(min_volume=0, critical=3)).collect()
    got = [
        (r["location_id"], r["total_pickups"], r["total_dropoffs"], r["net_passenger_flow"],
         r["flow_ratio"], r["operational_status"])
        for r in flow
    ]
    assert got == [
        (10, 6, 0, 6, None, DEFICIT), (30, 0, 4, -4, 0.0, SURPLUS), (20, 4, 6, -2, 0.667, BALANCED),
    ]
    assert zone_flow(dim, fact, FlowLimits(min_volume=9, critical=3)).count() == 1
    sums = endpoint_counts(pair_counts(fact)).selectExpr("sum(pickups) p", "sum(dropoffs) d").first()
    assert sums["p"] == sums["d"] == 10
    banded = zone_flow(dim, fact, FlowLimits(min_volume=0, critical=3), ["time_window"])
    assert banded.count() == 3 and "time_window" in banded.columns


def test_vendor_trust(spark, make_trips, january):
    rollup = gate.vendor_rollup(
        make_trips(
            trip(), trip(trip_distance=0.0), trip(VendorID=3), trip(VendorID=4, fare_amount=-1.0),
            trip(VendorID=None),
        ),
        january,
    )
    rows = kpis.vendor_trust(rollup, dimensions.vendors(spark, january)).collect()
    assert [(r["vendor_name"], r["total_records_received"], r["passed_records"], r["trust_score_pct"])
            for r in rows] == [(None, 3, 2, 66.67), ("Creative Mobile Technologies (CMT)", 2, 1, 50.0)]
    feed = report.vendor_feed(kpis.vendor_trust(rollup, dimensions.vendors(spark, january)))
    assert {r["trust_class"] for r in feed.collect()} == {"at risk"}


def test_report_series(spark, star, january):
    saturday = datetime(2026, 1, 17, 8)
    rows = [
        trip(PULocationID=1), trip(PULocationID=1, total_amount=39.0), trip(PULocationID=2),
        trip(PULocationID=2, tpep_pickup_datetime=saturday,
             tpep_dropoff_datetime=saturday + timedelta(minutes=15)),
    ]
    trips, dim, fact = star(*rows)
    speeds = report.speed_series(kpis.speed_index(fact, dim), ["Queens", "Bronx"]).collect()
    assert {tuple(r) for r in speeds} == {
        ("Queens", 0.0, 10.0, 0.0, 0.0), ("Bronx", 10.0, 10.0, 0.0, 0.0),
    }
    rates = report.revenue_series(kpis.revenue_productivity(fact, dim)).collect()
    # Weekday midday: (1.95 * 2 + 1.30) / 3.
    assert {tuple(r) for r in rates} == {(False, 0.0, 1.73, 0.0, 0.0), (True, 1.3, 0.0, 0.0, 0.0)}

    audit = gate.audit(gate.vendor_rollup(trips, january), january)
    cards = report.kpi_cards(kpis.executive_summary(fact), audit).first()
    assert (cards["clean_trip_volume"], cards["clean_rate_pct"], cards["quarantined_records"]) == (4, 100.0, 0)
    assert cards["revenue_per_hour"] == round(cards["revenue_per_minute"] * 60, 2)
    labels = {r["rule"]: r["label"] for r in report.violation_labels(gate.violations_long(audit, january), january).collect()}
    assert labels["fare_over_1500"] == "Fare >$1,500" and len(labels) == 10

    flow = zone_flow(dim, fact, FlowLimits(min_volume=0, critical=1))
    assert [r["net_passenger_flow"] for r in report.top_sources(flow).collect()] == [2, 2]
    assert [r["net_passenger_flow"] for r in report.top_sinks(flow).collect()] == [-4]
    assert report.corridor_feed(kpis.airport_corridors(fact, january)).count() == 2


def test_profiles(star, january, make_zones):
    missing = dict.fromkeys(profiling.DISPATCH_COLUMNS)
    trips, _, fact = star(
        trip(), trip(payment_type=0, **missing), trip(payment_type=0, total_amount=0.5, **missing),
        trip(tpep_dropoff_datetime=T0, trip_distance=99.0), trip(fare_amount=-5.0, total_amount=-5.5),
        trip(payment_type=2, tip_amount=0.0), trip(payment_type=2, tip_amount=1.0),
        trip(payment_type=2, tip_amount=0.0),
    )
    profile = profiling.raw_profile(trips).first().asDict()
    assert profile == {
        "total_records": 8, "null_passenger_count": 2, "null_ratecode_id": 2,
        "null_congestion_surcharge": 2, "negative_duration": 0, "zero_or_neg_distance": 0,
        "negative_fare": 1, "negative_total": 1,
    }
    long = {r["metric"]: r["value"] for r in profiling.transposed(profiling.raw_profile(trips)).collect()}
    assert long == {k: float(v) for k, v in profile.items()}
    together = profiling.null_cooccurrence(trips).filter("passenger_count_missing").collect()
    assert [(r["payment_type"], r["records"], r["pct_of_records"]) for r in together] == [(0, 2, 25.0)]
    assert tuple(profiling.null_rows_revenue(trips).first()) == (2, 20.0)
    assert tuple(profiling.zero_second_trips(trips).first()) == (1, 1)
    assert profiling.extreme_outlier(trips).first()["trip_distance"] == 99.0
    assert tuple(profiling.cash_zero_tip_share(trips).first()) == (3, 2, 66.67)
    assert tuple(profiling.card_tip_share(fact).first()) == (1, 23.5)
    counts = {r["source"]: r["row_count"] for r in source_counts(trips, make_zones()).collect()}
    assert counts == {"raw_trips": 8, "raw_zones": 265}


def test_changed_thresholds_reach_the_fact(make_trips, make_zones, january):
    from waybill.profile import Thresholds

    strict = replace(january, thresholds=Thresholds(max_total_amount=10.0))
    trips, dim = make_trips(trip(), trip(total_amount=9.0)), dimensions.zones(make_zones(), january)
    assert trip_fact(trips, dim, strict).count() == 1


def test_pandas_source(spark, january):
    frame = pd.DataFrame([trip(), trip(trip_distance=0.0)])
    assert gate.quarantined(spark.createDataFrame(frame).selectExpr(
        *[f"CAST({c} AS TIMESTAMP_NTZ) AS {c}" if c.startswith("tpep") else c for c in frame]
    ), january).count() == 1


def test_quantiles_of_unbounded_values(spark, tmp_path):
    """Values over the whole range of doubles, ties, negatives, NULLs and NaN, as percentile has them."""
    rng = random.Random(11)
    rows = [("wide", rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300)) for _ in range(4000)]
    rows += [("near", 1000 + rng.randint(0, 10**9) / 10**9) for _ in range(4000)]
    rows += [("ties", float(rng.randint(0, 3))) for _ in range(999)] + [("one", 5.0), ("two", 1.0), ("two", 2.0)]
    rows += [("none", None)] * 3 + [("some", None), ("some", 7.0), (None, 1.0), (None, 4.0)]
    rows += [("odd", v) for v in (float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    points = {"low": 0.1, "mid": 0.5, "high": 0.9, "first": 0.0, "last": 1.0}
    total = UnitTotal("sums", "IF(abs(v) < 1e6, v, 0D)")
    written = staged(value_cells(df, ["g"], "v", [total]), str(tmp_path), "cells")
    found = {r["g"]: tuple(r[c] for c in ("n", *points)) for r in summarise(written, ["g"], "v", [total], points).collect()}
    ps = ", ".join(f"{p}D" for p in points.values())
    want = df.groupBy("g").agg(F.expr("count(*) AS n"), F.expr(f"percentile(v, array({ps})) AS ps")).collect()
    assert {k: repr(v) for k, v in found.items()} == {r["g"]: repr((r["n"], *(r["ps"] or [None] * 5))) for r in want}
    total_of = summarise(written, [], "v", [total], points).collect()
    assert len(total_of) == 1 and total_of[0]["n"] == len(rows)
    assert summarise(written.limit(0), ["g"], "v", [total], points).count() == 0


def test_rates_beyond_any_threshold(make_trips, make_zones, january, spark):
    """Revenue rates without a bound: exact medians all the same."""
    loose = replace(january, thresholds=replace(january.thresholds, max_total_amount=1e12))
    rng = random.Random(3)
    amounts = [rng.uniform(1, 10) * 10 ** rng.randint(0, 11) for _ in range(300)]
    dim = dimensions.zones(make_zones(), loose)
    fact = trip_fact(make_trips(*[trip(total_amount=a) for a in amounts]), dim, loose)
    rates = sorted(r["revenue_per_minute"] for r in fact.collect())
    row = kpis.revenue_productivity(fact, dim).first()
    assert row["trip_count"] == 300 and row["median_revenue_per_active_min"] == pytest.approx((rates[149] + rates[150]) / 2, abs=0.0051)


def test_shared_cells_give_the_same_tables(make_trips, make_zones, january, tmp_path):
    rows = [trip(PULocationID=p, DOLocationID=d, trip_distance=float(x), tpep_dropoff_datetime=T0 + timedelta(minutes=5 + x))
            for x, (p, d) in enumerate([(1, 2), (2, 132), (3, 138), (138, 1), (60, 61), (60, 60), (None, 4), (4, None)] * 3, 1)]
    dim = dimensions.zones(make_zones(), january).filter("location_id <> 61")
    fact = trip_fact(make_trips(*rows), dim, january)
    cells = kpis.shared_cells(fact, dim, january, str(tmp_path))
    pairs = [
        (kpis.speed_index_of(cells["speed"]), kpis.speed_index(fact, dim)),
        (kpis.revenue_productivity_of(cells["revenue"]), kpis.revenue_productivity(fact, dim)),
        (kpis.airport_corridors_of(cells["corridor"]), kpis.airport_corridors(fact, january)),
        (kpis.executive_summary_of(cells["corridor"]), kpis.executive_summary(fact)),
        (kpis.zone_flow_imbalance_of(cells["pairs"], dim, january), kpis.zone_flow_imbalance(fact, dim, january)),
    ]
    for shared, alone in pairs:
        assert shared.collect() == alone.collect()
