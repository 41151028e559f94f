from __future__ import annotations

import itertools
from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from tests.conftest import trip
from waybill.operators import gate
from waybill.operators.rules import passing_condition, trip_rules
from waybill.profile import Profile, Thresholds

T0 = datetime(2026, 1, 22, 10)


def lasting(seconds: float, **changes) -> dict:
    return trip(
        tpep_pickup_datetime=T0, tpep_dropoff_datetime=T0 + timedelta(seconds=seconds), **changes
    )


FIXTURE = [
    (lasting(30, trip_distance=0.3), "DURATION_UNDER_1MIN"),
    (lasting(90_000, trip_distance=20.0), "DURATION_OVER_24H"),
    (trip(), ""),
    (
        trip(
            tpep_pickup_datetime=datetime(2026, 2, 3, 8), total_amount=0.0,
            tpep_dropoff_datetime=datetime(2026, 2, 3, 8, 40),
        ),
        "OUT_OF_PERIOD; NON_POSITIVE_FARE",
    ),
    (lasting(900, trip_distance=0.01), "DISTANCE_UNDER_MIN"),
]


def test_dirty_rows_are_routed_with_their_reasons(make_trips, january):
    trips = make_trips(*[row for row, _ in FIXTURE])
    tagged = gate.tag(trips, january).collect()
    assert [r["quarantine_reasons"] for r in tagged] == [reason for _, reason in FIXTURE]
    audit = gate.audit(gate.vendor_rollup(trips, january), january).first()
    assert (audit["total_records"], audit["clean_records"], audit["quarantined_records"]) == (
        5, 1, 4,
    )
    assert (audit["clean_rate_pct"], audit["quarantine_rate_pct"]) == (20.0, 80.0)
    assert gate.clean(trips, january).count() == 1
    assert gate.quarantined(trips, january).count() == 4
    assert len(gate.tag(trips, january).columns) == 34


CASES = [
    (trip(tpep_pickup_datetime=datetime(2026, 1, 1), tpep_dropoff_datetime=datetime(2026, 1, 1, 1)), ""),
    (
        trip(
            tpep_pickup_datetime=datetime(2026, 2, 1), tpep_dropoff_datetime=datetime(2026, 2, 1, 1)
        ),
        "OUT_OF_PERIOD",
    ),
    (
        trip(
            tpep_pickup_datetime=datetime(2026, 1, 31, 23, 59, 59),
            tpep_dropoff_datetime=datetime(2026, 2, 1, 0, 30),
        ),
        "",
    ),
    (lasting(59.5, trip_distance=0.5), "DURATION_UNDER_1MIN"),
    (lasting(60, trip_distance=0.5), ""),
    (lasting(0, trip_distance=0.5), "DURATION_UNDER_1MIN"),
    (lasting(86400), ""),
    (lasting(86401), "DURATION_OVER_24H"),
    (lasting(900, trip_distance=0.05), ""),
    (lasting(900, trip_distance=0.049), "DISTANCE_UNDER_MIN"),
    (lasting(900, trip_distance=-1.0), "DISTANCE_UNDER_MIN"),
    (lasting(80000, trip_distance=150.0), ""),
    (lasting(80000, trip_distance=150.01), "DISTANCE_OVER_150MI"),
    (lasting(3600, trip_distance=85.0), ""),
    (lasting(3600, trip_distance=85.01), "SPEED_OVER_85MPH"),
    (lasting(59, trip_distance=100.0), "DURATION_UNDER_1MIN"),
    (lasting(900, fare_amount=0.0), ""),
    (lasting(900, fare_amount=-0.01), "NON_POSITIVE_FARE"),
    (lasting(900, total_amount=0.0), "NON_POSITIVE_FARE"),
    (lasting(900, total_amount=1500.0), ""),
    (lasting(900, total_amount=1500.01), "FARE_OVER_1500"),
    (lasting(900, PULocationID=0), "UNKNOWN_OR_OUT_OF_BOUNDS_LOCATION"),
    (lasting(900, PULocationID=1, DOLocationID=263), ""),
    (lasting(900, PULocationID=263, DOLocationID=1), ""),
    (lasting(900, DOLocationID=264), "UNKNOWN_OR_OUT_OF_BOUNDS_LOCATION"),
    (lasting(900, DOLocationID=0), "UNKNOWN_OR_OUT_OF_BOUNDS_LOCATION"),
    (lasting(900, fare_amount=None, total_amount=-1.0), "NON_POSITIVE_FARE"),
    (lasting(900, trip_distance=float("nan")), "DISTANCE_OVER_150MI; SPEED_OVER_85MPH"),
    *[
        (trip(**{column: None}), "")
        for column in (
            "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "fare_amount",
            "total_amount", "PULocationID", "DOLocationID",
        )
    ],
]


def test_boundaries(make_trips, january):
    tagged = gate.tag(make_trips(*[row for row, _ in CASES]), january).collect()
    for got, (row, want) in zip(tagged, CASES, strict=True):
        assert got["quarantine_reasons"] == want, row
        assert got["total_violations"] == (len(want.split("; ")) if want else 0)


def test_december_period(make_trips):
    december = Profile.month("2025-12")
    rows = [
        trip(tpep_pickup_datetime=t, tpep_dropoff_datetime=t + timedelta(minutes=10))
        for t in (datetime(2025, 12, 31, 23, 59), datetime(2026, 1, 1), datetime(2025, 11, 30))
    ]
    flags = gate.flag(make_trips(*rows), december).collect()
    assert [r["flag_out_of_period"] for r in flags] == [0, 1, 1]


def test_speed_column(make_trips):
    rows = [lasting(1800, trip_distance=10.0), lasting(0), lasting(-60), trip(trip_distance=None),
            trip(tpep_dropoff_datetime=None)]
    got = [r["effective_speed_mph"] for r in gate.measure(make_trips(*rows)).collect()]
    assert got == [20.0, 0.0, 0.0, None, 0.0]


LOOSE = Thresholds(
    min_duration_seconds=0, max_duration_seconds=1e9, min_distance_miles=-1e9,
    max_distance_miles=1e9, max_implausible_speed_mph=85.0, min_fare_amount=-1e9,
    max_total_amount=1e9, valid_min_location_id=-5, valid_max_location_id=10_000,
)


@pytest.mark.parametrize("thresholds", [Thresholds(), LOOSE, replace(LOOSE, min_duration_seconds=-90)])
def test_filter_and_flags_agree_on_every_combination(make_trips, january, thresholds):
    profile = replace(january, thresholds=thresholds)
    options = {
        "seconds": (None, -60, -120, 0, 30, 900, 90000),
        "trip_distance": (None, -1.0, 0.0, 2.0, 40.0, 500.0),
        "fare_amount": (None, -1.0, 5.0),
        "total_amount": (None, 0.0, 9.0, 2000.0),
        "PULocationID": (None, 1, 264),
    }
    rows = []
    for seconds, *values in itertools.product(*options.values()):
        changes = dict(zip(list(options)[1:], values))
        row = lasting(seconds or 0, **changes)
        rows.append({**row, "tpep_dropoff_datetime": None} if seconds is None else row)
    tagged = gate.tag(make_trips(*rows), profile).selectExpr(
        "total_violations = 0 AS clean", f"{passing_condition(profile)} AS passing"
    )
    assert tagged.filter("passing IS NULL OR clean <> passing").count() == 0
    assert {r["clean"] for r in tagged.distinct().collect()} == {True, False}


def test_split_is_complete(make_trips, january):
    trips = make_trips(*[row for row, _ in CASES])
    clean, held = gate.clean(trips, january), gate.quarantined(trips, january)
    assert clean.count() + held.count() == len(CASES)
    assert clean.filter("quarantine_reasons <> ''").count() == 0
    assert clean.columns == held.columns == gate.tag(trips, january).columns


def test_thresholds_replace_as_a_whole():
    assert Thresholds.from_mapping({}) == Thresholds.from_mapping(None) == Thresholds()
    with pytest.raises(KeyError, match="max_total_amount"):
        Thresholds.from_mapping({"min_duration_seconds": 1})
    full = {name: 1 for name in Thresholds.__dataclass_fields__}
    assert Thresholds.from_mapping(full).max_total_amount == 1


def test_empty_input_has_no_rates(make_trips, january):
    row = gate.audit(gate.vendor_rollup(make_trips(), january), january).first()
    assert (row["total_records"], row["clean_rate_pct"], row["out_of_period"]) == (0, None, 0)


def test_report_and_long_form(make_trips, january):
    trips = make_trips(*[row for row, _ in FIXTURE])
    audit = gate.audit(gate.vendor_rollup(trips, january), january)
    report = gate.audit_report(audit, january).first()
    keys = [r.audit_key for r in trip_rules(january)]
    assert list(report["violations_by_rule"].asDict()) == keys
    assert set(report["fde_assumptions_and_policy"].asDict()) == set(january.policy)
    long = {r["rule"]: r["violation_count"] for r in gate.violations_long(audit, january).collect()}
    assert list(long) == keys and long["duration_under_1min"] == 1


def test_gate_on_a_stream(spark, make_trips, january, tmp_path):
    source, held = str(tmp_path / "in"), str(tmp_path / "held")
    make_trips(*[row for row, _ in CASES]).write.parquet(source)
    batch = spark.read.parquet(source)
    stream = spark.readStream.schema(batch.schema).parquet(source)
    query = (
        gate.quarantined(stream, january)
        .writeStream.format("parquet")
        .option("path", held)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(120)
    want = gate.quarantined(batch, january).select("quarantine_reasons")
    assert spark.read.parquet(held).select("quarantine_reasons").exceptAll(want).isEmpty()
    assert spark.read.parquet(held).count() == want.count()
