from __future__ import annotations

import math
import random
from datetime import datetime

import duckdb
import pandas as pd
import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from waybill.functions.labels import lookup_or_key, month_of_file
from waybill.functions.numeric import (
    UnitTotal,
    ieee_ratio,
    percent,
    ratio,
    round_exact,
    round_half,
    text,
)
from waybill.functions.temporal import (
    DAY_NAMES,
    day_name,
    hour_of,
    is_weekend,
    iso_weekday,
    seconds_between,
    time_window,
    window_rank,
)
from waybill.profile import WINDOW_ORDER, Period


def _rounding_values() -> list[float]:
    rng = random.Random(7)
    values = [round(rng.uniform(-100, 100), 2) / 2 for _ in range(1500)]
    values += [rng.uniform(-1e6, 1e6) for _ in range(500)]
    values += [i / 8 for i in range(-80, 81)] + [1.005, 0.285, 2.675, 16.925, 1e17, -1e17, 0.0]
    return values


def test_round_half_is_duckdb_round(spark):
    values = _rounding_values()
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = frame.selectExpr("i", f"{round_half('x', 2)} AS r").orderBy("i").collect()
    pdf = pd.DataFrame({"i": range(len(values)), "x": values})  # noqa: F841
    want = duckdb.sql("SELECT round(x, 2) FROM pdf ORDER BY i").fetchall()
    assert [r["r"] for r in got] == [w[0] for w in want]


def test_round_half_passes_specials(spark):
    row = spark.sql(
        f"SELECT {round_half('a', 2)} a, {round_half('b', 2)} b, {round_half('c', 2)} c"
        " FROM VALUES (CAST(NULL AS DOUBLE), double('inf'), double('nan')) t(a, b, c)"
    ).first()
    assert row["a"] is None and row["b"] == math.inf and math.isnan(row["c"])


@pytest.mark.parametrize("digits", [0, 1, 2])
def test_round_exact_is_python_round(spark, digits):
    values = _rounding_values()
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = frame.selectExpr("i", f"{round_exact('x', digits)} AS r").orderBy("i").collect()
    assert [r["r"] for r in got] == [round(v, digits) for v in values]


def test_divisions(spark):
    row = spark.sql(
        f"SELECT {ratio('1', '0')} a, {ratio('1', '4')} b, {percent('1', '8')} c,"
        f" {ieee_ratio('1D', '0D')} d, {ieee_ratio('-1D', '0D')} e, {ieee_ratio('0D', '0D')} f,"
        f" {ieee_ratio('CAST(NULL AS DOUBLE)', '0D')} g, {ieee_ratio('3D', '2D')} h"
    ).first()
    assert (row["a"], row["b"], row["c"], row["d"], row["e"]) == (
        None, 0.25, 12.5, math.inf, -math.inf,
    )
    assert math.isnan(row["f"]) and row["g"] is None and row["h"] == 1.5


def _totals(frame, total: UnitTotal):
    lanes = frame.groupBy("k").agg(*map(F.expr, total.lanes()))
    merged = lanes.agg(*map(F.expr, total.again()))
    return merged.selectExpr(*total.results()).first()


@pytest.mark.parametrize("digits", [None, 2])
def test_exact_total_ignores_order_and_layout(spark, digits):
    rng = random.Random(3)
    values = [round(rng.uniform(-1500, 1500), 2) for _ in range(5000)]
    want = sum(round(v * 100) for v in values) / 100
    results = set()
    for seed, tasks in ((1, 1), (2, 7), (3, 16)):
        random.Random(seed).shuffle(values)
        frame = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "x double, k int")
        row = _totals(frame.repartition(tasks), UnitTotal("x", "x", digits))
        results.add((row["x_total"], row["x_mean"]))
    assert len(results) == 1
    total, mean = results.pop()
    assert total == pytest.approx(want, abs=1e-9) and mean == pytest.approx(want / 5000, abs=1e-12)


def test_totals_beyond_a_billion_ignore_layout(spark):
    rng = random.Random(5)
    values = [rng.choice((1, -1)) * round(rng.uniform(1e8, 1e13), 2) for _ in range(2000)]
    units = sum(round(v * 1e6) for v in values)
    results = set()
    for tasks in (1, 5, 16):
        frame = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "x double, k int")
        results.add(_totals(frame.repartition(tasks), UnitTotal("x", "x"))["x_total"])
    assert len(results) == 1 and results.pop() == pytest.approx(units / 1e6, rel=1e-12)


@pytest.mark.parametrize("digits", [None, 2])
def test_a_total_that_cannot_be_held_is_an_error(spark, digits):
    frame = spark.createDataFrame([(1e300, 0)], "x double, k int")
    with pytest.raises(ArithmeticException):
        _totals(frame, UnitTotal("x", "x", digits))


@pytest.mark.parametrize("digits", [None, 2])
def test_exact_total_keeps_wild_values(spark, digits):
    total = UnitTotal("x", "x", digits)

    def of(*values):
        row = _totals(spark.createDataFrame([(v, 0) for v in values], "x double, k int"), total)
        return row["x_total"], row["x_mean"]

    assert of(1.5, 1e15) == (1e15 + 1.5, (1e15 + 1.5) / 2)
    assert of(1.5, math.inf)[0] == math.inf
    assert math.isnan(of(1.5, math.nan)[0])
    assert of(None, None) == (None, None)
    assert of(None, 2.0) == (2.0, 2.0)
    assert of(-0.25, -0.5) == (-0.75, -0.375)


def test_seconds_keep_fractions_and_ignore_the_session_zone(spark):
    query = (
        f"SELECT {seconds_between('a', 'b')} s FROM VALUES"
        " (TIMESTAMP_NTZ '2026-03-08 01:30:00.25', TIMESTAMP_NTZ '2026-03-08 03:30:00') t(a, b)"
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert spark.sql(query).first()["s"] == 7199.75
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_calendar(spark):
    rows = spark.sql(
        f"SELECT {day_name('t')} d, {iso_weekday('t')} i, {is_weekend('t')} w, {hour_of('t')} h,"
        f" {time_window('t')} b FROM (SELECT TIMESTAMP_NTZ '2026-01-05 00:30:00'"
        " + id * INTERVAL '1' HOUR AS t FROM range(168)) ORDER BY t"
    ).collect()
    for n, row in enumerate(rows):
        day, hour = divmod(n, 24)
        band = next(
            (i for i, (a, b) in enumerate(((7, 9), (10, 15), (16, 19))) if a <= hour <= b), 3
        )
        assert tuple(row) == (DAY_NAMES[day], day + 1, day >= 5, hour, WINDOW_ORDER[band])


def test_calendar_of_null(spark):
    row = spark.sql(
        f"SELECT {is_weekend('t')} w, {time_window('t')} b, {hour_of('t')} h"
        " FROM (SELECT CAST(NULL AS TIMESTAMP_NTZ) t)"
    ).first()
    assert tuple(row) == (False, "Night / Off-Peak", None)


def test_window_rank(spark):
    ranks = [spark.sql(f"SELECT {window_rank(text(w))} r").first()["r"] for w in WINDOW_ORDER]
    assert ranks == [1, 2, 3, 4]


def test_labels(spark):
    row = spark.sql(
        f"SELECT {lookup_or_key(text('a'), {'a': 'Label'})} x,"
        f" {lookup_or_key(text('zz'), {'a': 'Label'})} y,"
        f" {month_of_file(text('/o/kpi_2026_01.csv/part-0'), 'kpi')} m,"
        f" {month_of_file(text('/o/other.csv'), 'kpi')} n"
    ).first()
    assert tuple(row) == ("Label", "zz", "2026-01", None)


def test_period():
    january, december = Period.month("2026-01"), Period.month("2025-12")
    assert (january.start, january.end) == (datetime(2026, 1, 1), datetime(2026, 2, 1))
    assert (december.start, december.end) == (datetime(2025, 12, 1), datetime(2026, 1, 1))
    assert december.label == "2025_12"
