"""Exact quantiles and totals by way of value cells and a histogram.

Rows are first counted per (group, value): that aggregate combines inside each task and
spreads over all reducers, however large the group. A quantile is then selected rather than
collected. A histogram over order-preserving buckets, whose number does not depend on the
data, says by running sums which bucket holds the wanted rank; only the cells of that bucket
are put in order and counted up to it. So no task holds a group's distinct values, however
many there are: the only state is a running sum over rows sorted on disk. Totals ride along
as exact lanes, which makes a rerun reproduce every digit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.numeric import UnitTotal, number

CELL_ROWS = "cell_rows"
#: Buckets for each factor of e: at most 1.4 million over all doubles.
BUCKETS = 1024


def value_cells(
    rows: DataFrame, keys: Sequence[str], value: str, totals: Sequence[UnitTotal]
) -> DataFrame:
    """One row per (keys, value): row count and the lanes of every total."""
    lanes = [f"count(*) AS {CELL_ROWS}", *[lane for t in totals for lane in t.lanes()]]
    return rows.groupBy(*keys, value).agg(*map(F.expr, lanes))


def bucket(value: str) -> str:
    """A whole number that never falls as the value grows; NaN is largest, as in a sort.

    The logarithm is semi-monotonic by its contract, and so are all other steps.
    """
    scaled = f"floor(ln(1D + least(abs({value}), 1e300D)) * {BUCKETS}D)"
    return f"IF(isnan({value}), {1 << 40}L, CAST(signum({value}) * {scaled} AS BIGINT))"


def _over(keys: Sequence[str], order: str = "") -> str:
    by = f"PARTITION BY {', '.join(keys)}" if keys else ""
    frame = f" ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW" if order else ""
    return f"OVER ({by}{frame})"


def summarise(
    cells: DataFrame,
    keys: Sequence[str],
    value: str,
    totals: Sequence[UnitTotal],
    quantiles: Mapping[str, float],
) -> DataFrame:
    """Per ``keys`` (a subset of the cell keys): ``n``, each total's ``_total`` and
    ``_mean``, and the named quantiles, interpolated; NULL values have no rank.

    ``cells`` is read twice, so it should be a written table. The buckets that hold a wanted
    rank, two for each quantile of a row of the result at most, meet their cells in a join that
    adaptive execution broadcasts by its measured size.
    """
    lanes = [a.rsplit(" AS ", 1)[1] for t in totals for a in t.again()]
    places = {name: f"({number(p)} * (known - 1))" for name, p in quantiles.items()}
    ends = {f"{name}_{end}": f"CAST({end}({at}) AS BIGINT)" for name, at in places.items() for end in ("floor", "ceil")}
    wanted = " OR ".join(f"({at} >= before AND {at} < before + ranked)" for at in ends.values())
    steps = {
        "placed": [f"SELECT *, {bucket(value)} AS bucket, IF({value} IS NULL, 0L, {CELL_ROWS}) AS ranked FROM {{cells}}"],
        "histogram": [
            "SELECT",
            [*keys, "bucket", f"sum({CELL_ROWS}) AS n", "sum(ranked) AS ranked", *[a for t in totals for a in t.again()]],
            "FROM placed GROUP BY",
            [*keys, "bucket"],
        ],
        "every": [
            "SELECT",
            [*keys, "bucket", "ranked", f"sum(ranked) {_over(keys, 'bucket')} - ranked AS before"],
            f", sum(ranked) {_over(keys)} AS known,",
            [f"sum({c}) {_over(keys)} AS {c}" for c in ("n", *lanes)],
            "FROM histogram",
        ],
        "held": [f"SELECT * FROM every WHERE CASE WHEN known = 0 THEN bucket IS NULL ELSE {wanted} END"],
        "refined": [
            "SELECT held.*,",
            [f"placed.{value} AS cell_value", "placed.ranked AS cell_ranked"],
            f", before + sum(placed.ranked) {_over([f'held.{k}' for k in (*keys, 'bucket')], f'placed.{value}')} AS upto",
            "FROM placed JOIN held ON " + " AND ".join(f"placed.{k} <=> held.{k}" for k in (*keys, "bucket")),
        ],
        "found": [
            "SELECT",
            [*keys, *[f"max({c}) AS {c}" for c in ("known", "n", *lanes)]],
            ",",
            [
                f"max(IF({at} >= upto - cell_ranked AND {at} < upto, cell_value, NULL)) AS {name}"
                for name, at in ends.items()
            ],
            "FROM refined",
            *(["GROUP BY", list(keys)] if keys else []),
        ],
    }
    points = [
        f"IF({name}_floor = {name}_ceil OR floor({at}) = ceil({at}), {name}_floor,"
        f" (ceil({at}) - {at}) * {name}_floor + ({at} - floor({at})) * {name}_ceil) AS {name}"
        for name, at in places.items()
    ]
    results = [*keys, "n", *points, *[column for t in totals for column in t.results()]]

    def spelt(parts: list) -> str:
        return " ".join(part if isinstance(part, str) else ", ".join(part) for part in parts)

    with_ = ", ".join(f"{name} AS ({spelt(parts)})" for name, parts in steps.items())
    return cells.sparkSession.sql(f"WITH {with_} SELECT {', '.join(results)} FROM found", cells=cells)
