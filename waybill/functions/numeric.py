"""SQL expressions for rounding, division and order-free totals.

Expressions are built as text: one string is one call into the JVM, where the same
tree put together from column objects takes dozens.
"""

from __future__ import annotations

from dataclasses import dataclass


def number(x: float) -> str:
    """A double literal."""
    return f"{float(x)!r}D" if abs(x) != float("inf") else f"double('{x}')"


def text(s: str) -> str:
    """A string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def round_half(x: str, digits: int) -> str:
    """Round the binary value half away from zero.

    The built-in ``round`` rounds the printed decimal instead, which moves values
    such as 1.005 the other way. ``x`` appears several times: pass a column.
    """
    scale = number(10**digits)
    scaled = f"({x} * {scale})"
    return (
        f"CASE WHEN abs({scaled} - rint({scaled})) = 0.5D"
        f" THEN {scaled} + signum({x}) * 0.5D ELSE rint({scaled}) END / {scale}"
    )


def round_exact(x: str, digits: int) -> str:
    """Round the exact binary value, true ties to even: the rule for report figures.

    Scaling can land on a tie that the value itself misses by a hair. The part lost in
    the product, recovered by splitting the value in two, then decides. ``x`` appears
    many times: pass a column.
    """
    scale = number(10**digits)
    scaled = f"({x} * {scale})"
    head = f"({x} * 134217729D - ({x} * 134217729D - {x}))"
    lost = f"(({head} * {scale} - {scaled}) + ({x} - {head}) * {scale})"
    return (
        f"CASE WHEN abs({scaled} - rint({scaled})) = 0.5D AND {lost} > 0 THEN {scaled} + 0.5D"
        f" WHEN abs({scaled} - rint({scaled})) = 0.5D AND {lost} < 0 THEN {scaled} - 0.5D"
        f" ELSE rint({scaled}) END / {scale}"
    )


def ratio(numerator: str, denominator: str) -> str:
    """NULL where the denominator is zero."""
    return f"try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE))"


def percent(part: str, whole: str) -> str:
    return f"try_divide({part} * 100D, CAST({whole} AS DOUBLE))"


def ieee_ratio(numerator: str, denominator: str) -> str:
    """Floating-point division without the ANSI error: x/0 is an infinity, 0/0 is NaN."""
    n, d = numerator, denominator
    return (
        f"CASE WHEN {d} <> 0 THEN try_divide({n}, {d}) WHEN {n} IS NULL OR {d} IS NULL THEN NULL"
        f" WHEN {n} > 0 THEN double('inf') WHEN {n} < 0 THEN double('-inf')"
        " ELSE double('nan') END"
    )


_LOW = 1 << 20


@dataclass(frozen=True)
class UnitTotal:
    """A sum of doubles, each rounded to a fixed unit, the same however rows are split.

    A plain double sum changes in its last digits with every task layout, and past
    1e13 it no longer resolves cents. Here a value is counted in whole units:

    * ``digits`` given: the column sits on a decimal grid already, one long lane;
    * otherwise millionths, in a high and a low long lane, so that trillions of
      rows do not overflow.

    One rule holds for all finite values; a value or sum that its lane cannot hold (about
    9e18 without ``digits``, 9e18 units with them) is an error, never a rounded total. NaN
    and infinities alone go to a double lane. The lanes are ordinary sums: they combine
    before the shuffle and can be summed again over any coarser key (``again``).
    """

    name: str
    value: str
    digits: int | None = None

    @property
    def _scale(self) -> str:
        return number(10 ** (6 if self.digits is None else self.digits))

    @property
    def _lanes(self) -> dict[str, str]:
        finite = f"abs({self.value}) < double('inf')"
        units = f"rint(IF({finite}, {self.value}, NULL) * {self._scale})"
        if self.digits is None:
            # Scaling by a power of two is exact, so the two parts add up to the units.
            high = f"rint({units} / {number(_LOW)})"
            fixed = {"high": high, "low": f"{units} - {high} * {number(_LOW)}"}
        else:
            fixed = {"low": units}
        sums = {lane: f"sum(CAST({col} AS BIGINT))" for lane, col in fixed.items()}
        wild = f"sum(IF({finite}, NULL, {self.value}))"
        return {**sums, "wild": wild, "seen": f"count({self.value})"}

    def lanes(self) -> list[str]:
        """Aggregates over rows."""
        return [f"{col} AS {self.name}_{lane}" for lane, col in self._lanes.items()]

    def again(self) -> list[str]:
        """Aggregates over rows that already hold lanes."""
        names = [f"{self.name}_{lane}" for lane in self._lanes]
        return [f"sum({n}) AS {n}" for n in names]

    def results(self) -> list[str]:
        """Lanes to ``<name>_total`` and ``<name>_mean``; NULL where nothing was seen."""
        units = f"CAST({self.name}_low AS DECIMAL(20,0))"
        if self.digits is None:
            high = f"CAST({self.name}_high AS DECIMAL(20,0))"
            units = f"({high} * CAST({_LOW} AS DECIMAL(7,0)) + {units})"
        total = (
            f"(coalesce(CAST({units} AS DOUBLE) / {self._scale}, 0D)"
            f" + coalesce({self.name}_wild, 0D))"
        )
        seen = f"{self.name}_seen"
        return [
            f"IF({seen} > 0, {total}, NULL) AS {self.name}_total",
            f"IF({seen} > 0, try_divide({total}, CAST({seen} AS DOUBLE)), NULL)"
            f" AS {self.name}_mean",
        ]
