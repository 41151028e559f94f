"""Quality gate: measure, flag, tag, route and audit.

All of it is narrow (no shuffle) except the audit, whose only exchange carries one
partial row per task and vendor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.numeric import ratio, round_exact, text
from waybill.operators.rules import TRIP_SECONDS, passing_condition, trip_rules
from waybill.profile import Profile

_SPEED = (
    "IF(duration_seconds > 0, try_divide(trip_distance, duration_seconds / 3600D), 0D)"
    " AS effective_speed_mph"
)


def _rules(profile: Profile):
    return trip_rules(profile, "duration_seconds")


def _violations(profile: Profile) -> str:
    return f"({' + '.join(r.flag for r in _rules(profile))})"


def measure(trips: DataFrame) -> DataFrame:
    """Add duration and effective speed (0 where no time passed)."""
    timed = trips.selectExpr("*", f"{TRIP_SECONDS} AS duration_seconds")
    return timed.selectExpr("*", _SPEED)


def flag(trips: DataFrame, profile: Profile) -> DataFrame:
    """``measure`` plus one 0/1 column per rule."""
    timed = trips.selectExpr("*", f"{TRIP_SECONDS} AS duration_seconds")
    return timed.selectExpr(
        "*", _SPEED, *[f"{r.violated} AS {r.flag}" for r in _rules(profile)]
    )


def tag(trips: DataFrame, profile: Profile) -> DataFrame:
    """``flag`` plus the violation count and the '; '-joined tags in rule order."""
    tags = ", ".join(f"IF({r.flag} = 1, {text(r.tag)}, NULL)" for r in _rules(profile))
    return flag(trips, profile).selectExpr(
        "*",
        f"{_violations(profile)} AS total_violations",
        f"concat_ws('; ', {tags}) AS quarantine_reasons",
    )


def passing(trips: DataFrame, profile: Profile) -> DataFrame:
    """Raw rows that break no rule; the range conditions reach the file scan."""
    return trips.filter(passing_condition(profile))


def clean(trips: DataFrame, profile: Profile) -> DataFrame:
    """Tagged rows without violations."""
    return tag(passing(trips, profile), profile)


def quarantined(trips: DataFrame, profile: Profile) -> DataFrame:
    """Tagged rows with at least one violation."""
    return tag(trips.filter(f"NOT ({passing_condition(profile)})"), profile)


CLEAN, HELD = "clean", "quarantined"


def judged(trips: DataFrame, profile: Profile) -> DataFrame:
    """Raw rows with their ``verdict``, clean or quarantined: both sides of the split at once."""
    return trips.selectExpr("*", f"IF({passing_condition(profile)}, '{CLEAN}', '{HELD}') AS verdict")


def vendor_rollup(trips: DataFrame, profile: Profile) -> DataFrame:
    """Counts per vendor id over all rows: the base of the audit and of vendor trust.

    A plain aggregate rather than an observed metric, because observed counters can
    repeat when a lost stage runs again.
    """
    flags = [r.flag for r in _rules(profile)]
    counted = flag(trips, profile).selectExpr(
        "VendorID", *flags, f"{_violations(profile)} = 0 AS is_clean"
    )
    counts = [
        "count(*) AS records",
        "count_if(is_clean) AS clean",
        "count_if(NOT is_clean) AS quarantined",
        *[f"sum({f}) AS {f}" for f in flags],
    ]
    return counted.groupBy("VendorID").agg(*map(F.expr, counts))


def rollup_of(held: DataFrame, clean: DataFrame, profile: Profile) -> DataFrame:
    """The same from both written sides: flags of the quarantined rows, which are tagged, and
    no more than the number of the clean ones, which have none."""
    flags = [r.flag for r in _rules(profile)]
    n = F.expr("count(*) AS records")
    broken = held.groupBy("VendorID").agg(n, *[F.expr(f"sum({f}) AS {f}") for f in flags])
    whole = clean.groupBy("VendorID").agg(n)
    sides = broken.selectExpr("VendorID", "records", "0L AS clean", "records AS quarantined", *flags).unionByName(
        whole.selectExpr("VendorID", "records", "records AS clean", "0L AS quarantined", *[f"0L AS {f}" for f in flags])
    )
    sums = ("records", "clean", "quarantined", *flags)
    return sides.groupBy("VendorID").agg(*[F.expr(f"sum({c}) AS {c}") for c in sums])


def audit(rollup: DataFrame, profile: Profile) -> DataFrame:
    """One wide row: totals, rates and a count per rule. Rates of no rows are NULL."""
    keys = {r.flag: r.audit_key for r in _rules(profile)}
    sums = {
        "records": "total_records",
        "clean": "clean_records",
        "quarantined": "quarantined_records",
        **keys,
    }
    totals = rollup.agg(*[F.expr(f"coalesce(sum({c}), 0L) AS {name}") for c, name in sums.items()])
    shares = totals.selectExpr(
        "*",
        f"{ratio('clean_records', 'total_records')} * 100D AS clean_share",
        f"{ratio('quarantined_records', 'total_records')} * 100D AS quarantine_share",
    )
    return shares.selectExpr(
        "total_records",
        "clean_records",
        f"{round_exact('clean_share', 2)} AS clean_rate_pct",
        "quarantined_records",
        f"{round_exact('quarantine_share', 2)} AS quarantine_rate_pct",
        *keys.values(),
    )


def audit_report(audit_row: DataFrame, profile: Profile) -> DataFrame:
    """The audit row in its nested, published form, with the profile's policy notes."""
    keys = ", ".join(r.audit_key for r in _rules(profile))
    notes = ", ".join(f"{text(v)} AS {k}" for k, v in profile.policy.items())
    return audit_row.selectExpr(
        "total_records",
        "clean_records",
        "clean_rate_pct",
        "quarantined_records",
        "quarantine_rate_pct",
        f"struct({keys}) AS violations_by_rule",
        f"struct({notes}) AS fde_assumptions_and_policy",
    )


def violations_long(audit_row: DataFrame, profile: Profile) -> DataFrame:
    """(rule, violation_count), one row per rule."""
    pairs = ", ".join(f"{text(r.audit_key)}, {r.audit_key}" for r in _rules(profile))
    return audit_row.selectExpr(
        f"stack({len(_rules(profile))}, {pairs}) AS (rule, violation_count)"
    )
