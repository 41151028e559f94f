"""The quality rules as SQL conditions.

``trip_rules`` gives each rule as a 0/1 flag in which a NULL operand never violates.
``passing_condition`` says the same of a whole row in the cheapest form to filter by:
ranges over stored columns, NULL spelled out, which a Parquet scan uses to skip row
groups, and as few mentions of the computed duration as possible, because a
pushed-down filter evaluates every mention.
"""

from __future__ import annotations

from dataclasses import dataclass

from waybill.functions.numeric import ieee_ratio, number, ratio
from waybill.functions.temporal import instant, seconds_between
from waybill.profile import Profile

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"
TRIP_SECONDS = seconds_between(PICKUP, DROPOFF)


@dataclass(frozen=True)
class Rule:
    flag: str
    tag: str
    audit_key: str
    label: str
    broken_if: str

    @property
    def violated(self) -> str:
        return f"IF({self.broken_if}, 1, 0)"


def _speed(profile: Profile, seconds: str) -> str:
    # With a positive shortest duration no counted row divides by zero.
    divide = ratio if profile.thresholds.min_duration_seconds > 0 else ieee_ratio
    return divide("trip_distance", f"({seconds} / 3600D)")


def trip_rules(profile: Profile, seconds: str = TRIP_SECONDS) -> list[Rule]:
    """The ten rules in tag order.

    ``seconds`` is the duration column where the frame has one already.
    """
    t, period = profile.thresholds, profile.period
    shortest, longest = number(t.min_duration_seconds), number(t.max_duration_seconds)
    first, last = t.valid_min_location_id, t.valid_max_location_id
    # Flag, tag, audit key and report label of each rule.
    return [
        Rule("flag_out_of_period", "OUT_OF_PERIOD", "out_of_period", "Out of Period",
             f"{PICKUP} < {instant(period.start)} OR {PICKUP} >= {instant(period.end)}"),
        Rule("flag_negative_duration", "NEGATIVE_DURATION", "negative_duration", "Negative Dur",
             f"{DROPOFF} < {PICKUP}"),
        Rule("flag_duration_too_short", "DURATION_UNDER_1MIN", "duration_under_1min",
             "<1-Min Duration", f"{seconds} < {shortest}"),
        Rule("flag_duration_too_long", "DURATION_OVER_24H", "duration_over_24h",
             "Duration >24h", f"{seconds} > {longest}"),
        Rule("flag_zero_or_neg_distance", "DISTANCE_UNDER_MIN", "distance_under_0_05mi",
             "Zero/Neg Dist", f"trip_distance < {number(t.min_distance_miles)}"),
        Rule("flag_excessive_distance", "DISTANCE_OVER_150MI", "distance_over_150mi",
             "Dist >150mi", f"trip_distance > {number(t.max_distance_miles)}"),
        Rule("flag_implausible_speed", "SPEED_OVER_85MPH", "speed_over_85mph", "Speed >85mph",
             f"IF({seconds} >= {shortest}, {_speed(profile, seconds)}, NULL)"
             f" > {number(t.max_implausible_speed_mph)}"),
        Rule("flag_negative_or_zero_fare", "NON_POSITIVE_FARE", "non_positive_fare_or_total",
             "Refund/Zero Fare",
             f"fare_amount < {number(t.min_fare_amount)} OR total_amount <= 0D"),
        Rule("flag_excessive_fare", "FARE_OVER_1500", "fare_over_1500", "Fare >$1,500",
             f"total_amount > {number(t.max_total_amount)}"),
        Rule("flag_unknown_location", "UNKNOWN_OR_OUT_OF_BOUNDS_LOCATION",
             "unknown_or_unmapped_zone", "Unknown Zone",
             f"PULocationID < {first} OR PULocationID > {last}"
             f" OR DOLocationID < {first} OR DOLocationID > {last}"),
    ]


def _known(operand: str, *limits: str) -> str:
    """Within the limits, or NULL."""
    return f"({' AND '.join(f'{operand} {limit}' for limit in limits)} OR {operand} IS NULL)"


def passing_condition(profile: Profile) -> str:
    """True for the rows that break no rule, false for all others, never NULL."""
    t, period = profile.thresholds, profile.period
    zone_limits = (f">= {t.valid_min_location_id}", f"<= {t.valid_max_location_id}")
    stored = [
        _known(PICKUP, f">= {instant(period.start)}", f"< {instant(period.end)}"),
        _known("trip_distance", f">= {number(t.min_distance_miles)}",
               f"<= {number(t.max_distance_miles)}"),
        _known("fare_amount", f">= {number(t.min_fare_amount)}"),
        _known("total_amount", "> 0D", f"<= {number(t.max_total_amount)}"),
        _known("PULocationID", *zone_limits),
        _known("DOLocationID", *zone_limits),
    ]
    # A duration that reaches a non-negative minimum is not negative either.
    shortest = max(t.min_duration_seconds, 0)
    duration = (
        f"coalesce({TRIP_SECONDS} >= {number(shortest)}"
        f" AND {TRIP_SECONDS} <= {number(t.max_duration_seconds)}, TRUE)"
    )
    # Rows too short for a speed have failed on duration already.
    speed = (
        f"coalesce({_speed(profile, TRIP_SECONDS)}"
        f" <= {number(t.max_implausible_speed_mph)}, TRUE)"
    )
    return " AND ".join([*stored, duration, speed])
