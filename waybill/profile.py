"""Everything about a run that is data rather than code.

A ``Profile`` names the period, the rule thresholds, the dictionaries, the zone
sets and the report limits. The operators only read it, so one code path serves
any trip-shaped source.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from datetime import datetime


@dataclass(frozen=True)
class Period:
    """Half-open pickup interval ``[start, end)``; ``label`` names its outputs."""

    start: datetime
    end: datetime
    label: str

    @classmethod
    def month(cls, year_month: str) -> Period:
        start = datetime.strptime(year_month, "%Y-%m")
        turn = start.month // 12
        end = start.replace(year=start.year + turn, month=start.month % 12 + 1)
        return cls(start, end, start.strftime("%Y_%m"))


# Names and limits of the quality rules.
@dataclass(frozen=True)
class Thresholds:
    min_duration_seconds: float = 60
    max_duration_seconds: float = 86400
    min_distance_miles: float = 0.05
    max_distance_miles: float = 150.0
    max_implausible_speed_mph: float = 85.0
    min_fare_amount: float = 0.0
    max_total_amount: float = 1500.0
    valid_min_location_id: int = 1
    valid_max_location_id: int = 263

    @classmethod
    def from_mapping(cls, overrides: Mapping[str, float] | None) -> Thresholds:
        """A full replacement set; ``None`` or empty keeps the defaults."""
        if not overrides:
            return cls()
        names = [f.name for f in fields(cls)]
        missing = [n for n in names if n not in overrides]
        if missing:
            raise KeyError(f"thresholds missing: {', '.join(missing)}")
        return cls(**{n: overrides[n] for n in names})


# Zone-flow report limits.
@dataclass(frozen=True)
class FlowLimits:
    min_volume: int = 1000
    critical: int = 5000


# Dictionaries and zone sets of the trip feed.
VENDORS = {
    1: "Creative Mobile Technologies (CMT)",
    2: "VeriFone Inc. (VTS)",
    6: "Pilot Provider Alpha",
    7: "Pilot Provider Beta",
}
RATE_CODES = {
    1: "Standard Rate",
    2: "JFK Airport Flat Rate",
    3: "Newark Airport",
    4: "Nassau / Westchester",
    5: "Negotiated Fare",
    6: "Group Ride",
    99: "Special / Out of Area Rate",
}
PAYMENT_TYPES = {
    0: "Unspecified / Void",
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided Trip",
}
CBD_ZONE_IDS = (
    4, 12, 13, 24, 41, 42, 43, 45, 48, 50, 68, 79, 87, 88, 90, 100, 107, 113, 114,
    116, 120, 125, 127, 128, 137, 140, 141, 142, 143, 144, 148, 151, 152, 153, 158,
    161, 162, 163, 164, 166, 170, 186, 209, 211, 224, 229, 230, 231, 232, 233, 234,
    236, 237, 238, 239, 243, 244, 246, 249, 261, 262, 263,
)
# Airport zones in the order a trip touching several of them is classed.
CORRIDORS = (
    (132, "JFK International Airport"),
    (138, "LaGuardia Airport (LGA)"),
    (1, "Newark Airport (EWR)"),
)
OTHER_CORRIDOR = "Citywide Non-Airport"
# First and last pickup hour of each band, in report order; other hours are off-peak.
TIME_WINDOWS = (
    ("Morning Rush (07-10)", 7, 9),
    ("Midday (10-16)", 10, 15),
    ("Evening Rush (16-20)", 16, 19),
)
OFF_PEAK = "Night / Off-Peak"
UNASSIGNED_RATE_CODE = 99
CARD_PAYMENT = 1
CASH_PAYMENT = 2
TRUSTED_ABOVE_PCT = 90.0

# Policy notes of the published audit reports. They speak of one feed and the
# default thresholds; a profile of another feed brings its own.
POLICY = {
    "passenger_count_nulls": "Preserved in clean dataset for operational and revenue KPIs; excluded only for per-passenger metrics. Dropping 29.2% of nulls would severely bias trip volume.",
    "ratecode_id_nulls": "Mapped to 'Unassigned / Digital Dispatch' rather than dropping.",
    "quarantine_policy": "Records failing physical travel laws (speed > 85mph, negative fares, duration < 1m) are segregated to quarantine parquet with diagnostic tags for vendor SLA reviews.",
}

WINDOW_ORDER = tuple(label for label, _, _ in TIME_WINDOWS) + (OFF_PEAK,)


@dataclass(frozen=True)
class Profile:
    period: Period
    thresholds: Thresholds = field(default_factory=Thresholds)
    zone_id_range: tuple[int, int] = (1, 263)
    min_zone_rows: int = 260
    vendors: Mapping[int, str] = field(default_factory=lambda: dict(VENDORS))
    rate_codes: Mapping[int, str] = field(default_factory=lambda: dict(RATE_CODES))
    payment_types: Mapping[int, str] = field(default_factory=lambda: dict(PAYMENT_TYPES))
    cbd_zone_ids: tuple[int, ...] = CBD_ZONE_IDS
    corridors: tuple[tuple[int, str], ...] = CORRIDORS
    other_corridor: str = OTHER_CORRIDOR
    flow: FlowLimits = field(default_factory=FlowLimits)
    policy: Mapping[str, str] = field(default_factory=lambda: dict(POLICY))

    @classmethod
    def month(cls, year_month: str, **changes) -> Profile:
        return cls(Period.month(year_month), **changes)

    @property
    def airport_zone_ids(self) -> list[int]:
        return [zone for zone, _ in self.corridors]
