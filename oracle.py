"""The catalog's queries as DuckDB SQL over the order tables."""

from __future__ import annotations

# Restated here, so that a wrong entry in the package shows.
# Dictionaries of the trip feed.
_VENDORS = {
    1: "Creative Mobile Technologies (CMT)",
    2: "VeriFone Inc. (VTS)",
    6: "Pilot Provider Alpha",
    7: "Pilot Provider Beta",
}
_RATE_CODES = {
    1: "Standard Rate",
    2: "JFK Airport Flat Rate",
    3: "Newark Airport",
    4: "Nassau / Westchester",
    5: "Negotiated Fare",
    6: "Group Ride",
    99: "Special / Out of Area Rate",
}
_PAYMENT_TYPES = {
    0: "Unspecified / Void",
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided Trip",
}
_POLICY = {
    "passenger_count_nulls": "Kept; left out of per-passenger figures only.",
    "ratecode_id_nulls": "Mapped to rate code 99.",
    "quarantine_policy": "Trips that break a rule are set apart with their reasons.",
}

_FLAGS = {
    "flag_out_of_period": (
        "tpep_pickup_datetime < TIMESTAMP '{start}' OR tpep_pickup_datetime >= TIMESTAMP '{end}'"
    ),
    "flag_negative_duration": "tpep_dropoff_datetime < tpep_pickup_datetime",
    "flag_duration_too_short": "duration_seconds < {min_s}",
    "flag_duration_too_long": "duration_seconds > {max_s}",
    "flag_zero_or_neg_distance": "trip_distance < {min_mi}",
    "flag_excessive_distance": "trip_distance > {max_mi}",
    "flag_implausible_speed": (
        "duration_seconds >= {min_s} AND trip_distance / (duration_seconds / 3600.0) > {max_mph}"
    ),
    "flag_negative_or_zero_fare": "fare_amount < {min_fare} OR total_amount <= 0",
    "flag_excessive_fare": "total_amount > {max_total}",
    "flag_unknown_location": (
        "PULocationID NOT BETWEEN {lo} AND {hi} OR DOLocationID NOT BETWEEN {lo} AND {hi}"
    ),
}
_DEFAULTS = {
    "min_s": 60, "max_s": 86400, "min_mi": 0.05, "max_mi": 150.0, "max_mph": 85.0,
    "min_fare": 0.0, "max_total": 1500.0, "lo": 1, "hi": 23,
    "start": "1996-01-01", "end": "2001-01-01",
}
_DECEMBER = {**_DEFAULTS, "start": "1997-12-01", "end": "1998-01-01"}
_STRICT = {
    **_DEFAULTS,
    "min_s": 300, "max_s": 3000, "min_mi": 1.0, "max_mi": 8.0, "max_mph": 40.0,
    "min_fare": 5.0, "max_total": 90.0, "lo": 3, "hi": 20,
}
# Flag -> (tag, audit key, label).
_NAMES = {
    "flag_out_of_period": ("OUT_OF_PERIOD", "out_of_period", "Out of Period"),
    "flag_negative_duration": ("NEGATIVE_DURATION", "negative_duration", "Negative Dur"),
    "flag_duration_too_short": ("DURATION_UNDER_1MIN", "duration_under_1min", "<1-Min Duration"),
    "flag_duration_too_long": ("DURATION_OVER_24H", "duration_over_24h", "Duration >24h"),
    "flag_zero_or_neg_distance": ("DISTANCE_UNDER_MIN", "distance_under_0_05mi", "Zero/Neg Dist"),
    "flag_excessive_distance": ("DISTANCE_OVER_150MI", "distance_over_150mi", "Dist >150mi"),
    "flag_implausible_speed": ("SPEED_OVER_85MPH", "speed_over_85mph", "Speed >85mph"),
    "flag_negative_or_zero_fare": (
        "NON_POSITIVE_FARE", "non_positive_fare_or_total", "Refund/Zero Fare"),
    "flag_excessive_fare": ("FARE_OVER_1500", "fare_over_1500", "Fare >$1,500"),
    "flag_unknown_location": (
        "UNKNOWN_OR_OUT_OF_BOUNDS_LOCATION", "unknown_or_unmapped_zone", "Unknown Zone"),
}

_RAW = """
joined AS (
  SELECT l.*, s_nationkey + 1 AS origin, c_nationkey + 1 AS target,
    o_orderdate + to_seconds((l_orderkey * 997 + l_linenumber * 3571) % 86400) AS pickup,
    CASE WHEN l_partkey % 97 = 0 THEN -300 WHEN l_partkey % 89 = 0 THEN 90000
      WHEN l_partkey % 53 = 0 THEN 75
      ELSE (l_partkey * 37 + l_orderkey * 11) % 3600 END AS seconds,
    CASE WHEN l_returnflag = 'R' AND l_discount > 0.095::DOUBLE
      THEN -l_extendedprice / 1000.0::DOUBLE ELSE l_extendedprice / 1000.0::DOUBLE END AS fare,
    CASE WHEN l_orderkey % 7 < 2 THEN 0 ELSE 1 + l_orderkey % 4 END AS pay
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey
),
raw_trips AS (
  SELECT l_linenumber AS VendorID, pickup AS tpep_pickup_datetime,
    pickup + to_seconds(seconds) AS tpep_dropoff_datetime,
    CASE WHEN pay <> 0 THEN 1 + l_suppkey % 4 END AS passenger_count,
    CASE WHEN l_partkey % 83 = 0 THEN 160::DOUBLE WHEN l_partkey % 79 = 0 THEN 0::DOUBLE
      ELSE l_quantity / 5.0::DOUBLE END AS trip_distance,
    CASE WHEN pay <> 0 THEN 1 + l_linenumber % 6 END AS RatecodeID,
    CASE WHEN pay <> 0 THEN CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END END
      AS store_and_fwd_flag,
    origin AS PULocationID, target AS DOLocationID, pay AS payment_type, fare AS fare_amount,
    0.5::DOUBLE AS extra, 0.5::DOUBLE AS mta_tax,
    CASE WHEN pay = 1 THEN fare * l_discount ELSE 0::DOUBLE END AS tip_amount,
    l_tax * 10::DOUBLE AS tolls_amount, 1::DOUBLE AS improvement_surcharge,
    fare * (1::DOUBLE + l_tax) * CASE WHEN l_partkey % 71 = 0 THEN 15::DOUBLE ELSE 1::DOUBLE END
      AS total_amount,
    CASE WHEN pay <> 0 THEN 2.5::DOUBLE END AS congestion_surcharge,
    CASE WHEN pay <> 0 THEN CASE WHEN origin = 5 THEN 1.75::DOUBLE ELSE 0::DOUBLE END END
      AS Airport_fee,
    CASE WHEN pay <> 0 THEN 0.75::DOUBLE END AS cbd_congestion_fee
  FROM joined
),
raw_zones AS (
  SELECT n_nationkey + 1 AS LocationID, r_name AS Borough, n_name AS Zone, r_name AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
timed AS (
  SELECT *, epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime) AS duration_seconds
  FROM raw_trips
),
measured AS (
  SELECT *, CASE WHEN duration_seconds > 0 THEN trip_distance / (duration_seconds / 3600.0)
    ELSE 0.0 END AS effective_speed_mph
  FROM timed
)"""

def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _values(entries) -> str:
    return ", ".join(f"({k}, {_quoted(v)})" for k, v in entries.items())


_STAR = f"""
dim_vendors(vendor_id, vendor_name) AS (VALUES {_values(_VENDORS)}),
dim_rate_codes(rate_code_id, rate_description) AS (VALUES {_values(_RATE_CODES)}),
dim_payment_types(payment_type_id, payment_description) AS (VALUES {_values(_PAYMENT_TYPES)}),
dim_zones AS (
  SELECT LocationID::INTEGER AS location_id, Borough AS borough, Zone AS zone_name, service_zone,
    LocationID IN (1, 2, 3, 4, 5) AS is_manhattan_cbd,
    LocationID IN (5, 10, 15) AS is_airport_zone
  FROM raw_zones WHERE LocationID BETWEEN 1 AND 23
),
fct AS (
  SELECT VendorID AS vendor_id, COALESCE(RatecodeID, 99) AS rate_code_id,
    payment_type AS payment_type_id, PULocationID AS pickup_location_id,
    DOLocationID AS dropoff_location_id, tpep_pickup_datetime AS pickup_datetime,
    tpep_dropoff_datetime AS dropoff_datetime,
    hour(tpep_pickup_datetime) AS pickup_hour, dayname(tpep_pickup_datetime) AS pickup_day_name,
    isodow(tpep_pickup_datetime) AS pickup_day_of_week,
    isodow(tpep_pickup_datetime) >= 6 AS is_weekend,
    CASE WHEN hour(tpep_pickup_datetime) IN (7, 8, 9) THEN 'Morning Rush (07-10)'
      WHEN hour(tpep_pickup_datetime) BETWEEN 10 AND 15 THEN 'Midday (10-16)'
      WHEN hour(tpep_pickup_datetime) BETWEEN 16 AND 19 THEN 'Evening Rush (16-20)'
      ELSE 'Night / Off-Peak' END AS time_window,
    ROUND(duration_seconds / 60.0, 2) AS duration_minutes,
    ROUND(trip_distance, 2) AS trip_distance_miles,
    ROUND(effective_speed_mph, 2) AS effective_speed_mph,
    passenger_count, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
    COALESCE(congestion_surcharge, 0) AS congestion_surcharge,
    COALESCE(Airport_fee, 0) AS airport_fee, COALESCE(cbd_congestion_fee, 0) AS cbd_congestion_fee,
    total_amount, ROUND(total_amount / (duration_seconds / 60.0), 3) AS revenue_per_minute,
    COALESCE(p.borough = d.borough, FALSE) AS is_intra_borough,
    COALESCE(p.is_airport_zone OR d.is_airport_zone, FALSE) AS is_airport_trip,
    COALESCE(p.is_manhattan_cbd OR d.is_manhattan_cbd, FALSE) AS is_cbd_involved
  FROM tagged LEFT JOIN dim_zones p ON PULocationID = p.location_id
  LEFT JOIN dim_zones d ON DOLocationID = d.location_id
  WHERE total_violations = 0
),
known AS (
  SELECT f.*, z.borough AS pickup_borough
  FROM fct f JOIN dim_zones z ON pickup_location_id = location_id
)"""

_KPIS = """
m1 AS (
  SELECT pickup_borough, time_window, COUNT(*) AS trip_count,
    ROUND(AVG(duration_minutes), 1) AS avg_duration_min,
    ROUND(AVG(trip_distance_miles), 2) AS avg_distance_miles,
    ROUND(MEDIAN(effective_speed_mph), 2) AS median_speed_mph,
    ROUND(QUANTILE_CONT(effective_speed_mph, 0.10), 2) AS p10_speed_mph,
    ROUND(QUANTILE_CONT(effective_speed_mph, 0.90), 2) AS p90_speed_mph
  FROM known GROUP BY ALL
),
m2 AS (
  SELECT pickup_borough, is_weekend, time_window, COUNT(*) AS trip_count,
    ROUND(SUM(total_amount), 2) AS total_gross_revenue,
    ROUND(AVG(total_amount), 2) AS avg_fare_per_trip,
    ROUND(AVG(revenue_per_minute), 2) AS avg_revenue_per_active_min,
    ROUND(MEDIAN(revenue_per_minute), 2) AS median_revenue_per_active_min,
    ROUND(AVG(tip_amount), 2) AS avg_tip_amount,
    ROUND(AVG(tip_amount / fare_amount * 100)
      FILTER (WHERE payment_type_id = 1 AND fare_amount > 0), 1) AS avg_cc_tip_pct
  FROM known GROUP BY ALL
),
ends AS (
  SELECT pickup_location_id AS location_id, time_window, 1 AS pickup, 0 AS dropoff FROM fct
  UNION ALL SELECT dropoff_location_id, time_window, 0, 1 FROM fct
),
flow AS (
  SELECT location_id, COALESCE(SUM(pickup), 0)::BIGINT AS total_pickups,
    COALESCE(SUM(dropoff), 0)::BIGINT AS total_dropoffs
  FROM dim_zones LEFT JOIN ends USING (location_id) GROUP BY ALL
),
m3 AS (
  SELECT location_id, borough, zone_name, total_pickups, total_dropoffs,
    total_pickups - total_dropoffs AS net_passenger_flow,
    ROUND(total_pickups::DOUBLE / NULLIF(total_dropoffs, 0), 3) AS flow_ratio,
    CASE WHEN net_passenger_flow > 500 THEN 'Critical Deficit (Demand Source)'
      WHEN net_passenger_flow < -500 THEN 'Critical Surplus (Fleet Sink)'
      ELSE 'Balanced Flow' END AS operational_status
  FROM dim_zones JOIN flow USING (location_id) WHERE total_pickups + total_dropoffs > 2000
),
m4 AS (
  SELECT CASE WHEN 5 IN (pickup_location_id, dropoff_location_id) THEN 'Hub 5'
      WHEN 10 IN (pickup_location_id, dropoff_location_id) THEN 'Hub 10'
      WHEN 15 IN (pickup_location_id, dropoff_location_id) THEN 'Hub 15'
      ELSE 'No Hub' END AS airport_corridor,
    COUNT(*) AS total_trips,
    ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM fct), 2) AS pct_of_all_trips,
    ROUND(AVG(trip_distance_miles), 2) AS avg_distance_miles,
    ROUND(AVG(duration_minutes), 1) AS avg_duration_min,
    ROUND(MEDIAN(effective_speed_mph), 2) AS median_speed_mph,
    ROUND(AVG(total_amount), 2) AS avg_total_fare,
    ROUND(SUM(total_amount), 2) AS total_revenue,
    ROUND(AVG(airport_fee), 2) AS avg_airport_fee,
    ROUND(AVG(tolls_amount), 2) AS avg_tolls,
    ROUND(AVG(revenue_per_minute), 2) AS avg_revenue_per_min
  FROM fct GROUP BY ALL
),
m5 AS (
  SELECT vendor_name, COUNT(*) AS total_records_received,
    COUNT(*) FILTER (WHERE total_violations = 0) AS passed_records,
    COUNT(*) FILTER (WHERE total_violations > 0) AS quarantined_records,
    ROUND(passed_records * 100.0 / total_records_received, 2) AS trust_score_pct,
    ROUND(quarantined_records * 100.0 / total_records_received, 2) AS quarantine_rate_pct,
    SUM(flag_zero_or_neg_distance)::BIGINT AS zero_dist_count,
    SUM(flag_negative_or_zero_fare)::BIGINT AS non_positive_fare_count,
    SUM(flag_duration_too_short)::BIGINT AS short_duration_count,
    SUM(flag_implausible_speed)::BIGINT AS implausible_speed_count
  FROM tagged LEFT JOIN dim_vendors ON VendorID = vendor_id GROUP BY vendor_name
),
m6 AS (
  SELECT COUNT(*) AS clean_trip_volume,
    ROUND(SUM(total_amount), 2) AS total_passenger_expenditure_usd,
    ROUND(AVG(total_amount), 2) AS overall_avg_trip_fare_usd,
    ROUND(AVG(trip_distance_miles), 2) AS overall_avg_distance_miles,
    ROUND(AVG(duration_minutes), 1) AS overall_avg_duration_minutes,
    ROUND(MEDIAN(effective_speed_mph), 2) AS overall_median_speed_mph,
    ROUND(AVG(revenue_per_minute), 2) AS overall_avg_revenue_per_active_min,
    ROUND(SUM(congestion_surcharge), 2) AS total_mta_congestion_surcharge_collected,
    ROUND(SUM(airport_fee), 2) AS total_airport_access_fees_collected
  FROM fct
)"""


def _gate(limits: dict) -> str:
    flags = ",\n    ".join(
        f"COALESCE({cond.format(**limits)}, FALSE)::INTEGER AS {flag}"
        for flag, cond in _FLAGS.items()
    )
    tags = ", ".join(f"CASE {flag} WHEN 1 THEN '{_NAMES[flag][0]}' END" for flag in _FLAGS)
    sums = ", ".join(f"SUM({flag})::BIGINT AS {_NAMES[flag][1]}" for flag in _FLAGS)
    return f"""
flagged AS (
  SELECT *,
    {flags}
  FROM measured
),
tagged AS (
  SELECT *, ({" + ".join(_FLAGS)}) AS total_violations,
    concat_ws('; ', {tags}) AS quarantine_reasons
  FROM flagged
),
audit AS (
  SELECT COUNT(*) AS total_records,
    COUNT(*) FILTER (WHERE total_violations = 0) AS clean_records,
    ROUND(clean_records / total_records * 100, 2) AS clean_rate_pct,
    COUNT(*) FILTER (WHERE total_violations > 0) AS quarantined_records,
    ROUND(quarantined_records / total_records * 100, 2) AS quarantine_rate_pct,
    {sums}
  FROM tagged
)"""


def _sql(body: str, limits: dict = _DEFAULTS) -> str:
    return f"WITH {_RAW},{_gate(limits)},{_STAR},{_KPIS}\n{body}"


_KEY = (
    "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID,"
    " total_amount"
)
_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
_PROFILE_SQL = """
SELECT COUNT(*) AS total_records, COUNT(*) - COUNT(passenger_count) AS null_passenger_count,
  COUNT(*) - COUNT(RatecodeID) AS null_ratecode_id,
  COUNT(*) - COUNT(congestion_surcharge) AS null_congestion_surcharge,
  COUNT(*) FILTER (WHERE tpep_dropoff_datetime < tpep_pickup_datetime) AS negative_duration,
  COUNT(*) FILTER (WHERE trip_distance <= 0) AS zero_or_neg_distance,
  COUNT(*) FILTER (WHERE fare_amount < 0) AS negative_fare,
  COUNT(*) FILTER (WHERE total_amount < 0) AS negative_total
FROM raw_trips"""


def _long(table: str, columns: list[str], name: str, value: str, cast: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS {name}, {c}{cast} AS {value} FROM {table}" for c in columns
    )


_PROFILE_COLUMNS = [
    "total_records", "null_passenger_count", "null_ratecode_id", "null_congestion_surcharge",
    "negative_duration", "zero_or_neg_distance", "negative_fare", "negative_total",
]
_M6_COLUMNS = [
    "clean_trip_volume", "total_passenger_expenditure_usd", "overall_avg_trip_fare_usd",
    "overall_avg_distance_miles", "overall_avg_duration_minutes", "overall_median_speed_mph",
    "overall_avg_revenue_per_active_min", "total_mta_congestion_surcharge_collected",
    "total_airport_access_fees_collected",
]
_RULE_COLUMNS = [names[1] for names in _NAMES.values()]
_LABELS = " ".join(f"WHEN '{n[1]}' THEN '{n[2]}'" for n in _NAMES.values())
_PREVIEW = (
    "pickup_datetime, time_window, duration_minutes, trip_distance_miles, effective_speed_mph,"
    " total_amount, revenue_per_minute, is_airport_trip"
)
_WINDOWS = ["Morning Rush (07-10)", "Midday (10-16)", "Evening Rush (16-20)", "Night / Off-Peak"]
_RANK = "CASE time_window " + " ".join(f"WHEN '{w}' THEN {i}" for i, w in enumerate(_WINDOWS)) + " END"


def _usage(dim: str, key: str, extra: str) -> str:
    return _sql(
        f"SELECT {key}, {extra}, (SELECT COUNT(*) FROM fct WHERE fct.{key} = {dim}.{key})"
        f" AS fact_rows FROM {dim}"
    )


def _orphans(facts: str = "fct") -> str:
    references = {
        "vendor_id": ("dim_vendors", "vendor_id"),
        "rate_code_id": ("dim_rate_codes", "rate_code_id"),
        "payment_type_id": ("dim_payment_types", "payment_type_id"),
        "pickup_location_id": ("dim_zones", "location_id"),
        "dropoff_location_id": ("dim_zones", "location_id"),
    }
    return _sql(
        " UNION ALL ".join(
            f"SELECT '{col}' AS foreign_key, COUNT(*) AS fact_rows,"
            f" COUNT(*) FILTER (WHERE {col} NOT IN (SELECT {key} FROM {dim})) AS orphan_rows,"
            f" COUNT(DISTINCT {col}) FILTER (WHERE {col} NOT IN (SELECT {key} FROM {dim}))"
            f" AS orphan_keys FROM {facts}"
            for col, (dim, key) in references.items()
        )
    )


def _series(table: str, key: str, value: str) -> str:
    cells = ", ".join(
        f"COALESCE({value.format(cond=f'FILTER (WHERE time_window = {chr(39)}{w}{chr(39)})')}, 0.0)"
        f' AS "{w}"'
        for w in _WINDOWS
    )
    return _sql(f"SELECT {key}, {cells} FROM {table} GROUP BY {key}")


def _top(sign: str) -> str:
    return _sql(
        "SELECT zone_name, borough, total_pickups, total_dropoffs, net_passenger_flow FROM m3"
        f" WHERE net_passenger_flow {sign} 0 ORDER BY abs(net_passenger_flow) DESC, location_id"
        " LIMIT 5"
    )


def oracle_sql() -> dict[str, str]:
    queries = {
        "source_counts": _sql(
            "SELECT 'raw_trips' AS source, COUNT(*) AS row_count FROM raw_trips"
            " UNION ALL SELECT 'raw_zones', COUNT(*) FROM raw_zones"
        ),
        "zone_completeness": _sql(
            "SELECT COUNT(*) AS record_count, 25 AS expected_min_records, '' AS missing_columns,"
            " CASE WHEN COUNT(*) >= 25 THEN 'VERIFIED_COMPLETE' ELSE 'INCOMPLETE' END AS status"
            " FROM raw_zones"
        ),
        "manifest_summary": " UNION ALL ".join(
            f"SELECT '{t}.parquet' AS file_name, (SELECT COUNT(*) FROM {t}) AS num_rows,"
            " COUNT(*)::INTEGER AS num_columns,"
            " string_agg(column_name, ',' ORDER BY column_index) AS columns,"
            f" CASE WHEN (SELECT COUNT(*) FROM {t}) > 0 THEN 'VERIFIED_COMPLETE' ELSE 'EMPTY' END"
            f" AS status FROM duckdb_columns() WHERE table_name = '{t}'"
            for t in _TABLES
        ),
        "file_hashes": " UNION ALL ".join(
            f"SELECT '{t}.parquet' AS file_name, COUNT(*) AS num_rows, TRUE AS size_holds,"
            f" TRUE AS hash_holds FROM {t}"
            for t in _TABLES
        ),
        # Of the months that trips began in, the one whose last trip ended last.
        "latest_month": _sql(
            "SELECT strftime(pickup_datetime, '%Y-%m') AS month FROM fct"
            " ORDER BY dropoff_datetime DESC, month DESC LIMIT 1"
        ),
        "memory_gate": (
            "SELECT COUNT(*) AS total_records,"
            " SUM(CAST(id = 1 OR id - 1 > 85 / 4.0 OR id > 23 AS BIGINT))::BIGINT AS quarantined_records,"
            " SUM(CAST(id = 1 AS BIGINT))::BIGINT AS distance_under_0_05mi,"
            " SUM(CAST(id - 1 > 85 / 4.0 AS BIGINT))::BIGINT AS speed_over_85mph,"
            " SUM(CAST(id > 23 AS BIGINT))::BIGINT AS unknown_or_unmapped_zone"
            " FROM (SELECT n_nationkey + 1 AS id FROM nation)"
        ),
        "raw_profile": _sql(_PROFILE_SQL),
        "profile_long": _sql(
            f"SELECT * FROM ({_long(f'({_PROFILE_SQL})', _PROFILE_COLUMNS, 'metric', 'value', '::DOUBLE')})"
        ),
        "dq_duration_speed": _sql(
            f"SELECT {_KEY}, duration_seconds, effective_speed_mph FROM tagged"
        ),
        "dq_rule_flags": _sql(f"SELECT {_KEY}, {', '.join(_FLAGS)} FROM tagged"),
        "dq_reasons": _sql(f"SELECT {_KEY}, total_violations, quarantine_reasons FROM tagged"),
        "dq_clean": _sql("SELECT * FROM tagged WHERE total_violations = 0"),
        "dq_quarantine": _sql("SELECT * FROM tagged WHERE total_violations > 0"),
        "dq_audit": _sql("SELECT * FROM audit"),
        "dq_violations_long": _sql(_long("audit", _RULE_COLUMNS, "rule", "violation_count")),
        "dq_strict_rules": _sql("SELECT * FROM audit", _STRICT),
        "dim_vendors": _usage("dim_vendors", "vendor_id", "vendor_name"),
        "dim_rate_codes": _usage("dim_rate_codes", "rate_code_id", "rate_description"),
        "dim_payment_types": _usage(
            "dim_payment_types",
            "payment_type_id",
            "payment_description, payment_type_id = 1 AS is_electronic_tip_recorded",
        ),
        "dim_zones": _sql("SELECT * FROM dim_zones"),
        "fct_calendar": _sql(
            "SELECT pickup_datetime, pickup_hour, pickup_day_name, pickup_day_of_week, is_weekend,"
            " time_window FROM fct"
        ),
        "fct_money": _sql(
            "SELECT rate_code_id, fare_amount, total_amount, congestion_surcharge, airport_fee,"
            " cbd_congestion_fee, duration_minutes, trip_distance_miles, effective_speed_mph,"
            " revenue_per_minute FROM fct"
        ),
        "fct_flags": _sql(
            "SELECT pickup_location_id, dropoff_location_id, is_intra_borough, is_airport_trip,"
            " is_cbd_involved FROM fct"
        ),
        "fct_full": _sql("SELECT * FROM fct"),
        "fct_surrogate_key_check": _sql(
            "SELECT COUNT(*) AS fact_rows, COUNT(DISTINCT trip_id) AS trip_ids,"
            " MIN(trip_id) AS first_id, MAX(trip_id) AS last_id"
            " FROM (SELECT row_number() OVER () AS trip_id FROM fct)"
        ),
        "build_counts": _sql(
            "SELECT 'fct_trips' AS table_name, COUNT(*) AS row_count FROM fct"
            " UNION ALL SELECT 'dim_zones', COUNT(*) FROM dim_zones"
        ),
        "fk_orphans": _orphans(),
        "m1_speed": _sql("SELECT * FROM m1"),
        "m1_head": _sql(f"SELECT * FROM m1 ORDER BY pickup_borough, {_RANK} LIMIT 10"),
        "m2_revenue": _sql("SELECT * FROM m2"),
        "m3_flow": _sql("SELECT * FROM m3"),
        "m3_flow_by_band": _sql(
            "SELECT location_id, borough, zone_name, time_window,"
            " SUM(pickup)::BIGINT AS total_pickups, SUM(dropoff)::BIGINT AS total_dropoffs,"
            " total_pickups - total_dropoffs AS net_passenger_flow,"
            " ROUND(total_pickups::DOUBLE / NULLIF(total_dropoffs, 0), 3) AS flow_ratio,"
            " CASE WHEN net_passenger_flow > 100 THEN 'Critical Deficit (Demand Source)'"
            " WHEN net_passenger_flow < -100 THEN 'Critical Surplus (Fleet Sink)'"
            " ELSE 'Balanced Flow' END AS operational_status"
            " FROM dim_zones JOIN ends USING (location_id)"
            " GROUP BY location_id, borough, zone_name, time_window"
        ),
        "m4_corridors": _sql("SELECT * FROM m4"),
        "m5_vendor_trust": _sql("SELECT * FROM m5"),
        "m6_executive": _sql("SELECT * FROM m6"),
        "m6_transposed": _sql(_long("m6", _M6_COLUMNS, "metric", "value", "::DOUBLE")),
        "null_cooccurrence": _sql(
            "SELECT passenger_count IS NULL AS passenger_count_missing,"
            " RatecodeID IS NULL AS RatecodeID_missing,"
            " store_and_fwd_flag IS NULL AS store_and_fwd_flag_missing,"
            " congestion_surcharge IS NULL AS congestion_surcharge_missing,"
            " Airport_fee IS NULL AS Airport_fee_missing, payment_type, COUNT(*) AS records,"
            " ROUND(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM raw_trips), 2) AS pct_of_records"
            " FROM raw_trips GROUP BY ALL"
        ),
        "null_rows_revenue": _sql(
            "SELECT COUNT(*) AS records, ROUND(SUM(total_amount), 2) AS total_amount_usd"
            " FROM raw_trips WHERE passenger_count IS NULL"
        ),
        "zero_second_trips": _sql(
            "SELECT COUNT(*) FILTER (WHERE duration_seconds < 60) AS under_one_minute,"
            " COUNT(*) FILTER (WHERE duration_seconds = 0) AS zero_seconds FROM timed"
        ),
        "extreme_outlier": _sql(
            "SELECT trip_distance, effective_speed_mph, tpep_pickup_datetime, total_amount,"
            " duration_seconds FROM measured ORDER BY ALL DESC LIMIT 1"
        ),
        "card_tip_share": _sql(
            "SELECT COUNT(*) AS card_trips, ROUND(AVG(tip_amount / fare_amount * 100), 1)"
            " AS avg_card_tip_pct FROM fct WHERE payment_type_id = 1 AND fare_amount > 0"
        ),
        "cash_zero_tip_share": _sql(
            "SELECT COUNT(*) AS cash_trips, COUNT(*) FILTER (WHERE tip_amount = 0)"
            " AS zero_tip_trips, ROUND(zero_tip_trips * 100.0 / cash_trips, 2) AS zero_tip_pct"
            " FROM raw_trips WHERE payment_type = 2"
        ),
        "kpi_cards": _sql(
            "SELECT clean_trip_volume, clean_rate_pct, quarantined_records, quarantine_rate_pct,"
            " round_even(total_passenger_expenditure_usd / 1e6, 2) AS total_spend_millions,"
            " overall_avg_trip_fare_usd AS avg_trip_fare,"
            " overall_avg_distance_miles AS avg_distance_miles,"
            " round_even(overall_median_speed_mph, 1) AS median_speed_mph,"
            " overall_avg_duration_minutes AS avg_duration_minutes,"
            " overall_avg_revenue_per_active_min AS revenue_per_minute,"
            " round_even(overall_avg_revenue_per_active_min * 60, 2) AS revenue_per_hour,"
            " round_even(total_mta_congestion_surcharge_collected / 1e6, 2)"
            " AS congestion_surcharge_millions,"
            " round_even(total_airport_access_fees_collected, 0) AS airport_fees FROM m6, audit"
        ),
        "speed_series": _series("m1", "pickup_borough", "MAX(median_speed_mph) {cond}"),
        "revenue_series": _series(
            "m2",
            "is_weekend",
            "round_even(SUM(avg_revenue_per_active_min * trip_count) {cond}"
            " / SUM(trip_count) {cond}, 2)",
        ),
        "violation_labels": _sql(
            f"SELECT rule, violation_count, CASE rule {_LABELS} ELSE rule END AS label"
            f" FROM ({_long('audit', _RULE_COLUMNS, 'rule', 'violation_count')})"
        ),
        "top_sources": _top(">"),
        "top_sinks": _top("<"),
        "corridor_feed": _sql(
            "SELECT airport_corridor, total_trips, pct_of_all_trips, avg_distance_miles,"
            " avg_total_fare, median_speed_mph, avg_revenue_per_min FROM m4"
        ),
        "vendor_feed": _sql(
            "SELECT vendor_name, total_records_received, passed_records, quarantined_records,"
            " trust_score_pct, CASE WHEN trust_score_pct > 90 THEN 'trusted' ELSE 'at risk' END"
            " AS trust_class, quarantine_rate_pct, zero_dist_count, non_positive_fare_count,"
            " short_duration_count FROM m5"
        ),
        "quarantine_roundtrip": _sql("SELECT * FROM tagged WHERE total_violations > 0"),
        "fact_roundtrip": _sql("SELECT * FROM fct"),
        "kpi_roundtrip": _sql("SELECT * FROM m1"),
        "audit_roundtrip": _sql(
            "SELECT *, "
            + ", ".join(f"{_quoted(text)} AS {name}" for name, text in _POLICY.items())
            + " FROM audit"
        ),
        "dq_december": _sql("SELECT * FROM audit", _DECEMBER),
        "fk_no_trips": _orphans("fct WHERE FALSE"),
        "rerun_replaces": _sql(
            "SELECT 'kept' AS label, 'clean' AS table_name, clean_records AS row_count FROM audit"
            " UNION ALL SELECT 'kept', 'quarantine', quarantined_records FROM audit"
            " UNION ALL SELECT 'rerun', 'clean', 0 FROM audit"
            " UNION ALL SELECT 'rerun', 'quarantine', total_records FROM audit"
        ),
        "trip_folder": _sql(
            "SELECT VendorID, COUNT(*) AS records, SUM(passenger_count)::BIGINT AS passengers,"
            " SUM(RatecodeID)::BIGINT AS rate_codes,"
            " SUM(PULocationID + DOLocationID)::BIGINT AS zones, SUM(Airport_fee) AS airport_fees,"
            " SUM(cbd_congestion_fee) FILTER (WHERE VendorID % 3 <> 1) AS cbd_fees,"
            " MAX(tpep_dropoff_datetime) AS last_dropoff FROM raw_trips GROUP BY VendorID"
        ),
        "zone_csv": _sql("SELECT * REPLACE (LocationID::INTEGER AS LocationID) FROM raw_zones"),
        "published_revenue": _sql("SELECT * FROM m2"),
        "m2_head": _sql(
            "SELECT * FROM m2 ORDER BY pickup_borough NULLS LAST, is_weekend NULLS LAST,"
            " time_window NULLS LAST LIMIT 10"
        ),
        "m4_head": _sql("SELECT * FROM m4 ORDER BY total_trips DESC, airport_corridor LIMIT 2"),
        "m5_head": _sql(
            "SELECT * FROM m5 ORDER BY total_records_received DESC, vendor_name NULLS LAST LIMIT 3"
        ),
        "fct_preview": _sql(
            f"SELECT {_PREVIEW} FROM fct ORDER BY"
            f" {', '.join(f'{c} NULLS FIRST' for c in _PREVIEW.split(', '))} LIMIT 5"
        ),
    }
    # A whole run, read back from what it published.
    queries["published_cards"] = queries["kpi_cards"]
    queries["published_violations"] = queries["violation_labels"]
    queries["published_revenue_series"] = queries["revenue_series"]
    queries["published_flow"] = queries["top_sources"]
    queries["published_feeds"] = queries["vendor_feed"]
    return queries
