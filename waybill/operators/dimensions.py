"""Conformed dimensions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from waybill.functions.numeric import text
from waybill.profile import CARD_PAYMENT, Profile


def dictionary(
    spark: SparkSession, entries: Mapping[int, str], key: str, value: str
) -> DataFrame:
    """A dictionary as inline VALUES.

    Unlike ``createDataFrame`` this plans as a local relation of known size, so
    joins to it broadcast without a hint.
    """
    rows = ", ".join(f"({k:d}, {text(v)})" for k, v in entries.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({key}, {value})")


def vendors(spark: SparkSession, profile: Profile) -> DataFrame:
    return dictionary(spark, profile.vendors, "vendor_id", "vendor_name")


def rate_codes(spark: SparkSession, profile: Profile) -> DataFrame:
    return dictionary(spark, profile.rate_codes, "rate_code_id", "rate_description")


def payment_types(spark: SparkSession, profile: Profile) -> DataFrame:
    dim = dictionary(spark, profile.payment_types, "payment_type_id", "payment_description")
    return dim.selectExpr("*", f"payment_type_id = {CARD_PAYMENT} AS is_electronic_tip_recorded")


def in_zones(column: str, ids) -> str:
    return f"{column} IN ({', '.join(map(str, ids))})" if ids else "FALSE"


def zones(raw_zones: DataFrame, profile: Profile) -> DataFrame:
    """Known zones with their central-district and airport membership."""
    first, last = profile.zone_id_range
    return raw_zones.filter(f"LocationID BETWEEN {first} AND {last}").selectExpr(
        "CAST(LocationID AS INT) AS location_id",
        "Borough AS borough",
        "Zone AS zone_name",
        "service_zone",
        f"{in_zones('LocationID', profile.cbd_zone_ids)} AS is_manhattan_cbd",
        f"{in_zones('LocationID', profile.airport_zone_ids)} AS is_airport_zone",
    )
