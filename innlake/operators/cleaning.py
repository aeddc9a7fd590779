"""Row cleaning of bookings and listings.

Every step is a projection or a plain comparison: no shuffle, and the range
filters are pushed to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innlake.functions.scalars import (
    presence_label, round_half_even, upper_clamp, within_upper_bound,
)

# The accepted rate range and the listing bounds.
RATE_ABOVE, RATE_AT_MOST = 50, 400
LISTING_BOUNDS = {"accommodates": 10, "bedrooms": 5, "minstay": 5}


class MissingRateError(ValueError):
    """Raised when a booking has no rate, which the cleaning cannot place."""


def fill_missing(df: DataFrame) -> DataFrame:
    fills = {"children": 0, "country": "Unknown"}
    return df.na.fill({c: v for c, v in fills.items() if c in df.columns})


def label_presence(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "agent": presence_label(F.col("agent"), "Agent", "No Agent"),
        "company": presence_label(F.col("company"), "Corporate", "No Company"),
    })


def recode_meal(df: DataFrame) -> DataFrame:
    return df.withColumn("meal", F.when(F.col("meal") == "Undefined", "SC").otherwise(F.col("meal")))


def clamp_parking(df: DataFrame) -> DataFrame:
    name = "required_car_parking_spaces"
    return df.withColumn(name, upper_clamp(F.col(name), 1))


def in_rate_range() -> Column:
    """50 < adr <= 400."""
    return (F.col("adr") > RATE_ABOVE) & (F.col("adr") <= RATE_AT_MOST)


def keep_rate_range(df: DataFrame) -> DataFrame:
    """50 < adr <= 400, on the unrounded rate. Check missing rates beforehand."""
    return df.filter(in_rate_range())


def round_rate(df: DataFrame) -> DataFrame:
    return df.withColumn("adr", round_half_even(F.col("adr")))


def missing_rates(df: DataFrame) -> DataFrame:
    """Rows that have to be rejected because their rate is missing."""
    return df.filter(F.col("adr").isNull())


def require_rates(df: DataFrame) -> None:
    if not missing_rates(df).isEmpty():
        raise MissingRateError("bookings without adr found; reject them before cleaning")


def clean_bookings(
    df: DataFrame, *, recode: bool, rate_filter: bool,
) -> DataFrame:
    """Cleaning shared by the feature tables.

    recode: map meal 'Undefined' to 'SC' and cap parking at 1 (historical price).
    rate_filter: keep the rate range, then round half to even (all but the
    historical cancellation table).
    """
    df = df.na.fill({"children": 0})
    if recode:
        df = clamp_parking(recode_meal(df))
    if rate_filter:
        df = round_rate(keep_rate_range(df))
    return df


def clean_listings(df: DataFrame) -> DataFrame:
    for name, bound in LISTING_BOUNDS.items():
        df = df.filter(within_upper_bound(F.col(name), bound))
    return df


def split_by_value(df: DataFrame, column: str, values: list[str]) -> dict[str, DataFrame]:
    return {value: df.filter(F.col(column) == value) for value in values}
