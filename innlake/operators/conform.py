"""Conforming frames to the feature-table templates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innlake.functions.scalars import booking_number
from innlake.functions.sqltext import name
from innlake.operators.cleaning import clean_bookings
from innlake.operators.encoding import observed_levels, one_hot
from innlake.schemas import (
    CANCEL_INPUTS, CANCEL_TABLE, PRICE_INPUTS, PRICE_TABLE, VOCABULARY, WAREHOUSE_RENAMES,
)


def conform(df: DataFrame, table: dict[str, str], keep_unknown: bool = False) -> DataFrame:
    """Impose column order and types; absent columns and NULLs become 0.

    One projection for all columns. With keep_unknown, further columns of the
    frame follow the template, before `predicted`.
    """
    def cell(column: str, kind: str) -> str:
        value = f"coalesce(cast({name(column)} as {kind}), cast(0 as {kind}))"
        return f"{value if column in df.columns else f'cast(0 as {kind})'} as {name(column)}"

    cells = [cell(c, kind) for c, kind in table.items() if c != "predicted"]
    if keep_unknown:
        cells += [f"coalesce({name(c)}, 0) as {name(c)}" for c in df.columns if c not in table]
    if "predicted" in table:
        cells.append(cell("predicted", table["predicted"]))
    return df.selectExpr(*cells)


def _encode(df: DataFrame, table: dict[str, str], keep_unknown: bool) -> DataFrame:
    if not keep_unknown:
        return conform(one_hot(df), table)
    seen = observed_levels(df, list(VOCABULARY))
    levels = {
        c: known + [level for level in seen[c] if level not in known]
        for c, known in VOCABULARY.items()
    }
    return conform(one_hot(df, levels), table, keep_unknown=True)


def historical_price(df: DataFrame, keep_unknown: bool = False) -> DataFrame:
    cleaned = clean_bookings(df.select(*PRICE_INPUTS), recode=True, rate_filter=True)
    return _encode(cleaned, PRICE_TABLE, keep_unknown)


def historical_cancel(df: DataFrame, keep_unknown: bool = False) -> DataFrame:
    """Unfiltered and unrounded; the arrival year is not selected and becomes 0."""
    return _encode(df.select(*CANCEL_INPUTS), CANCEL_TABLE, keep_unknown)


def monthly_features(df: DataFrame) -> DataFrame:
    """Columns both monthly feature tables share, computed once."""
    cleaned = clean_bookings(df, recode=False, rate_filter=True)
    numbered = cleaned.withColumn("Booking_ID", booking_number(F.col("Booking_ID")))
    return one_hot(numbered.drop("arrival_date_day_of_month"))


def monthly_price(df: DataFrame) -> DataFrame:
    return conform(monthly_features(df), PRICE_TABLE)


def monthly_cancel(df: DataFrame) -> DataFrame:
    return conform(monthly_features(df), CANCEL_TABLE)


def to_warehouse_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(WAREHOUSE_RENAMES)


def from_warehouse_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({new: old for old, new in WAREHOUSE_RENAMES.items()})
