"""Train / test split that depends on the key alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innlake.functions.scalars import QUARTER_MONTHS
from innlake.schemas import indicator

TRAIN_PERCENT = 80


def split_bucket(key: Column) -> Column:
    """0..99, a function of the key's text only.

    Unlike randomSplit it gives the same rows after any repartitioning, retry
    or lost executor.
    """
    digits = F.substring(F.md5(key.cast("string").cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") % 100


def train_test_split(
    df: DataFrame, key: str, train_percent: int = TRAIN_PERCENT,
) -> tuple[DataFrame, DataFrame]:
    bucket = split_bucket(F.col(key))
    return df.filter(bucket < train_percent), df.filter(bucket >= train_percent)


def _months(quarter: int) -> list[Column]:
    return [F.col(indicator("arrival_date_month", m)) == 1 for m in QUARTER_MONTHS[quarter]]


def quarter_slice_literal(df: DataFrame, quarter: int, year: int) -> DataFrame:
    """The published predicate: m1 OR m2 OR (m3 AND year)."""
    first, second, third = _months(quarter)
    return df.filter(first | second | (third & (F.col("arrival_date_year") == year)))


def quarter_slice(df: DataFrame, quarter: int, year: int) -> DataFrame:
    """Rows of one quarter of one year."""
    first, second, third = _months(quarter)
    return df.filter((first | second | third) & (F.col("arrival_date_year") == year))
