"""One-hot encoding, with a fixed or an observed vocabulary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innlake.functions.sqltext import name, rows, text
from innlake.schemas import VOCABULARY, indicator


class TooManyLevelsError(ValueError):
    """A column has more distinct values than may become columns."""


def indicator_columns(column: str, levels: list[str]) -> list[str]:
    return [
        f"coalesce(cast({name(column)} = {text(level)} as int), 0) as {name(indicator(column, level))}"
        for level in levels
    ]


def one_hot(df: DataFrame, vocabulary: dict[str, list[str]] = VOCABULARY) -> DataFrame:
    """Replace each column by its 0/1 columns in one projection.

    Missing and unknown values give 0 everywhere. Needs no pass over the data,
    so it also works on streams.
    """
    present = {c: levels for c, levels in vocabulary.items() if c in df.columns}
    kept = [name(c) for c in df.columns if c not in present]
    return df.selectExpr(*kept, *[
        column for c, levels in present.items() for column in indicator_columns(c, levels)
    ])


def value_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, level) for every cell of the columns."""
    return df.selectExpr(rows([
        f"struct({text(c)} as column_name, cast({name(c)} as string) as level)" for c in columns
    ]))


def observed_levels(
    df: DataFrame, columns: list[str], max_levels: int | None = None,
) -> dict[str, list[str]]:
    """Sorted distinct values per column, found in one pass.

    Levels become columns. Without max_levels all of them do; with it, a column
    with more is an error, found by counts before any level is collected.
    """
    pairs = value_pairs(df, columns).filter("level is not null").distinct()
    if max_levels is not None:
        wide = pairs.groupBy("column_name").count().filter(F.col("count") > max_levels).collect()
        if wide:
            raise TooManyLevelsError(f"more than {max_levels} levels in {sorted(r['column_name'] for r in wide)}")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in pairs.collect():
        found[row["column_name"]].append(row["level"])
    return {c: sorted(levels) for c, levels in found.items()}


def one_hot_observed(df: DataFrame, columns: list[str], max_levels: int | None = None) -> DataFrame:
    return one_hot(df, observed_levels(df, columns, max_levels))


def unknown_levels(df: DataFrame, vocabulary: dict[str, list[str]] = VOCABULARY) -> DataFrame:
    """Row counts of the values outside the vocabulary."""
    known = F.lit(False)
    for c, levels in vocabulary.items():
        known = known | ((F.col("column_name") == c) & F.col("level").isin(levels))
    pairs = value_pairs(df, list(vocabulary)).filter(~known)
    return (pairs.filter("level is not null")
            .groupBy("column_name", "level").agg(F.count("*").alias("n_rows")))


def ordinal(col: Column, levels: list[str]) -> Column:
    """Position of the value in the level list, NULL when unknown."""
    mapping = F.create_map(*[part for i, level in enumerate(levels) for part in (F.lit(level), F.lit(i))])
    return F.try_element_at(mapping, col)
