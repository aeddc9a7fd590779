"""Categories as means of a target: over earlier rows for training, over all rows for scoring.

A row's own label must not reach its features. So training rows stand in the order
of a hash of their key, and a row's category is the mean over rows of that category
that stand before it, drawn towards the overall mean by a weight. The order is cut
into blocks of some BLOCK_ROWS rows. Sums inside a block come from windows over its
rows, sums of the blocks before from one row for each block and category: no
window holds a category's rows of all blocks.

Defined results: null is a category; rows without a label count nowhere but are
encoded; equal hashes go by key; a category without earlier (or any) rows has the
overall mean; an empty table stays empty.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
_HASH_BITS = 60


def order_hash(key: Column) -> Column:
    """60 bits of a hash of the key's text."""
    digits = F.substring(F.md5(key.cast("string").cast("binary")), 1, _HASH_BITS // 4)
    return F.coalesce(F.conv(digits, 16, 10).cast("bigint"), F.lit(0))


def target_name(column: str) -> str:
    return f"{column}_target"


def _mean(total: Column, n: Column, overall: float, weight: float) -> Column:
    return (F.coalesce(total, F.lit(0.0)) + F.lit(weight * overall)) / (F.coalesce(n, F.lit(0)) + F.lit(weight))


def ordered_means(df: DataFrame, key: str, columns: list[str], label: str, weight: float = 1.0,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """df with `<column>_target` for each of the columns."""
    y = F.col(f"`{label}`").cast("double")
    facts = df.agg(F.count("*").alias("n"), F.avg(y).alias("mean")).first()
    blocks, overall = 1 + facts["n"] // block_rows, facts["mean"] or 0.0
    place = F.shiftright(F.col("_order"), _HASH_BITS - 32) * blocks
    rows = df.withColumns({"_order": order_hash(F.col(f"`{key}`")), "_label": y}) \
        .withColumn("_block", F.shiftright(place, 32))
    dealt = rows.repartition("_block")  # serves the windows of all columns
    for c in columns:
        own = F.col(f"`{c}`")
        earlier = Window.partitionBy("_block", own).orderBy("_order", F.col(f"`{key}`")).rowsBetween(
            Window.unboundedPreceding, -1)
        totals = rows.groupBy("_block", own.alias("_level")).agg(F.sum("_label").alias("_t"), F.count("_label").alias("_n"))
        blocks_before = Window.partitionBy("_level").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        before = totals.select(F.col("_block").alias("_b"), "_level", F.sum("_t").over(blocks_before).alias("_total"),
                               F.sum("_n").over(blocks_before).alias("_count"))
        dealt = dealt.withColumns({"_in_total": F.sum("_label").over(earlier), "_in_count": F.count("_label").over(earlier)}) \
            .join(before, (F.col("_block") == F.col("_b")) & own.eqNullSafe(F.col("_level")), "left")
        total = F.coalesce("_in_total", F.lit(0.0)) + F.coalesce("_total", F.lit(0.0))
        count = F.coalesce("_in_count", F.lit(0)) + F.coalesce("_count", F.lit(0))
        dealt = dealt.withColumn(target_name(c), _mean(total, count, overall, weight)).drop(
            "_in_total", "_in_count", "_b", "_level", "_total", "_count")
    return dealt.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"`{target_name(c)}`") for c in columns])


@dataclass
class TargetMeans:
    """Means over all rows: a table (column, level, total, n), the overall mean and its weight."""

    columns: list[str]
    levels: DataFrame
    overall: float
    weight: float

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str], label: str, weight: float = 1.0) -> TargetMeans:
        y = F.col(f"`{label}`").cast("double")
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("level")) for c in columns])
        levels = df.select(y.alias("y"), F.explode(cells).alias("cell")).groupBy("cell.column", "cell.level").agg(F.sum("y").alias("total"), F.count("y").alias("n"))
        return cls(columns, levels, df.agg(F.avg(y)).first()[0] or 0.0, weight)

    def transform(self, df: DataFrame) -> DataFrame:
        """df with `<column>_target` for each of the columns."""
        out = df
        for c in self.columns:
            own = self.levels.filter(F.col("column") == c).select(F.col("level").alias("_level"), "total", "n")
            out = out.join(own, F.col(f"`{c}`").cast("string").eqNullSafe(F.col("_level")), "left") \
                .withColumn(target_name(c), _mean(F.col("total"), F.col("n"), self.overall, self.weight)).drop("_level", "total", "n")
        return out

    def save(self, path: str) -> None:
        self.levels.write.mode("overwrite").parquet(f"{path}/levels")
        spark = SparkSession.active()
        spark.createDataFrame([(self.columns, self.overall, self.weight)], _FACTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/means")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TargetMeans:
        facts = spark.read.schema(_FACTS).parquet(f"{path}/means").first()
        return cls(facts["columns"], spark.read.parquet(f"{path}/levels"), facts["overall"], facts["weight"])


_FACTS = "columns array<string>, overall double, weight double"
