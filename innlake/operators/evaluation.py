"""Hold-out metrics, leaderboards and the choice of a champion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """n, mse, rmse and r2 in one aggregate.

    The total sum of squares comes from the merge-stable variance aggregate,
    so no separate pass for the mean is needed.
    """
    error = F.col(label) - F.col(prediction)
    mse, variance = F.avg(error * error), F.var_pop(F.col(label))
    return df.agg(
        F.count("*").alias("n_rows"), mse.alias("mse"), variance.alias("variance"),
    ).select(
        "n_rows", "mse", F.sqrt("mse").alias("rmse"),
        (1 - F.try_divide(F.col("mse"), F.col("variance"))).alias("r2"),
    )


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """n, accuracy and the RMSE of the class labels in one aggregate."""
    error = (F.col(label) - F.col(prediction)).cast("double")
    return df.agg(
        F.count("*").alias("n_rows"),
        F.avg((F.col(label) == F.col(prediction)).cast("int")).alias("accuracy"),
        F.sqrt(F.avg(error * error)).alias("label_rmse"),
    )


def regression_facts(train: DataFrame, scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """Hold-out size and mean, the error of guessing the training mean, and whether the model's is lower."""
    guess = train.agg(F.avg(label).alias("guess"))
    error, plain = F.col(label) - F.col(prediction), F.col(label) - F.col("guess")
    return scored.crossJoin(F.broadcast(guess)).agg(  # one row
        F.count("*").alias("n_rows"), F.round(F.avg(label), 6).alias("label_mean"),
        F.round(F.avg(plain * plain), 6).alias("baseline_mse"),
        (F.avg(error * error) < F.avg(plain * plain)).alias("beats_baseline"))


def classification_facts(train: DataFrame, scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """Hold-out size and classes, the accuracy of guessing the commonest training class, and whether the model's is higher."""
    guess = train.groupBy(F.col(label).alias("guess")).count().orderBy(F.desc("count"), "guess").limit(1).select("guess")
    right, plain = F.col(label) == F.col(prediction), F.col(label) == F.col("guess")
    return scored.crossJoin(F.broadcast(guess)).agg(  # one row
        F.count("*").alias("n_rows"), F.count_distinct(label).alias("n_classes"),
        F.round(F.avg(plain.cast("double")), 6).alias("baseline_accuracy"),
        (F.avg(right.cast("double")) > F.avg(plain.cast("double"))).alias("beats_baseline"))


def leaderboard(df: DataFrame, label: str, candidates: dict[str, Column]) -> DataFrame:
    """R2 and MSE of several predictions of the same rows, in one aggregate.

    candidates maps a name to the prediction expression; the order of the dict
    is the order used to settle ties.
    """
    names = list(candidates)
    errors = [F.col(label) - candidates[n] for n in names]
    wide = df.agg(
        F.var_pop(F.col(label)).alias("variance"),
        *[F.avg(e * e).alias(f"mse_{i}") for i, e in enumerate(errors)],
    )
    return wide.select(F.inline(F.array(*[
        F.struct(
            F.lit(i).alias("ordinal"), F.lit(n).alias("candidate"),
            F.col(f"mse_{i}").alias("mse"),
            (1 - F.try_divide(F.col(f"mse_{i}"), F.col("variance"))).alias("r2"),
        ) for i, n in enumerate(names)
    ])))


def champion(scores: DataFrame, metric: str) -> DataFrame:
    """Best candidate; a tie keeps the earlier one, a missing or NaN metric loses."""
    known = F.when(~F.isnan(metric), F.col(metric))
    return scores.orderBy(known.desc_nulls_last(), F.col("ordinal").asc()).limit(1)
