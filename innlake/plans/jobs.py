"""The three jobs: historical load, monthly load, quarterly retraining."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innlake.learners.knn import feature_array, fit_knn
from innlake.learners.presets import classifier, regressor
from innlake.learners.scoring import cancel_scorer, predictions, price_scorer
from innlake.learners.store import Champion, ModelStore
from innlake.operators.cleaning import clean_listings, require_rates
from innlake.operators.conform import (
    from_warehouse_names, historical_cancel, historical_price, to_warehouse_names,
)
from innlake.operators.evaluation import champion, classification_metrics, regression_metrics
from innlake.operators.splitting import quarter_slice, train_test_split
from innlake.schemas import CANCEL_PREDICTORS, LISTINGS, MONTHLY, PRICE_PREDICTORS
from innlake.session import ensure_checkpoint_dir, spread
from innlake.sources.csv_files import read_csv
from innlake.sources.tables import Table
from innlake.streaming.ingest import CANCEL_NAME, PRICE_NAME, append_month

# Table names of the published warehouse.
BOOKINGS_NAME, LISTINGS_NAME = "hotel_booking_eda", "airbnb_eda"
PRICE_MODEL, CANCEL_MODEL = "price", "cancel"
# In order of precedence on equal metrics.
PRICE_CANDIDATES = ["random_forest", "gbt", "leafwise", "second_order", "ordered"]
CANCEL_CANDIDATES = ["random_forest", "ordered", "knn", "gbt"]


def batch_etl(spark: SparkSession, bookings: DataFrame, listings: DataFrame, warehouse: str) -> None:
    """Replace the four tables from the historical inputs; safe to run again."""
    require_rates(bookings)
    for name, df, partition_by in (
        (BOOKINGS_NAME, bookings, None),
        # The historical cancellation rows have arrival year 0, the price rows their own.
        (CANCEL_NAME, to_warehouse_names(historical_cancel(bookings)), None),
        (PRICE_NAME, to_warehouse_names(historical_price(bookings)), ["arrival_date_year"]),
        (LISTINGS_NAME, clean_listings(listings), None),
    ):
        Table(spark, warehouse, name).overwrite(df, partition_by)


def batch_etl_from_csv(
    spark: SparkSession, bookings_path: str, listings_path: str, warehouse: str, bookings_schema,
) -> None:
    batch_etl(spark, read_csv(spark, bookings_path, bookings_schema),
              read_csv(spark, listings_path, LISTINGS), warehouse)


def monthly_etl(
    spark: SparkSession, path: str, batch_id: int, warehouse: str, store: ModelStore,
    writer: str = "files",
) -> None:
    """Load one monthly CSV directly, scored by the current champions.

    Also the way to replay a month whose messages never arrived: the same batch
    id replaces what an earlier attempt of this writer wrote, never what a
    stream wrote.
    """
    append_month(
        read_csv(spark, path, MONTHLY), batch_id, writer, warehouse,
        price_scorer(store.load(PRICE_MODEL)), cancel_scorer(store.load(CANCEL_MODEL)))


def _fit(name: str, train: DataFrame, predictors: list[str], label: str, regression: bool, sizes: dict):
    if name == "knn":
        rows = train.select("Booking_ID", label, feature_array(predictors).alias("features"))
        if (bound := sizes.get("knn_rows")) is not None:
            rows = rows.orderBy(F.xxhash64("Booking_ID"), "Booking_ID").limit(bound)
        return fit_knn(rows, "Booking_ID", "features", label)
    preset = regressor if regression else classifier
    return preset(name, predictors, label, **{k: v for k, v in sizes.items() if k != "knn_rows"}).fit(train)


def _contest(
    df: DataFrame, names: list[str], predictors: list[str], label: str, regression: bool, sizes: dict,
    partitions: int | None,
) -> tuple[DataFrame, dict]:
    """Fit every candidate on the training rows and score the hold-out."""
    ensure_checkpoint_dir(df.sparkSession)
    train, test = train_test_split(df, "Booking_ID")
    train = spread(train, "Booking_ID", partitions).persist(StorageLevel.MEMORY_AND_DISK)
    test = test.persist(StorageLevel.MEMORY_AND_DISK)
    metric = "r2" if regression else "accuracy"
    try:
        models, scores = {}, []
        for ordinal, name in enumerate(names):
            models[name] = _fit(name, train, predictors, label, regression, sizes)
            scored = predictions(models[name], test, predictors)
            measure = regression_metrics if regression else classification_metrics
            scores.append((ordinal, name, measure(scored, label, "prediction").first()[metric]))
    finally:
        train.unpersist()
        test.unpersist()
    board = df.sparkSession.createDataFrame(scores, f"ordinal int, candidate string, {metric} double")
    return board, models


def retrain(
    spark: SparkSession, warehouse: str, store: ModelStore, year: int, quarter: int,
    scope: str = "all", price_candidates: list[str] = PRICE_CANDIDATES,
    cancel_candidates: list[str] = CANCEL_CANDIDATES, partitions: int | None = None, **sizes: int,
) -> dict[str, Champion]:
    """Fit the candidates on the feature tables and promote the best of each.

    scope 'all' trains on everything stored so far, 'quarter' on the price rows
    of that quarter and on the cancellation rows scored since the batch load
    (whose arrival year is 0, so it never matches a year). partitions deals the
    training rows anew, for inputs of few files or for models that are the same
    on every cluster. sizes are those of the presets, and knn_rows: the number
    of labelled rows, by hash order, that a neighbour model is fitted on.
    """
    if scope not in ("all", "quarter"):
        raise ValueError(f"unknown scope {scope}")
    promoted = {}
    for model, table, names, predictors, label, regression in (
        (PRICE_MODEL, PRICE_NAME, price_candidates, PRICE_PREDICTORS, "adr", True),
        (CANCEL_MODEL, CANCEL_NAME, cancel_candidates, CANCEL_PREDICTORS, "is_canceled", False),
    ):
        df = from_warehouse_names(Table(spark, warehouse, table).scan())
        if scope == "quarter":
            df = quarter_slice(df, quarter, year)
        board, models = _contest(df, names, predictors, label, regression, sizes, partitions)
        metric = "r2" if regression else "accuracy"
        winner = champion(board, metric).first()
        promoted[model] = store.promote(model, winner["candidate"], models[winner["candidate"]], winner[metric])
    return promoted
