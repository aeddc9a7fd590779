"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator.

Each runs over the whole tables. The SQL counterparts are in oracles.py.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innlake import session
from innlake.functions import scalars
from innlake.learners import adaboost, bayesian_ridge, boosting, knn, presets, scoring
from innlake.learners.store import ModelStore
from innlake.operators import (
    cleaning, conform, encoding, evaluation, frames, profiling, scaling, splitting, target_stats,
)
from innlake.plans import jobs
from innlake.schemas import (
    BOOKINGS, CANCEL_INPUTS, CANCEL_PREDICTORS, CANCEL_TABLE, CANCEL_UNUSED, MARKET_SEGMENTS,
    MEALS, MONTHLY, NUMERIC_FEATURES, ONE_HOT, PRICE_INPUTS, PRICE_PREDICTORS,
    PRICE_TABLE, PRICE_UNUSED, VOCABULARY, indicator, struct,
)
from innlake.sources import booking_views as views
from innlake.sources import csv_files, message_log, messages
from innlake.sources.tables import Table
from innlake.streaming import frame_state, ingest

Query = Callable[[SparkSession, str], DataFrame]

QUARTER, YEAR = 3, 1997
CATEGORICAL = list(VOCABULARY)
# Segments whose indicators feed the principal components.
PCA_COLUMNS = [indicator("market_segment", s) for s in ("Direct", "Groups", "Offline TA/TO", "Online TA")]
# The published sizes: boosting rounds, trees, boosts of AdaBoost.
ROUNDS, TREES, BOOSTS = 100, 100, 50
BANDS = len(scalars.RATE_EDGES) - 1
# Training rows are dealt to as many partitions everywhere, so models don't depend on the cluster; to more if there are many rows.
PARTITIONS = 8


def _price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.historical_price(views.bookings(spark, sf_dir))


def _cancel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.historical_cancel(views.bookings(spark, sf_dir))


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})


# --- projection, cast, fill ---------------------------------------------------

def price_select(spark, sf):
    return views.bookings(spark, sf).select(*PRICE_INPUTS)


def cancel_select(spark, sf):
    return views.bookings(spark, sf).select(*CANCEL_INPUTS)


def drop_unused(spark, sf):
    return views.bookings(spark, sf).drop(*CANCEL_UNUSED)


def price_preparation(spark, sf):
    """City hotel only, without the columns that price models discard."""
    return views.bookings(spark, sf).filter(F.col("hotel") == "City Hotel").drop(*PRICE_UNUSED)


def rename_columns(spark, sf):
    return conform.to_warehouse_names(_price(spark, sf))


def cast_ints(spark, sf):
    return views.bookings(spark, sf).select(
        "Booking_ID", F.col("adr").cast("int").alias("adr_int"),
        F.col("arrival_month").cast("int").alias("arrival_month_int"),
        F.coalesce(F.col("children"), F.lit(0)).cast("int").alias("children_int"))


def booking_id_parse(spark, sf):
    feed = views.monthly_bookings(spark, sf)
    return feed.select("Booking_ID", scalars.booking_number(F.col("Booking_ID")).alias("booking_number"))


def conform_unknown(spark, sf):
    return conform.historical_cancel(views.bookings(spark, sf), keep_unknown=True)


def monthly_price(spark, sf):
    return conform.monthly_price(views.monthly_bookings(spark, sf))


def monthly_cancel(spark, sf):
    return conform.monthly_cancel(views.monthly_bookings(spark, sf))


def fill_missing(spark, sf):
    return cleaning.fill_missing(views.bookings(spark, sf).select("Booking_ID", "children", "country"))


def presence_labels(spark, sf):
    return cleaning.label_presence(views.bookings(spark, sf).select("Booking_ID", "agent", "company"))


def recode_meal(spark, sf):
    return cleaning.recode_meal(views.bookings(spark, sf).select("Booking_ID", "meal"))


def clamp_parking(spark, sf):
    name = "required_car_parking_spaces"
    return cleaning.clamp_parking(views.bookings(spark, sf).select("Booking_ID", name))


# --- filters ------------------------------------------------------------------

def adr_range_filter(spark, sf):
    return cleaning.keep_rate_range(views.bookings(spark, sf).select("Booking_ID", "adr"))


def listing_clean(spark, sf):
    return cleaning.clean_listings(views.listings(spark, sf))


def split_by_value(spark, sf):
    rows = views.bookings(spark, sf).select("Booking_ID", "hotel", "adr")
    parts = cleaning.split_by_value(rows, "hotel", ["Resort Hotel", "City Hotel"])
    resort, city = (part.withColumn("subset", F.lit(name)) for name, part in parts.items())
    return resort.unionByName(city).drop("hotel")


def quarter_slice_literal(spark, sf):
    return splitting.quarter_slice_literal(_price(spark, sf), QUARTER, YEAR)


def quarter_slice(spark, sf):
    return splitting.quarter_slice(_price(spark, sf), QUARTER, YEAR)


# --- scalars ------------------------------------------------------------------

def adr_round(spark, sf):
    return cleaning.round_rate(adr_range_filter(spark, sf))


def adr_category(spark, sf):
    return adr_round(spark, sf).withColumn("adr_category", scalars.rate_category(F.col("adr")))


def _month_number() -> Column:
    return F.col("arrival_month").cast("int")


def quarter_months(spark, sf):
    quarter = F.ceil(_month_number() / 3).cast("int")
    return (views.bookings(spark, sf).select("Booking_ID", quarter.alias("quarter"))
            .withColumn("months", F.array_join(scalars.quarter_months(F.col("quarter")), ",")))


def period_parse(spark, sf):
    labels = views.bookings(spark, sf).select(
        "Booking_ID",
        F.concat("arrival_date_year", F.lit("-"), "arrival_month", F.lit(".csv")).alias("month_label"),
        F.concat(F.lit("Q"), F.ceil(_month_number() / 3), "arrival_date_year").alias("quarter_label"))
    month_year, month = scalars.month_period(F.col("month_label"))
    quarter_year, quarter = scalars.quarter_period(F.col("quarter_label"))
    return labels.withColumns({
        "month_year": month_year, "month": month, "quarter_year": quarter_year, "quarter": quarter})


def month_rollover(spark, sf):
    following = scalars.next_month(F.col("arrival_date_year"), _month_number())
    return views.bookings(spark, sf).select(
        "Booking_ID", F.year(following).alias("next_year"), F.month(following).alias("next_month"))


# --- encoding -----------------------------------------------------------------

def _onehot(column: str) -> Query:
    def query(spark, sf):
        return encoding.one_hot(views.bookings(spark, sf).select("Booking_ID", column))
    return query


def onehot_dynamic(spark, sf):
    rows = views.bookings(spark, sf).select("Booking_ID", *CATEGORICAL)
    return encoding.one_hot_observed(rows, CATEGORICAL)


def unknown_levels(spark, sf):
    return encoding.unknown_levels(views.bookings(spark, sf))


def ordinal_meal(spark, sf):
    return views.bookings(spark, sf).select(
        "Booking_ID", "meal", encoding.ordinal(F.col("meal"), MEALS).alias("meal_index"))


# --- profiles -----------------------------------------------------------------

def null_profile(spark, sf):
    return profiling.null_profile(views.bookings(spark, sf))


def describe_numeric(spark, sf):
    summary = profiling.describe_numeric(views.bookings(spark, sf), NUMERIC_FEATURES)
    return _rounded(summary, "mean", "std", "min", "q25", "q50", "q75", "max")


def max_profile(spark, sf):
    return profiling.max_profile(adr_category(spark, sf), ["adr", "adr_category"])


def variance_profile(spark, sf):
    return _rounded(profiling.variance_profile(views.bookings(spark, sf), NUMERIC_FEATURES), "variance")


def corr_matrix(spark, sf):
    return _rounded(profiling.corr_matrix(_price(spark, sf), NUMERIC_FEATURES), "corr")


def corr_rank(spark, sf):
    ranked = profiling.corr_rank(_price(spark, sf), "adr", NUMERIC_FEATURES + ONE_HOT)
    return _rounded(ranked, "abs_corr")


def distinct_values(spark, sf):
    return profiling.distinct_values(views.bookings(spark, sf), [*CATEGORICAL, "is_repeated_guest"])


def shape_report(spark, sf):
    return profiling.shape_report(views.bookings(spark, sf))


def iqr_outliers(spark, sf):
    columns = ["adr", "lead_time"]
    rows = views.bookings(spark, sf).select(*columns)
    found = profiling.staged_iqr_outliers(rows, columns, {"raw": F.lit(True), "in range": cleaning.in_rate_range()})
    return _rounded(found, "q1", "median", "q3", "whisker_low", "whisker_high")


# --- sort, union --------------------------------------------------------------

def head_preview(spark, sf):
    return views.bookings(spark, sf).orderBy("Booking_ID").limit(5)


def union_by_name(spark, sf):
    rows = views.bookings(spark, sf)
    parts = cleaning.split_by_value(rows, "hotel", ["Resort Hotel", "City Hotel"])
    resort = parts["Resort Hotel"].select("Booking_ID", "adr", "is_canceled")
    city = parts["City Hotel"].select("children", "Booking_ID", "adr")
    return resort.unionByName(city, allowMissingColumns=True)


# --- split, scale, evaluate ---------------------------------------------------

def train_test_split(spark, sf):
    rows = views.bookings(spark, sf).select("Booking_ID")
    train, test = splitting.train_test_split(rows, "Booking_ID")
    return (train.withColumn("part", F.lit("train"))
            .unionByName(test.withColumn("part", F.lit("test"))))


def scale_numeric(spark, sf):
    rows = cleaning.fill_missing(views.bookings(spark, sf).select("Booking_ID", *NUMERIC_FEATURES))
    return _rounded(scaling.apply_scaler(rows, scaling.fit_scaler(rows, NUMERIC_FEATURES)), *NUMERIC_FEATURES)


def _baselines(train: DataFrame) -> dict[str, Column]:
    """Closed-form rate predictions: means of the training rows (one aggregate
    row) and fixed formulas. The last one repeats an earlier one, to tie."""
    segments = [F.col(f"`{indicator('market_segment', s)}`") for s in MARKET_SEGMENTS]
    means = train.agg(F.avg("adr"), *[F.avg(F.when(s == 1, F.col("adr"))) for s in segments]).first()
    overall, per_segment = means[0], means[1:]
    by_segment = F.lit(overall)
    for flag, mean in zip(segments, per_segment):
        by_segment = F.when(flag == 1, F.lit(mean)).otherwise(by_segment)
    formula = 50.0 * F.col("adults") + 0.25 * F.col("lead_time") + 30.0
    return {
        "global_mean": F.lit(overall), "segment_mean": by_segment,
        "adults_lead_formula": formula, "lead_formula": 0.25 * F.col("lead_time") + 150.0,
        "adults_lead_formula_again": formula,
    }


def model_leaderboard(spark, sf):
    train, test = splitting.train_test_split(_price(spark, sf), "Booking_ID")
    board = evaluation.leaderboard(test, "adr", _baselines(train))
    return _rounded(board, "mse", "r2").orderBy(F.desc("r2"), "ordinal")


def champion_select(spark, sf):
    train, test = splitting.train_test_split(_price(spark, sf), "Booking_ID")
    board = evaluation.leaderboard(test, "adr", _baselines(train))
    return _rounded(evaluation.champion(board, "r2"), "mse", "r2")


def regression_metrics(spark, sf):
    _, test = splitting.train_test_split(_price(spark, sf), "Booking_ID")
    scored = test.withColumn("prediction", 50.0 * F.col("adults") + 0.25 * F.col("lead_time") + 30.0)
    return _rounded(evaluation.regression_metrics(scored, "adr", "prediction"), "mse", "rmse", "r2")


def classification_metrics(spark, sf):
    _, test = splitting.train_test_split(_cancel(spark, sf), "Booking_ID")
    scored = test.withColumn("prediction", (F.col("lead_time") > 220).cast("int"))
    return _rounded(
        evaluation.classification_metrics(scored, "is_canceled", "prediction"), "accuracy", "label_rmse")


def knn_classify(spark, sf):
    vectors = views.read_table(spark, sf, "embeddings")
    train, test = splitting.train_test_split(vectors, "vec_id")
    model = knn.fit_knn(train, "vec_id", "embedding", "label")
    queries = test.withColumn("embedding", F.col("embedding").cast("array<double>"))
    return model.classify(queries, "vec_id", "embedding")


# --- sources, sinks, stream ---------------------------------------------------

def csv_roundtrip(spark, sf):
    path = session.scratch_path(spark, "csv")
    csv_files.write_csv(views.bookings(spark, sf), path)
    return csv_files.read_csv(spark, path, BOOKINGS)


def csv_parse_lines(spark, sf):
    return csv_files.parse_csv_lines(views.booking_lines(spark, sf), "value", MONTHLY)


def csv_quoted_lines(spark, sf):
    """Notes with line breaks, quotes and commas, written as CSV, cut into lines, and read back from these."""
    notes = views.bookings(spark, sf).select(
        "Booking_ID", F.concat_ws("\n", "hotel", F.concat(F.lit('"'), "meal", F.lit('", said')), F.lit(""), "country").alias("note"))
    text = csv_files.once(notes, F.col("Booking_ID"), csv_files.csv_line(["Booking_ID", "note"]).alias("text"))
    lines = text.select((F.col("Booking_ID") % 4).alias("part"), "Booking_ID", F.posexplode(F.split("text", "\n")).alias("i", "line")) \
        .select("part", (F.col("Booking_ID") * 8 + F.col("i")).alias("at"), "line")
    records = csv_files.join_quoted_lines(lines, "line", "at", ["part"], block_span=5000)
    return csv_files.parse_csv_lines(records.select("line"), "line", struct({"Booking_ID": "bigint", "note": "string"}))


def message_encode(spark, sf):
    encoded = messages.encode_values(views.booking_messages(spark, sf))
    return messages.decode_values(encoded)


def load_overwrite(spark, sf):
    """The second load replaces content and schema of the first."""
    table = Table(spark, session.scratch_path(spark, "overwrite"), ingest.PRICE_NAME)
    table.overwrite(views.bookings(spark, sf).select("Booking_ID", "adr"))
    table.overwrite(conform.to_warehouse_names(_price(spark, sf)))
    return table.scan()


def load_append(spark, sf):
    """Historical rows plus two appended batches with shuffled column order;
    the second batch is delivered twice."""
    table = Table(spark, session.scratch_path(spark, "append"), ingest.PRICE_NAME)
    table.overwrite(conform.to_warehouse_names(_price(spark, sf)))
    feed = conform.to_warehouse_names(monthly_price(spark, sf))
    reordered = feed.select(*reversed(feed.columns))
    table.append(reordered.filter(F.col("arrival_date_year") <= YEAR), 1, "feed")
    for _ in range(2):
        table.append(reordered.filter(F.col("arrival_date_year") > YEAR), 2, "feed")
    return table.scan()


def append_writers(spark, sf):
    """A stream, a replay and a second stream append under the same batch ids, each of them twice."""
    table = Table(spark, session.scratch_path(spark, "writers"), ingest.PRICE_NAME)
    table.overwrite(conform.to_warehouse_names(_price(spark, sf)))
    feed = conform.to_warehouse_names(monthly_price(spark, sf))
    for _ in range(2):
        for i, writer in enumerate(("stream-a", "files", "stream-b")):
            part = feed.filter(F.col("arrival_date_year") % 3 == i)
            table.append(part.filter("lead_time < 200"), 1, writer)
            table.append(part.filter("lead_time >= 200"), 2, writer)
    return table.scan()


def scan_all(spark, sf):
    table = Table(spark, session.scratch_path(spark, "scan"), ingest.CANCEL_NAME)
    table.overwrite(conform.to_warehouse_names(_cancel(spark, sf)))
    return conform.from_warehouse_names(table.scan())


def frame_messages(spark, sf):
    return frames.frame_messages(views.event_messages(spark, sf))


def frame_messages_unreset(spark, sf):
    return frames.frame_messages(views.event_messages(spark, sf), strict=False)


def _event_buckets(unit: str) -> Query:
    def query(spark, sf):
        start = F.date_trunc(unit, F.col("ts")).cast("date")
        return (views.read_table(spark, sf, "events").groupBy(start.alias("period_start"))
                .agg(F.count("*").alias("n_events"), F.round(F.sum("value"), 4).alias("total_value")))
    return query


#: A message that is no booking, with a comma inside quotes.
_BAD_BOOKING = {"Booking_ID": "INN0", "adults": "two", "market_segment": '"Online, TA"', "adr": "99.5"}


def _ingested(spark, sf, fmt: str = "parquet") -> str:
    """The booking log replayed in two drops, cut in the middle of two months, with a bad message a month.

    Each drop runs one availableNow micro-batch on the same checkpoint, so
    frames are carried across batches and restarts. Returns the warehouse.
    """
    root = session.scratch_path(spark, "stream")
    warehouse, source = f"{root}/warehouse", f"{root}/messages"
    for name, template in ((ingest.PRICE_NAME, PRICE_TABLE), (ingest.CANCEL_NAME, CANCEL_TABLE)):
        empty = conform.to_warehouse_names(conform.conform(spark.createDataFrame([], MONTHLY), template))
        Table(spark, warehouse, name).create(empty.schema)

    def price(df):
        return df.withColumn("predicted", 50.0 * F.col("adults") + 0.25 * F.col("lead_time") + 30.0)

    def cancel(df):
        return df.withColumn("predicted", (F.col("lead_time") > 220).cast("int"))

    log = views.booking_messages(spark, sf)
    bad = log.filter(F.col("value") == frames.START).withColumns({
        "offset": F.col("offset") + 3, "value": F.lit(",".join(_BAD_BOOKING.get(c, "") for c in MONTHLY.names))})
    log = log.unionByName(bad).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        cut = F.col("offset") >= (YEAR * 12 + 6) * views.MONTH_SPAN + 500
        other_cut = F.col("offset") >= (YEAR * 12 + 5) * views.MONTH_SPAN + 500
        later = F.when(F.col("partition") == 0, cut).otherwise(other_cut)
        for drop in (~later, later):
            messages.write_messages(log.filter(drop), fmt, path=source)
            stream = messages.message_stream(spark, fmt, path=source)
            ingest.start_ingest(stream, root, warehouse, price, cancel).awaitTermination()
    finally:
        log.unpersist()
    return warehouse


def stream_ingest(spark, sf):
    return conform.from_warehouse_names(Table(spark, _ingested(spark, sf), ingest.PRICE_NAME).scan())


def log_ingest(spark, sf):
    """The same from a log that is read by offsets."""
    return conform.from_warehouse_names(Table(spark, _ingested(spark, sf, message_log.FORMAT), ingest.PRICE_NAME).scan())


def stateful_frames(spark, sf):
    """Frames of the event log, which arrives in three parts; what is open waits in the stream's state."""
    root = session.scratch_path(spark, "frames")
    log = views.event_messages(spark, sf)
    ends = log.agg(F.max("offset")).first()[0] or 0
    for part in range(3):
        low, high = (ends + 1) * part // 3, (ends + 1) * (part + 1) // 3
        messages.write_messages(log.filter((F.col("offset") >= low) & (F.col("offset") < high)), message_log.FORMAT, path=f"{root}/log")
        stream = messages.message_stream(spark, message_log.FORMAT, path=f"{root}/log")
        with frame_state.rocks_store(spark):
            frame_state.stateful_frames(stream).writeStream.format("parquet").option("path", f"{root}/frames") \
                .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/frames").drop("closed")


def stream_ingest_cancel(spark, sf):
    return conform.from_warehouse_names(Table(spark, _ingested(spark, sf), ingest.CANCEL_NAME).scan())


def stream_rejected(spark, sf):
    """What the stream set apart: one bad message a month, and nothing stopped."""
    found = Table(spark, _ingested(spark, sf), ingest.REJECTED_NAME).scan()
    return found.groupBy("line", "reason", "market_segment").agg(F.count("*").alias("n_rows"))


# --- learners: facts about the hold-out that SQL can state --------------------

def _price_parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    return splitting.train_test_split(_price(spark, sf), "Booking_ID")


def _band_parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Bands as labels 0 to 13: no learner meets a class without rows."""
    bands = _price(spark, sf).withColumn("adr_category", scalars.rate_category(F.col("adr")) - 1)
    return splitting.train_test_split(bands, "Booking_ID")


def _cancel_parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    return splitting.train_test_split(_cancel(spark, sf), "Booking_ID")


@contextmanager
def _held(df: DataFrame) -> Iterator[DataFrame]:
    """The rows dealt to partitions by their number alone and kept for repeated reading.

    Boosting cuts its own lineage when a checkpoint folder is set.
    """
    session.ensure_checkpoint_dir(df.sparkSession)
    held = session.spread(df, "Booking_ID", PARTITIONS).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def _fitted(estimator, train: DataFrame, predictors: list[str], label: str):
    """Training rows are read many times, so they are held while fitting."""
    with _held(train.select("Booking_ID", *predictors, label)) as rows:
        return estimator.fit(rows)


def _regression_report(name: str, train: DataFrame, scored: DataFrame) -> DataFrame:
    return evaluation.regression_facts(train, scored, "adr", "prediction").withColumn("model", F.lit(name))


def _regression(name: str) -> Query:
    def query(spark, sf):
        train, test = _price_parts(spark, sf)
        model = _fitted(presets.regressor(name, PRICE_PREDICTORS, "adr", rounds=ROUNDS, trees=TREES), train, PRICE_PREDICTORS, "adr")
        return _regression_report(name, train, model.transform(test))
    return query


def reg_linear(spark, sf):
    """Also the normal equations: the mean of residual times feature, the largest of all features, is 0."""
    train, test = _price_parts(spark, sf)
    model = _fitted(presets.regressor("linear", PRICE_PREDICTORS, "adr"), train, PRICE_PREDICTORS, "adr")
    residual = F.col("adr") - F.col("prediction")
    normal = model.transform(train).agg(F.round(F.greatest(
        F.abs(F.avg(residual)), *[F.abs(F.avg(residual * F.col(f"`{c}`"))) for c in PRICE_PREDICTORS]), 3).alias("normal_residual"))
    return _regression_report("linear", train, model.transform(test)).crossJoin(F.broadcast(normal))  # one row


def reg_bayesian_ridge(spark, sf):
    train, test = _price_parts(spark, sf)
    with _held(train.select("Booking_ID", *PRICE_PREDICTORS, "adr")) as rows:
        model = bayesian_ridge.fit_bayesian_ridge(rows, PRICE_PREDICTORS, "adr")
    return _regression_report("bayesian_ridge", train, model.transform(test))


def _class_report(name: str, target: str, train: DataFrame, scored: DataFrame) -> DataFrame:
    return evaluation.classification_facts(train, scored, target, "prediction").withColumns(
        {"model": F.lit(name), "target": F.lit(target)})


def _cancel_class(name: str) -> Query:
    def query(spark, sf):
        train, test = _cancel_parts(spark, sf)
        model = _fitted(presets.classifier(name, CANCEL_PREDICTORS, "is_canceled", rounds=ROUNDS, trees=TREES),
                        train, CANCEL_PREDICTORS, "is_canceled")
        return _class_report(name, "is_canceled", train, model.transform(test))
    return query


def _band_class(name: str) -> Query:
    def query(spark, sf):
        train, test = _band_parts(spark, sf)
        model = _fitted(presets.classifier(name, PRICE_PREDICTORS, "adr_category", rounds=ROUNDS, trees=TREES, classes=BANDS),
                        train, PRICE_PREDICTORS, "adr_category")
        return _class_report(name, "adr_category", train, model.transform(test))
    return query


def _both_targets(name: str) -> Query:
    def query(spark, sf):
        return _cancel_class(name)(spark, sf).unionByName(_band_class(name)(spark, sf))
    return query


def _stump(parts, predictors: list[str], label: str, loss: str) -> Query:
    """The first round of second-order boosting, cut to one split: where it cuts and the weights of its two leaves."""
    def query(spark, sf):
        train, _ = parts(spark, sf)
        growth = boosting.Growth(loss=loss, rounds=1, rate=0.3, max_depth=1, l2=1.0, min_hessian=1.0, bins=2000)
        with _held(train.select("Booking_ID", *predictors, label)) as rows:
            model = boosting.BoostedTrees(predictors, label, growth).fit(rows)
        tree = model.trees[0][0]
        feature, (left, right) = tree.feature[0], tree.value[1:]
        edge = float(model.edges[feature][tree.cut[0] - 1])
        row = (predictors[feature], edge, round(float(model.start[0]), 6), round(left, 6), round(right, 6))
        return spark.createDataFrame([row], "feature string, threshold double, start double, left_value double, right_value double")
    return query


def target_encode(spark, sf):
    """Categories as the share of cancellations among earlier bookings, in the order of a hash of the id."""
    rows = views.bookings(spark, sf).select("Booking_ID", *CATEGORICAL, "country", "is_canceled")
    names = [*CATEGORICAL, "country"]
    found = target_stats.ordered_means(rows, "Booking_ID", names, "is_canceled")
    return _rounded(found, *map(target_stats.target_name, names), digits=9)


def cls_adaboost(spark, sf):
    """Stumps for cancellations, trees without a depth bound for rate bands."""
    reports = []
    for parts, predictors, label, classes, depth in (
        (_cancel_parts, CANCEL_PREDICTORS, "is_canceled", 2, 1),
        (_band_parts, PRICE_PREDICTORS, "adr_category", BANDS, presets.UNBOUNDED),
    ):
        train, test = parts(spark, sf)
        model = _fitted(adaboost.AdaBoost(predictors, label, classes, BOOSTS, depth), train, predictors, label)
        reports.append(_class_report("adaboost", label, train, model.transform(test)))
    return reports[0].unionByName(reports[1])


def _knn(parts, predictors: list[str], label: str) -> Query:
    def query(spark, sf):
        train, test = parts(spark, sf)
        rows = train.select("Booking_ID", label, knn.feature_array(predictors).alias("features"))
        model = knn.fit_knn(session.spread(rows, "Booking_ID", PARTITIONS), "Booking_ID", "features", label)
        scored = scoring.predictions(model, session.spread(test, "Booking_ID", PARTITIONS), predictors)
        return _class_report("knn", label, train, scored)
    return query


def pca_scores(spark, sf):
    """All components of the scores: centred, uncorrelated, with the columns' total variance."""
    rows = _price(spark, sf).select("Booking_ID", *PCA_COLUMNS)
    with _held(rows) as held:
        model = scaling.fit_pca(held, PCA_COLUMNS, k=len(PCA_COLUMNS))
    scores = vector_to_array("pca_scores")
    names = [f"pc{i}" for i in range(len(PCA_COLUMNS))]
    wide = model.transform(rows).select(*[scores[i].alias(n) for i, n in enumerate(names)])
    pairs = [(x, y) for i, x in enumerate(names) for y in names[:i]]
    return wide.agg(
        F.count("*").alias("n_rows"),
        F.round(F.greatest(*[F.abs(F.avg(n)) for n in names]), 6).alias("largest_mean"),
        F.round(F.greatest(*[F.abs(F.covar_samp(x, y)) for x, y in pairs]), 6).alias("largest_covariance"),
        F.round(sum((F.var_samp(n) for n in names), F.lit(0.0)), 6).alias("total_variance"))


def pca_variance(spark, sf):
    """Ratios sum to 1; the eigenvalues' squares are the squared norm of the correlation matrix."""
    with _held(_price(spark, sf).select("Booking_ID", *PCA_COLUMNS)) as rows:
        model = scaling.fit_pca(rows, PCA_COLUMNS, k=len(PCA_COLUMNS), unit_variance=True)
    ratios = model.stages[-1].explainedVariance.toArray().tolist()
    frame = spark.createDataFrame([(r,) for r in ratios], "ratio double")
    return frame.agg(F.count("*").alias("n_components"), F.round(F.sum("ratio"), 6).alias("ratio_sum"),
                     F.round(F.sum((F.col("ratio") * len(PCA_COLUMNS)) ** 2), 6).alias("squared_norm"))


def _score_report(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count("*").alias("n_rows"), F.count("predicted").alias("n_scored"),
                      F.round(F.sum(F.col("adr").cast("double")), 4).alias("total_adr"))


def score_price(spark, sf):
    """Monthly rows that the model wasn't trained on, scored."""
    train, _ = _price_parts(spark, sf)
    model = _fitted(presets.regressor("linear", PRICE_PREDICTORS, "adr"), train, PRICE_PREDICTORS, "adr")
    _, test = splitting.train_test_split(monthly_price(spark, sf), "Booking_ID")
    return _score_report(scoring.price_scorer(model)(test))


def score_cancel(spark, sf):
    """The same for cancellations; a prediction that is no class counts as missing."""
    train, _ = _cancel_parts(spark, sf)
    model = _fitted(
        presets.classifier("logistic", CANCEL_PREDICTORS, "is_canceled"), train, CANCEL_PREDICTORS, "is_canceled")
    _, test = splitting.train_test_split(monthly_cancel(spark, sf), "Booking_ID")
    scored = scoring.cancel_scorer(model)(test)
    return _score_report(scored.withColumn("predicted", F.when(F.col("predicted").isin(0, 1), F.col("predicted"))))


def retrain_champion(spark, sf):
    """Fit, rank, promote and reload on stored tables: whether the promoted model is the board's best, and how
    many hold-out rows the reloaded one scores otherwise than a fit of its own candidate."""
    root = session.scratch_path(spark, "retrain")
    Table(spark, root, ingest.PRICE_NAME).overwrite(conform.to_warehouse_names(_price(spark, sf)))
    Table(spark, root, ingest.CANCEL_NAME).overwrite(conform.to_warehouse_names(_cancel(spark, sf)))
    store = ModelStore(spark, f"{root}/models")
    names = {"price": ["linear", "elastic_net"], "cancel": ["logistic", "logistic_scaled"]}
    promoted = jobs.retrain(spark, root, store, YEAR, QUARTER, price_candidates=names["price"],
                            cancel_candidates=names["cancel"], partitions=PARTITIONS)
    reports = []
    for target, parts, predictors, label, preset, metric in (
        ("price", _price_parts, PRICE_PREDICTORS, "adr", presets.regressor, evaluation.regression_metrics),
        ("cancel", _cancel_parts, CANCEL_PREDICTORS, "is_canceled", presets.classifier, evaluation.classification_metrics),
    ):
        train, test = parts(spark, sf)
        key = "r2" if target == "price" else "accuracy"
        board = {}
        for name in names[target]:
            scored = _fitted(preset(name, predictors, label), train, predictors, label).transform(test)
            board[name] = metric(scored, label, "prediction").first()[key]
            if name == promoted[target].candidate:
                again = scored.select("Booking_ID", F.col("prediction").alias("fitted"))
        loaded = store.load(target).transform(test).select("Booking_ID", F.col("prediction").alias("loaded"))
        best = abs(max(board.values()) - promoted[target].metric) < 1e-9
        reports.append(loaded.join(again, "Booking_ID").agg(
            F.lit(target).alias("target"), F.count("*").alias("n_rows"), F.lit(best).alias("best_promoted"),
            F.count_if(F.abs(F.col("loaded") - F.col("fitted")) > 1e-6).alias("n_different")))
    return reports[0].unionByName(reports[1])


def model_roundtrip(spark, sf):
    """Hold-out rows, and how many a reloaded model predicts differently."""
    train, test = _price_parts(spark, sf)
    model = _fitted(presets.regressor("linear", PRICE_PREDICTORS, "adr"), train, PRICE_PREDICTORS, "adr")
    path = session.scratch_path(spark, "model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    first = model.transform(test).withColumnRenamed("prediction", "saved").drop(presets.FEATURES)
    return loaded.transform(first).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("saved") != F.col("prediction")).alias("n_different"))


QUERIES: dict[str, Query] = {
    "price_select": price_select, "cancel_select": cancel_select, "drop_unused": drop_unused,
    "price_preparation": price_preparation,
    "rename_columns": rename_columns, "cast_ints": cast_ints, "booking_id_parse": booking_id_parse,
    "conform_price": _price, "conform_cancel": _cancel, "conform_unknown": conform_unknown,
    "monthly_price": monthly_price, "monthly_cancel": monthly_cancel,
    "eda_passthrough": views.bookings, "fill_missing": fill_missing,
    "presence_labels": presence_labels, "recode_meal": recode_meal, "clamp_parking": clamp_parking,
    "adr_range_filter": adr_range_filter, "listing_clean": listing_clean,
    "split_by_value": split_by_value, "quarter_slice_literal": quarter_slice_literal,
    "quarter_slice": quarter_slice, "adr_round": adr_round, "adr_category": adr_category,
    "quarter_months": quarter_months, "period_parse": period_parse, "month_rollover": month_rollover,
    "onehot_segment": _onehot("market_segment"), "onehot_month": _onehot("arrival_date_month"),
    "onehot_meal": _onehot("meal"), "onehot_room": _onehot("reserved_room_type"),
    "onehot_dynamic": onehot_dynamic, "unknown_levels": unknown_levels, "ordinal_meal": ordinal_meal,
    "null_profile": null_profile, "describe_numeric": describe_numeric, "max_profile": max_profile,
    "variance_profile": variance_profile, "corr_matrix": corr_matrix, "corr_rank": corr_rank,
    "distinct_values": distinct_values, "shape_report": shape_report, "iqr_outliers": iqr_outliers,
    "head_preview": head_preview, "union_by_name": union_by_name,
    "train_test_split": train_test_split, "scale_numeric": scale_numeric,
    "model_leaderboard": model_leaderboard, "champion_select": champion_select,
    "regression_metrics": regression_metrics, "classification_metrics": classification_metrics,
    "knn_classify": knn_classify, "csv_roundtrip": csv_roundtrip, "csv_parse_lines": csv_parse_lines,
    "csv_quoted_lines": csv_quoted_lines,
    "message_encode": message_encode, "load_overwrite": load_overwrite, "load_append": load_append,
    "append_writers": append_writers,
    "scan_all": scan_all, "frame_messages": frame_messages,
    "frame_messages_unreset": frame_messages_unreset,
    "monthly_buckets": _event_buckets("month"), "quarterly_buckets": _event_buckets("quarter"),
    "stream_ingest": stream_ingest, "log_ingest": log_ingest, "stateful_frames": stateful_frames, "stream_ingest_cancel": stream_ingest_cancel, "stream_rejected": stream_rejected,
    "pca_scores": pca_scores, "pca_variance": pca_variance,
    "reg_linear": reg_linear, "reg_elastic_net": _regression("elastic_net"),
    "reg_random_forest": _regression("random_forest"), "reg_gbt": _regression("gbt"),
    "reg_gbt_deep": _regression("gbt_deep"), "reg_gbt_subsample": _regression("gbt_subsample"),
    "reg_gbt_indexed": _regression("gbt_indexed"), "reg_bayesian_ridge": reg_bayesian_ridge,
    "cls_logistic": _both_targets("logistic"), "cls_logistic_scaled": _cancel_class("logistic_scaled"),
    "cls_decision_tree": _band_class("decision_tree"),
    "cls_random_forest": _both_targets("random_forest"),
    "cls_extra_trees": _band_class("extra_trees"),
    "cls_gbt": _cancel_class("gbt"), "cls_gbt_indexed": _cancel_class("gbt_indexed"),
    "cls_gbt_multiclass": _band_class("gbt_multiclass"), "cls_gbt_deep": _band_class("gbt_deep"),
    "reg_leafwise": _regression("leafwise"), "reg_second_order": _regression("second_order"),
    "reg_ordered": _regression("ordered"), "cls_ordered": _cancel_class("ordered"),
    "cls_leafwise_bands": _band_class("leafwise"), "target_encode": target_encode,
    "reg_second_order_stump": _stump(_price_parts, PRICE_PREDICTORS, "adr", boosting.SQUARED),
    "cls_second_order_stump": _stump(_cancel_parts, CANCEL_PREDICTORS, "is_canceled", boosting.LOGISTIC),
    "cls_adaboost": cls_adaboost, "cls_knn": _knn(_cancel_parts, CANCEL_PREDICTORS, "is_canceled"),
    "knn_classify_band": _knn(_band_parts, PRICE_PREDICTORS, "adr_category"),
    "score_price": score_price, "score_cancel": score_cancel, "model_roundtrip": model_roundtrip,
    "retrain_champion": retrain_champion,
}
