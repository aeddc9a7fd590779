"""Live ingest: frames of a message log become monthly appends.

Each micro-batch tags its messages with the block-wise frame operator and
combines them with one small state row per log partition. Rows of a frame that
is still open wait in a table, not in memory. Everything is written under the
micro-batch's id in overwrite mode, so a replayed batch gives the same files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from innlake.learners.scoring import Scorer
from innlake.operators.conform import conform, monthly_features, to_warehouse_names
from innlake.operators.frames import BLOCK_SPAN, END, START, tag_frames
from innlake.schemas import CANCEL_TABLE, MONTHLY, PRICE_TABLE
from innlake.sources.csv_files import parse_csv_messages
from innlake.sources.tables import Table

STATE = "topic string, partition int, frames_started bigint, open boolean, open_since bigint"
PENDING = "topic string, partition int, frame_id bigint, offset bigint, value string, batch_id bigint"
LOG = ["topic", "partition"]

REJECTED = T.StructType([*MONTHLY, T.StructField("line", T.StringType()), T.StructField("reason", T.StringType())])
WRITER = "writer string"

PRICE_NAME, CANCEL_NAME, REJECTED_NAME = (
    "hotel_booking_ml_price", "hotel_booking_ml_cancel", "rejected_bookings")


def append_month(
    rows: DataFrame, batch_id: int, writer: str, warehouse: str, price: Scorer, cancel: Scorer,
) -> None:
    """Clean, encode, score twice, append twice.

    Rows that can't be used are kept apart in the rejected table with the
    reason: no rate, or what the `reason` column says, if there is one; `line`
    is the message that a row came from, if any.
    """
    spark = rows.sparkSession
    rejected = Table(spark, warehouse, REJECTED_NAME)
    if not rejected.exists():
        rejected.create(REJECTED)
    for column in ("line", "reason"):
        if column not in rows.columns:
            rows = rows.withColumn(column, F.lit(None).cast("string"))
    rows = rows.withColumn("reason", F.coalesce("reason", F.when(F.col("adr").isNull(), "no rate")))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rejected.append(rows.filter("reason is not null").select(*REJECTED.names), batch_id, writer)
        shared = monthly_features(rows.filter("reason is null").select(*MONTHLY.names))
        for name, template, score in (
            (PRICE_NAME, PRICE_TABLE, price), (CANCEL_NAME, CANCEL_TABLE, cancel),
        ):
            scored = score(conform(shared, template))
            Table(spark, warehouse, name).append(to_warehouse_names(scored), batch_id, writer)
    finally:
        rows.unpersist()


class FrameAssembler:
    """Hands closed frames of a micro-batch stream to a callback."""

    def __init__(
        self, root: str, emit: Callable[[DataFrame, int], None], block_span: int = BLOCK_SPAN,
    ):
        self.root, self.emit, self.block_span = root.rstrip("/"), emit, block_span

    def _state(self, spark: SparkSession, batch_id: int) -> DataFrame:
        if batch_id < 0:
            return spark.createDataFrame([], STATE)
        return spark.read.schema(STATE).parquet(f"{self.root}/state/batch_id={batch_id}")

    def _waiting(self, spark: SparkSession, closing: DataFrame, batch_id: int) -> DataFrame | None:
        """Stored rows of the frames that the first END of this batch closes."""
        since = closing.agg(F.min("open_since")).first()[0]
        if since is None:
            return None
        # Every batch has written its folder, so they are read by name.
        folders = [f"{self.root}/pending/batch_id={i}" for i in range(since, batch_id)]
        if not folders:
            return None
        stored = spark.read.schema(PENDING).option("basePath", f"{self.root}/pending").parquet(*folders)
        return (stored.join(F.broadcast(closing.select(*LOG, "frame_id")), [*LOG, "frame_id"])
                .drop("batch_id"))

    def _expire(self, spark: SparkSession, state: DataFrame, batch_id: int) -> None:
        """Remove waiting rows and states from before any frame that is open.

        The state read is that of a batch the stream has committed, so a replay
        never asks for what goes here.
        """
        since = state.agg(F.min("open_since")).first()[0]
        least = batch_id - 1 if since is None else min(since, batch_id - 1)
        hadoop = spark._jvm.org.apache.hadoop.fs
        files = hadoop.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        for folder, keep in (("pending", least), ("state", batch_id - 1)):
            top = hadoop.Path(f"{self.root}/{folder}")
            for found in files.listStatus(top) if files.exists(top) else ():
                name = found.getPath().getName()
                if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) < keep:
                    files.delete(found.getPath(), True)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # One row per log partition: small by nature, so safe to broadcast.
        state = self._state(spark, batch_id - 1)
        self._expire(spark, state, batch_id)
        tagged = tag_frames(batch, self.block_span).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            data = (
                tagged.filter("control is null").join(F.broadcast(state), LOG, "left")
                .withColumn("opened_by", F.coalesce("prev_control", F.when(F.col("open"), START)))
                .filter(F.col("opened_by") == START)
                .withColumn("frame_id", F.coalesce("frames_started", F.lit(0)) + F.col("frame_id"))
                .select(*LOG, "frame_id", "offset", "value", "next_control")
            )
            (data.filter("next_control is null").drop("next_control")
             .write.mode("overwrite").parquet(f"{self.root}/pending/batch_id={batch_id}"))
            seen = tagged.groupBy(*LOG).agg(
                F.count_if(F.col("control") == START).alias("starts"),
                F.min_by("control", F.when(F.col("control").isNotNull(), F.col("offset"))).alias("first_control"),
                F.max_by("control", F.when(F.col("control").isNotNull(), F.col("offset"))).alias("last_control"),
            )
            closing = (
                seen.filter(F.col("first_control") == END).join(state.filter("open"), LOG)
                .select(*LOG, F.col("frames_started").alias("frame_id"), "open_since")
            )
            complete = data.filter(F.col("next_control") == END).drop("next_control")
            waiting = self._waiting(spark, closing, batch_id)
            if waiting is not None:
                complete = complete.unionByName(waiting)
            if not complete.isEmpty():
                self.emit(complete, batch_id)
            is_open = F.coalesce(F.col("last_control") == START, F.col("open"), F.lit(False))
            (state.join(seen, LOG, "full").select(
                *LOG,
                (F.coalesce("frames_started", F.lit(0)) + F.coalesce("starts", F.lit(0))).alias("frames_started"),
                is_open.alias("open"),
                F.when(F.col("last_control") == START, F.lit(batch_id))
                .when(is_open, F.col("open_since")).cast("bigint").alias("open_since"),
            ).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/state/batch_id={batch_id}"))
        finally:
            tagged.unpersist()


def writer_name(spark: SparkSession, root: str) -> str:
    """The name under which the stream with this root appends; made once, kept with its checkpoint."""
    path = f"{root}/writer"
    try:
        return spark.read.schema(WRITER).parquet(path).first()["writer"]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    name = f"stream-{uuid.uuid4().hex}"
    spark.createDataFrame([(name,)], WRITER).coalesce(1).write.parquet(path)
    return name


def start_ingest(
    messages: DataFrame, root: str, warehouse: str, price: Scorer | Callable[[], Scorer],
    cancel: Scorer | Callable[[], Scorer], block_span: int = BLOCK_SPAN, current: bool = False, **trigger,
) -> StreamingQuery:
    """Run the monthly ETL on every frame the stream closes.

    root holds the stream's own files (checkpoint, state, waiting rows, its
    writer's name); the feature tables must exist in the warehouse. With
    current, price and cancel are functions that give the scorer, asked anew
    for each micro-batch with closed frames, so that a promotion reaches a
    running stream. trigger is passed on, by default everything available is
    processed and the query ends. A message that is no booking goes to the
    rejected table and stops nothing.
    """
    writer = writer_name(messages.sparkSession, root)

    def emit(frames: DataFrame, batch_id: int) -> None:
        rows = parse_csv_messages(frames.select(F.col("value").alias("line")), "line", MONTHLY)
        append_month(rows, batch_id + 1, writer, warehouse, price() if current else price,
                     cancel() if current else cancel)

    return (messages.writeStream
            .foreachBatch(FrameAssembler(f"{root}/frames", emit, block_span))
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(**(trigger or {"availableNow": True}))
            .start())
