"""Message-log source and sink: booking rows as UTF-8 messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innlake.operators.frames import END, START
from innlake.schemas import MESSAGES
from innlake.sources import message_log
from innlake.sources.csv_files import csv_header, csv_line, once


def frame_rows(df: DataFrame, columns: list[str], group: str, order: str) -> DataFrame:
    """Rows as messages: (group, position, value) with START, header, CSV rows and END for each group.

    order is a number that is unique in its group and not negative; START and the
    header come before it, END after it, so no pass over the rows orders them.
    """
    rows = once(df, F.col(group).alias("group"), F.col(order).cast("bigint").alias("position"),
                csv_line(columns).alias("value"))
    control = F.array(*[F.struct(F.lit(p).cast("bigint").alias("position"), F.lit(v).alias("value"))
                        for p, v in ((-2, START), (-1, csv_header(columns)))])
    last = df.groupBy(F.col(group).alias("group")).agg(F.max(F.col(order).cast("bigint")).alias("last"))
    opening = last.select("group", F.inline(control))
    closing = last.select("group", (F.col("last") + 1).alias("position"), F.lit(END).alias("value"))
    return rows.unionByName(opening).unionByName(closing)


def encode_values(messages: DataFrame) -> DataFrame:
    """Text to UTF-8 bytes, the form a log stores."""
    return messages.withColumn("value", F.encode("value", "UTF-8"))


def decode_values(messages: DataFrame) -> DataFrame:
    return (messages.select("topic", "partition", "offset", "value")
            .withColumn("value", F.decode("value", "UTF-8")))


def message_stream(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """Decoded message stream.

    fmt is 'kafka' where the connector is installed, 'message_log' for a log in
    files that is read by offsets, otherwise a file format holding topic, partition,
    offset and value. Such files must arrive in offset order per partition, as a log
    guarantees.
    """
    if fmt == message_log.FORMAT:
        message_log.register(spark)
    reader = spark.readStream.format(fmt).options(**options)
    if fmt not in ("kafka", message_log.FORMAT):
        reader = reader.schema(MESSAGES)
    return decode_values(reader.load())


def write_messages(messages: DataFrame, fmt: str, mode: str = "append", **options: str) -> None:
    """Encode and write; with 'kafka' the options name the servers and topic."""
    if fmt == message_log.FORMAT:
        message_log.write_log(encode_values(messages), options["path"])
        return
    encode_values(messages).write.format(fmt).mode(mode).options(**options).save()
