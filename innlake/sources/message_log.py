"""A partitioned message log in files, read as a stream by offsets.

A log is a folder: <topic>/<partition>/<first offset>-<last offset>.parquet, each a
segment of (offset, value) in order. A batch is the offsets from start to end of each
partition, both kept in the stream's checkpoint, so a batch that is replayed reads the same
messages. Segments are found by their names; a task reads one.

An admission limit (`maxOffsetsPerPartition`) bounds a batch's span of offsets in each
partition. It counts from where this run of the query stands; the first batch after
a restart isn't bounded, as the engine doesn't tell a Python source its place.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "message_log"
SEGMENT_SPAN = 1 << 20
SCHEMA = "topic string, partition int, offset bigint, value binary"


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write_log(messages: DataFrame, path: str, segment_span: int = SEGMENT_SPAN) -> None:
    """Appends messages (topic, partition, offset, value) to a log; offsets go on from those there.

    Segments are cut by spans of offsets, so that a partition with most of all messages is many tasks'.
    """
    def save(table: pa.Table) -> pa.Table:
        where, root = _folder(path)
        table = table.sort_by("offset")
        topic, partition = table.column("topic")[0].as_py(), table.column("partition")[0].as_py()
        first, last = table.column("offset")[0].as_py(), table.column("offset")[-1].as_py()
        folder = f"{root}/{topic}/{partition}"
        where.create_dir(folder, recursive=True)
        name = f"{first:020d}-{last:020d}.parquet"
        # Complete under another name first: a reader never sees half a segment, a second attempt writes the same.
        with where.open_output_stream(f"{folder}/.{name}") as out:
            pq.write_table(table.select(["offset", "value"]), out)
        where.move(f"{folder}/.{name}", f"{folder}/{name}")
        return pa.table({"n": pa.array([len(table)], pa.int64())})

    rows = messages.select("topic", F.col("partition").cast("int").alias("partition"), F.col("offset").cast("bigint").alias("offset"),
                           F.col("value").cast("binary").alias("value"), F.floor(F.col("offset") / segment_span).alias("segment"))
    rows.groupBy("topic", "partition", "segment").applyInArrow(save, "n long").agg(F.sum("n")).collect()


class Segment(InputPartition):
    """Offsets from start (included) to end (excluded) of one segment."""

    def __init__(self, topic: str, partition: int, path: str, start: int, end: int):
        self.topic, self.partition, self.path, self.start, self.end = topic, partition, path, start, end


class LogReader(DataSourceStreamReader):
    """Offsets are {"topic/partition": next offset}."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.limit = int(options.get("maxoffsetsperpartition", options.get("maxOffsetsPerPartition", 0)))
        self.place: dict[str, int] | None = None

    def _segments(self) -> dict[str, list[tuple[int, int, str]]]:
        """(first, last, path) of all segments by partition, in order."""
        where, root = _folder(self.path)
        found: dict[str, list[tuple[int, int, str]]] = {}
        for info in where.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            if info.type == fs.FileType.File and info.base_name.endswith(".parquet") and not info.base_name.startswith("."):
                topic, partition = info.path.split("/")[-3:-1]
                first, last = info.base_name.removesuffix(".parquet").split("-")
                found.setdefault(f"{topic}/{partition}", []).append((int(first), int(last), info.path))
        return {k: sorted(v) for k, v in found.items()}

    def initialOffset(self) -> dict:
        self.place = {}
        return {"offsets": "{}"}

    def latestOffset(self) -> dict:
        ends = {}
        for name, segments in self._segments().items():
            end = segments[-1][1] + 1
            if self.limit and self.place is not None:
                # Offsets may have gaps: the limit counts from the next one that exists.
                start = next((max(first, self.place.get(name, 0)) for first, last, _ in segments if last >= self.place.get(name, 0)), end)
                end = min(end, start + self.limit)
            ends[name] = end
        if self.place is not None:
            self.place = {**self.place, **ends}
        return {"offsets": json.dumps(ends, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        before, upto = json.loads(start["offsets"]), json.loads(end["offsets"])
        self.place = {**(self.place or {}), **upto}
        out = []
        for name, segments in self._segments().items():
            topic, partition = name.split("/")
            low, high = before.get(name, 0), upto.get(name, 0)
            out += [Segment(topic, int(partition), path, max(low, first), min(high, last + 1))
                    for first, last, path in segments if last >= low and first < high]
        return out

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        where, _ = _folder(self.path)
        with where.open_input_file(partition.path) as source:
            for batch in pq.ParquetFile(source).iter_batches(columns=["offset", "value"]):
                offset = batch.column("offset")
                keep = pc.and_(pc.greater_equal(offset, partition.start), pc.less(offset, partition.end))
                part = batch.filter(keep)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([partition.topic] * n, pa.string()), pa.array([partition.partition] * n, pa.int32()),
                     part.column("offset"), part.column("value")], names=["topic", "partition", "offset", "value"])

    def commit(self, end: dict) -> None:
        pass


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MessageLog)
