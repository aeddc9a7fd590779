"""Frames in the stream's state, and the log that is read by offsets."""

import json
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from innlake.operators.frames import END, START
from innlake.session import scratch_path
from innlake.sources import message_log, messages
from innlake.streaming.frame_state import FrameProcessor, rocks_store, stateful_frames
from tests.test_frames import SCHEMA, strict_replay


def append(spark, path, rows):
    messages.write_messages(spark.createDataFrame(rows, SCHEMA), message_log.FORMAT, path=path)


def run(spark, root, timeout_ms=None, fail=False, **options):
    stream = messages.message_stream(spark, message_log.FORMAT, path=f"{root}/log", **options)

    def sink(df, batch_id):
        df.write.mode("overwrite").parquet(f"{root}/frames/batch={batch_id}")
        if fail:
            raise RuntimeError("lost")

    with rocks_store(spark):
        query = stateful_frames(stream, timeout_ms).writeStream.foreachBatch(sink).option(
            "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()


def found(spark, root):
    return sorted((r["topic"], r["partition"], r["offset"], r["value"], r["frame_id"], r["closed"])
                  for r in spark.read.parquet(f"{root}/frames").collect())


LOG = {0: ["x", START, "a", "b", "c", END, "y", START, "d", START, "e", "f", END, END, START, END, START, "g"],
       1: [START, "h", "i", "j", "k", "l", "m", END, START, "n", END]}


def wanted(upto=99):
    return sorted(("t", p, o, LOG[p][o], frame, True) for p, values in LOG.items()
                  for o, frame in strict_replay(values[:upto]).items())


@pytest.fixture
def states(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_frames_over_batches_restarts_and_a_replay(spark, states):
    root = scratch_path(spark, "stateful")
    rows = [("t", p, o, v) for p, values in LOG.items() for o, v in enumerate(values)]
    append(spark, f"{root}/log", [r for r in rows if r[2] < 4])
    run(spark, root)
    assert found(spark, root) == wanted(4) == []
    append(spark, f"{root}/log", [r for r in rows if 4 <= r[2] < 9])
    with pytest.raises(Exception):
        run(spark, root, fail=True)
    run(spark, root)  # the batch that failed is replayed with the same state and messages
    assert found(spark, root) == wanted(9) != []
    append(spark, f"{root}/log", [r for r in rows if r[2] >= 9])
    run(spark, root)
    assert found(spark, root) == wanted()


def test_a_frame_that_never_ends_is_given_up(spark, states):
    root = scratch_path(spark, "unclosed")
    append(spark, f"{root}/log", [("t", 0, i, v) for i, v in enumerate([START, "a", "b"])])
    run(spark, root, timeout_ms=1)
    time.sleep(0.1)
    append(spark, f"{root}/log", [("t", 1, 0, "other")])
    run(spark, root, timeout_ms=1)  # its timer fires though the partition has no message
    given_up = [("t", 0, 1, "a", 1, False), ("t", 0, 2, "b", 1, False)]
    assert found(spark, root) == given_up
    append(spark, f"{root}/log", [("t", 0, 3 + i, v) for i, v in enumerate(["late", END, START, "c", END])])
    run(spark, root, timeout_ms=60_000)
    assert found(spark, root) == given_up + [("t", 0, 6, "c", 2, True)]


def test_log_segments_and_offsets(spark):
    path = scratch_path(spark, "log")
    df = spark.createDataFrame([("t", i % 2, i, f"v{i}") for i in range(100)] + [("u", 0, 7, None)], SCHEMA)
    message_log.write_log(messages.encode_values(df), path, segment_span=30)
    reader = message_log.LogReader({"path": path, "maxOffsetsPerPartition": "40"})
    start = reader.initialOffset()
    read = []
    for _ in range(4):
        end = reader.latestOffset()
        batch = [(b.column("topic")[i].as_py(), b.column("partition")[i].as_py(), b.column("offset")[i].as_py())
                 for s in reader.partitions(start, end) for b in reader.read(s) for i in range(b.num_rows)]
        for p in (0, 1):
            assert len([x for x in batch if x[:2] == ("t", p)]) <= 20
        again = [b.num_rows for s in reader.partitions(start, end) for b in reader.read(s)]
        assert sum(again) == len(batch)
        read += batch
        start = end
    assert sorted(read) == sorted([("t", i % 2, i) for i in range(100)] + [("u", 0, 7)])
    assert json.loads(start["offsets"]) == {"t/0": 99, "t/1": 100, "u/0": 8}
    assert reader.partitions(start, reader.latestOffset()) == []


def test_log_source_resumes_by_offsets(spark):
    root = scratch_path(spark, "resume")

    def sink(df, batch_id):
        df.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    for part in range(3):
        append(spark, f"{root}/log", [("t", p, o, f"{p}-{o}") for p in (0, 1) for o in range(part * 10, part * 10 + 10)])
        messages.message_stream(spark, message_log.FORMAT, path=f"{root}/log").writeStream.foreachBatch(sink).option(
            "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        stored = spark.read.parquet(f"{root}/out")
        assert stored.count() == stored.select("partition", "offset").distinct().count() == 20 * (part + 1)
        assert stored.filter(F.col("value") != F.concat_ws("-", F.col("partition"), F.col("offset"))).isEmpty()


class Kept:
    """A state that counts how often it is touched."""

    def __init__(self):
        self.value, self.calls = None, 0

    def exists(self):
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value or []

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def appendList(self, rows):
        self.calls, self.value = self.calls + 1, [*(self.value or []), *rows]

    def clear(self):
        self.calls, self.value = self.calls + 1, None


def test_state_is_touched_a_few_times_a_batch_not_a_frame():
    values = ["x", START, "a"] + [END, START, "b", "c"] * 300 + [START, "d", None, END, "y", START, "e"]
    processor = FrameProcessor(None)
    processor.handle, processor.frame, processor.rows = None, Kept(), Kept()
    parts = []
    for low, high in ((0, 2), (2, 3), (3, 900), (900, len(values))):
        batch = pd.DataFrame({"offset": range(low, high), "value": values[low:high]}).sample(frac=1, random_state=1)
        half = len(batch) // 2
        parts += processor.handleInputRows(("t", 0), iter([batch[:half], batch[half:]]), None)
    assert processor.frame.calls + processor.rows.calls <= 4 * 6
    found = pd.concat(parts)
    assert dict(zip(found["offset"], found["frame_id"])) == strict_replay(values)
    assert found["offset"].is_monotonic_increasing and found["closed"].all()
    assert processor.rows.value == [(len(values) - 1, "e")] and processor.frame.value[1]
