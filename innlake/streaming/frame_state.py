"""Frames of a message log held in the stream's own state.

Each log partition has a value (frames started, whether one is open, its deadline) and
a list of the open frame's rows, which Spark keeps, checkpoints and brings back; a
frame leaves when its END arrives. A frame that hasn't ended when its time is over
is given up by a timer: its rows come out as not closed, and what follows
belongs to no frame until the next START. A frame may span any number of batches.

The rows of one log partition in a micro-batch are put in order in one task, so limit
what a batch takes from the log (an option of the source). Where a partition's batch is too
large for that, `ingest.FrameAssembler` cuts it into blocks instead.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from innlake.operators.frames import END, START

FRAMES = "topic string, partition int, offset bigint, value string, frame_id bigint, closed boolean"
_COLUMNS = ["topic", "partition", "offset", "value", "frame_id", "closed"]
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FrameProcessor(StatefulProcessor):
    """timeout_ms: time from a START after which its frame is given up; None waits for ever."""

    def __init__(self, timeout_ms: int | None):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.frame = handle.getValueState("frame", "started bigint, open boolean, deadline bigint")
        self.rows = handle.getListState("rows", "offset bigint, value string")

    def _held(self) -> pd.DataFrame:
        return pd.DataFrame(list(self.rows.get()), columns=["offset", "value"])

    @staticmethod
    def _frames(key: tuple, rows: pd.DataFrame, frame_id, closed: bool) -> pd.DataFrame:
        topic, partition = key
        return rows.assign(topic=topic, partition=np.int32(partition), frame_id=frame_id, closed=closed)[_COLUMNS] \
            .astype({"offset": "int64", "frame_id": "int64"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        """All frames of a batch leave together: the state and its timer are touched a few times a batch, not a frame."""
        batch = pd.concat(list(rows), ignore_index=True).sort_values("offset", ignore_index=True)[["offset", "value"]]
        started, open_, deadline = self.frame.get() if self.frame.exists() else (0, False, None)
        value = batch["value"].to_numpy()
        starts = value == START
        is_control = starts | (value == END)
        controls = np.flatnonzero(is_control)
        # Stretches between controls: the first goes on with what is open, the others begin at a control.
        opens = np.append(open_, starts[controls])
        closes = np.append(~starts[controls], False)
        stretch = np.cumsum(is_control)
        frame_id = started + np.cumsum(np.append(0, starts[controls]))
        inside = ~is_control & opens[stretch]
        leaves = inside & closes[stretch]
        out, ids = batch[leaves], frame_id[stretch[leaves]]
        if len(controls):
            if open_ and closes[0]:
                held = self._held()
                out, ids = pd.concat([held, out], ignore_index=True), np.append(np.full(len(held), started), ids)
            self.rows.clear()
            if deadline is not None:
                self.handle.deleteTimer(deadline)
                deadline = None
            if opens[-1] and self.timeout_ms is not None:
                deadline = timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms
                self.handle.registerTimer(deadline)
        pending = batch[inside & (stretch == len(controls))]
        if len(pending):
            self.rows.appendList([(int(o), v) for o, v in zip(pending["offset"], pending["value"])])
        self.frame.update((int(frame_id[-1]), bool(opens[-1]), deadline))
        if len(out):
            yield self._frames(key, out, ids, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        started, open_, deadline = self.frame.get()
        if open_ and deadline == expiredTimerInfo.getExpiryTimeInMs():
            out = self._frames(key, self._held(), started, False)
            self.rows.clear()
            self.frame.update((started, False, None))
            if len(out):
                yield out

    def close(self) -> None:
        pass


@contextmanager
def rocks_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which lists and timers need."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


def stateful_frames(messages: DataFrame, timeout_ms: int | None = None) -> DataFrame:
    """FRAMES: the rows of every frame that ends, and of those that are given up, of a stream of messages."""
    return messages.groupBy("topic", "partition").transformWithStateInPandas(
        FrameProcessor(timeout_ms), outputStructType=FRAMES, outputMode="Append", timeMode="ProcessingTime")
