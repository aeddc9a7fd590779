"""Count-min sketches of 64-bit keys, built per partition and merged by Spark.

A sketch has two rows of cells. Cells count to two and stay there: the question
is only whether a key may occur twice. Counts are never too low, so a key whose
cells say "once" in any row occurs once.

A partition sends the cells that it touched, as compressed gaps, cut into
blocks; a block's merged cells come back as one bit each. The width follows the
expected number of keys up to MAX_LOG_CELLS (64 MB of bits a row), which bounds
what is collected and broadcast; beyond that more unique keys pass the filter,
and none is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from innlake.llm.memory import released
from innlake.llm.units import mix

ROWS = 2
CELLS_PER_KEY = 8
MIN_LOG_CELLS, MAX_LOG_CELLS = 20, 29
_LOG_BLOCK = 18
_SEEDS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344], np.uint64)


def _cells(keys: np.ndarray, row: int, log_cells: int) -> np.ndarray:
    return mix(keys ^ _SEEDS[row]) >> np.uint64(64 - log_cells)


class Sketch:
    """Merged sketch: for each row a bit per cell, set if the cell counted two."""

    def __init__(self, bits: np.ndarray, log_cells: int):
        self.bits, self.log_cells = bits, log_cells

    def repeated(self, keys: np.ndarray) -> np.ndarray:
        """False only for keys that certainly occur once."""
        out = np.ones(len(keys), bool)
        for row in range(ROWS):
            cells = _cells(keys, row, self.log_cells)
            byte = self.bits[row][cells >> np.uint64(3)]
            out &= (byte >> (np.uint8(7) - (cells & np.uint64(7)).astype(np.uint8))) & np.uint8(1) == 1
        return out


def log_cells_for(expected: int) -> int:
    wanted = max(1, CELLS_PER_KEY * expected).bit_length()
    return min(MAX_LOG_CELLS, max(MIN_LOG_CELLS, wanted))


def build(rows: DataFrame, keys: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]],
          expected: int) -> Sketch:
    """Sketch of all keys that keys() reads from the batches of each partition."""
    log_cells = log_cells_for(expected)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [x for x in keys(batches) if len(x)]
        every = np.concatenate(seen) if seen else np.zeros(0, np.uint64)
        for row in range(ROWS):
            cells, counts = np.unique(_cells(every, row, log_cells), return_counts=True)
            blocks = (cells >> np.uint64(_LOG_BLOCK)).astype(np.int64)
            inside = ((cells & np.uint64((1 << _LOG_BLOCK) - 1)) << np.uint64(1)) | (counts > 1).astype(np.uint64)
            heads = np.flatnonzero(np.diff(blocks, prepend=-1))
            out = [], []
            for head, part in zip(heads, np.split(inside.astype(np.uint32), heads[1:]) if len(heads) else []):
                out[0].append(int(blocks[head]))
                out[1].append(len(part).to_bytes(4, "little")
                              + pa.compress(np.diff(part, prepend=np.uint32(0)).tobytes(), "zstd", asbytes=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(out[0]), row), pa.int32()), pa.array(out[0], pa.int32()),
                 pa.array(out[1], pa.binary())], names=["row", "block", "cells"])

    def merge(table: pa.Table) -> pa.Table:
        counts = np.zeros(1 << _LOG_BLOCK, np.uint8)
        for data in table.column("cells"):
            data = data.as_py()
            n = int.from_bytes(data[:4], "little")
            found = np.cumsum(np.frombuffer(pa.decompress(data[4:], 4 * n, "zstd"), np.uint32), dtype=np.uint32)
            at = found >> 1
            counts[at] = np.minimum(2, counts[at] + 1 + (found & 1).astype(np.uint8))
        return pa.table({"row": table.column("row")[:1], "block": table.column("block")[:1],
                         "bits": pa.array([np.packbits(counts > 1).tobytes()], pa.binary())})

    merged = rows.mapInArrow(released(partial), "row int, block int, cells binary") \
        .groupBy("row", "block").applyInArrow(merge, "row int, block int, bits binary")
    bits = np.zeros((ROWS, 1 << (log_cells - 3)), np.uint8)
    size = 1 << (_LOG_BLOCK - 3)
    for row, block, data in merged.collect():
        bits[row, block * size: (block + 1) * size] = np.frombuffer(data, np.uint8)
    return Sketch(bits, log_cells)
