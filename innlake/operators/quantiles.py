"""Exact interpolated quantiles in four scans, whatever the data.

The bits of a double, turned so that they sort like the numbers, are read as four
digits of 16 bits. A scan counts, for all columns and wanted ranks at once, the rows
by their next digit among those that share the digits found so far; the running count
tells the digit that holds the rank. After four digits the value is known. Counts are
added up in each task, then by Spark: a digit's counts are 65,536 rows at most for a column
and head, and what comes to the driver is one row for each wanted rank.

Null is left out; NaN counts as the largest; -0.0 is 0.0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innlake.functions.sqltext import name

DIGIT = 16
SCANS = 64 // DIGIT
_SIGN = np.uint64(1 << 63)


def sortable(values: np.ndarray) -> np.ndarray:
    """64-bit numbers that sort like the doubles."""
    values = np.where(np.isnan(values), np.nan, values + 0.0)  # one NaN, one zero
    bits = values.view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def value_of(key: int) -> float:
    """The double of a sortable number."""
    bits = key ^ (1 << 63) if key >> 63 else key ^ ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


@dataclass
class _Target:
    """A wanted 0-based rank of a column: digits found so far, and the rows below them."""

    column: int
    rank: int
    head: int = 0
    below: int = 0


def _counted(df: DataFrame, columns: list[str], heads: list[tuple[int, int]], scan: int) -> DataFrame:
    """(slot, digit, n) of the rows whose column starts with the head; slots are places in heads (column, head)."""
    names = [f"x{i}" for i in range(len(columns))]
    up, down = np.uint64(64 - DIGIT * scan), np.uint64(64 - DIGIT * (scan + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(heads), 1 << DIGIT), np.int64)
        for batch in batches:
            keys: dict[int, np.ndarray] = {}
            for slot, (c, head) in enumerate(heads):
                if c not in keys:
                    column = batch.column(c)
                    keys[c] = sortable(column.drop_null().to_numpy(zero_copy_only=False).astype(np.float64))
                own = keys[c] if scan == 0 else keys[c][keys[c] >> up == np.uint64(head)]
                digits = ((own >> down) & np.uint64((1 << DIGIT) - 1)).astype(np.int64)
                total[slot] += np.bincount(digits, minlength=1 << DIGIT)
        slot, digit = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot.astype(np.int32)), pa.array(digit.astype(np.int32)), pa.array(total[slot, digit])],
            names=["slot", "digit", "n"])

    values = df.select(*[F.expr(f"cast({name(c)} as double)").alias(n) for c, n in zip(columns, names)])
    return values.mapInArrow(run, "slot int, digit int, n long").groupBy("slot", "digit").agg(F.sum("n").alias("n"))


def order_statistics(df: DataFrame, wanted: dict[str, list[int]]) -> dict[tuple[str, int], float]:
    """Values at 0-based ranks of the present values of each column."""
    columns = [c for c, ranks in wanted.items() if ranks]
    targets = [_Target(i, rank) for i, c in enumerate(columns) for rank in sorted(set(wanted[c]))]
    if not targets:
        return {}
    running = Window.partitionBy("slot").orderBy("digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for scan in range(SCANS):
        heads = sorted({(t.column, t.head) for t in targets})
        counts = _counted(df, columns, heads, scan).withColumn("upto", F.sum("n").over(running))
        asked = df.sparkSession.createDataFrame(
            [(i, heads.index((t.column, t.head)), t.rank - t.below) for i, t in enumerate(targets)], "target int, slot int, rank long")
        found = counts.join(F.broadcast(asked), "slot").filter("rank >= upto - n and rank < upto") \
            .select("target", "digit", (F.col("upto") - F.col("n")).alias("before")).collect()
        for r in found:
            t = targets[r["target"]]
            t.head, t.below = t.head << DIGIT | r["digit"], t.below + r["before"]
    return {(columns[t.column], t.rank): value_of(t.head) for t in targets}


def interpolated_quantiles(df: DataFrame, probabilities: list[float], counts: dict[str, int]) -> dict[str, list[float | None]]:
    """Linear interpolation between neighbouring order statistics; counts are the numbers of present values."""
    columns = {c: n for c, n in counts.items() if n}
    positions = {c: [(n - 1) * p for p in probabilities] for c, n in columns.items()}
    ranks = {
        c: [r for position in spots for r in (math.floor(position), math.ceil(position))]
        for c, spots in positions.items()
    }
    found = order_statistics(df, ranks)
    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in counts}
    for c, spots in positions.items():
        result[c] = [
            found[c, math.floor(s)]
            + (found[c, math.ceil(s)] - found[c, math.floor(s)]) * (s - math.floor(s))
            for s in spots
        ]
    return result
