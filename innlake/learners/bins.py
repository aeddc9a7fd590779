"""Feature values as small codes, in blocks of rows.

Code 0 stands for a missing value, code c for values up to the c-th edge. A column
with no more different values than bins has an edge for each, so no cut is
lost; others have edges at quantiles. A block holds the codes of some thousand rows,
feature by feature, and the label as numpy arrays: one row of a DataFrame.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 255
BLOCK_ROWS = 32_768
BLOCK_SCHEMA = "block long, n int, codes binary, label binary"


def _value(column: str):
    return F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None).cast("double"))


def find_edges(df: DataFrame, columns: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Ascending edges of each column; the last is infinite. At most two passes, of which bins * columns values come back."""
    n = len(columns)
    names = [f"x{i}" for i in range(n)]

    def different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.empty(0)] * n
        for batch in batches:
            values = matrix(batch, names)
            for f in range(n):
                if len(seen[f]) <= bins:
                    own = np.unique(values[:, f])
                    seen[f] = np.union1d(seen[f], own[~np.isnan(own)])
        for f, own in enumerate(seen):  # a null for too many
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(max(1, len(own)) if len(own) <= bins else 1, f, np.int32)),
                 pa.array(own if 0 < len(own) <= bins else [np.nan if not len(own) else None], pa.float64())], names=["i", "x"])

    rows = df.select(*[_value(c).alias(x) for c, x in zip(columns, names)]).mapInArrow(different, "i int, x double")
    sets = rows.groupBy("i").agg(F.slice(F.collect_set(F.when(~F.isnan("x"), F.col("x"))), 1, bins + 1).alias("x"),
                                 F.count_if(F.isnull("x")).alias("over"))
    found: dict[int, list[float]] = {i: [] for i in range(n)}
    many = []
    for r in sets.collect() if n else []:
        found[r["i"]] = r["x"]
        if r["over"] or len(r["x"]) > bins:
            many.append(r["i"])
    if many:
        spots = [j / bins for j in range(1, bins)]
        row = df.agg(*[F.percentile_approx(_value(columns[i]), spots, 20 * bins).alias(f"q{i}") for i in many]).first()
        for i in many:
            found[i] = row[f"q{i}"]
    out = []
    for i in range(n):
        values = np.unique(found[i])
        if i not in many:
            values = values[:-1]  # the largest value has no edge of its own
        out.append(np.append(values, np.inf).astype(np.float64))
    return out


def level_edges(levels: int) -> np.ndarray:
    """Edges that give each of the numbers from 0 its own code, so that it doesn't depend on which of them occur."""
    return np.append(np.arange(levels - 1, dtype=np.float64), np.inf)


def code_type(edges: list[np.ndarray]) -> type:
    return np.uint8 if max(map(len, edges), default=0) < 256 else np.uint16


def codes_of(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """(features, rows) codes of (rows, features) values; nan is missing."""
    out = np.zeros((len(edges), len(values)), code_type(edges))
    for f, own in enumerate(edges):
        column = values[:, f]
        out[f] = np.where(np.isnan(column), 0, np.searchsorted(own, column) + 1)
    return out


def matrix(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """Rows of doubles; null is nan."""
    return np.stack([batch.column(c).cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False) for c in columns], axis=1) \
        if columns else np.zeros((batch.num_rows, 0))


def blocks(df: DataFrame, columns: list[str], edges: list[np.ndarray], label: str) -> DataFrame:
    """BLOCK_SCHEMA: the rows of each partition in their order, cut into blocks. A block's number is its place.

    Partitions of few rows are taken together: each pass over the blocks has a task for each.
    """
    df = df.coalesce(max(1, -(-df.count() // BLOCK_ROWS)))
    names = [f"x{i}" for i in range(len(columns))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        part, number, size = TaskContext.get().partitionId(), 0, 0

        def block() -> pa.RecordBatch:
            codes = np.concatenate([c for c, _ in held], axis=1)
            labels = np.concatenate([y for _, y in held])
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) | number]), pa.array([len(labels)], pa.int32()),
                 pa.array([codes.tobytes()], pa.binary()), pa.array([labels.tobytes()], pa.binary())],
                names=["block", "n", "codes", "label"])

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(at, BLOCK_ROWS)
                held.append((codes_of(matrix(some, names), edges), matrix(some, ["label"])[:, 0]))
                size += some.num_rows
                if size >= BLOCK_ROWS:
                    yield block()
                    held, number, size = [], number + 1, 0
        if held:
            yield block()

    rows = df.select(*[_value(c).alias(n) for c, n in zip(columns, names)], F.col(label).cast("double").alias("label"))
    return rows.mapInArrow(run, BLOCK_SCHEMA)


def opened(row: dict, n_features: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(codes, labels) of a block."""
    return np.frombuffer(row["codes"], kind).reshape(n_features, row["n"]), np.frombuffer(row["label"])
