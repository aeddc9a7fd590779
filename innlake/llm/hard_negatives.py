"""Hard negatives: near rows of other labels, in a window below each positive's score.

All vectors are placed in the cells of an inverted multi-index (`multi_index`),
whose codebooks are fitted on SAMPLE rows drawn by hash order. A search asks, for each
anchor and window of scores, for the first k rows of its label or of others. It
takes two rounds: the first cells by bound, until they hold FIRST vectors, give each
window a score that its k-th row reaches at least; the second visits all other cells
that may still hold a row between that and the window's top, and stops where
no bound reaches an open window. So results are exact. Positives are such a search
with one window without ends, negatives one with a window for each positive.

Anchors come in blocks of some ASKS from cells side by side, rows in chunks of
some ROWS, and only chunks are sent to a block in which it asks for a cell. Large cells
are split by hash. To the driver goes one row a cell, CODES ** 2 at most.

Components are floor(scale * x); scores are exact integers (doubles hold them up
to 2^53, beyond that Python's integers; one outside of 64 bits is cut to the nearest).
Defined results: rows without key or label and vectors that are null, empty, hold
null or non-finite components or have another than the commonest length take no part;
equal scores go by key; repeated rows are candidates each and one anchor; a
row with the anchor's key is never its candidate; a window without rows
returns none (so does every negative positive score); other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from innlake.llm import vectors
from innlake.llm.multi_index import MultiIndex, bundles
from innlake.session import scratch_path

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LEAST, MOST = 50, 95
SAMPLE = 8192
#: Codes of a half at most; there are as many as give cells of some CELL vectors.
CODES = 256
CELL = 64
FIRST = 1024
ASKS = 256
ROWS = 4096
_EXACT = float(1 << 53)
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


def whole(rows: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(rows * scale)


def scores(asks: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products of whole-numbered vectors."""
    if asks.size and rows.size and np.abs(asks).max() * np.abs(rows).max() * asks.shape[1] >= _EXACT:
        a, b = (np.array([[int(x) for x in r] for r in side], object) for side in (asks, rows))
        return np.clip(a @ b.T, _LOWEST, _HIGHEST).astype(np.int64)
    return (asks @ rows.T).astype(np.int64)


def first_rows(values: np.ndarray, keys: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[np.ndarray]:
    """Places of the first k of the values in each window, by falling value and key."""
    use = np.flatnonzero((values >= min(w[0] for w in windows)) & (values <= max(w[1] for w in windows)))
    use = use[np.lexsort((keys[use], -values[use]))]
    rising = -values[use]  # the least integer stands for "no end" and isn't negated
    out = []
    for low, high in windows:
        a = np.searchsorted(rising, -high)
        z = len(use) if low == _LOWEST else np.searchsorted(rising, -low, side="right")
        out.append(use[a: min(a + k, z)])
    return out


class _Search:
    """Searches over one index table: rows (own, label, vector, cell, chunk)."""

    def __init__(self, rows: DataFrame, index: Broadcast, chunks: dict[int, tuple[int, int]], length: int, scale: int):
        self.rows, self.index, self.length, self.scale = rows, index, length, scale
        self.chunks = rows.sparkSession.sparkContext.broadcast(chunks)

    def _walked(self, asks: DataFrame, room: float) -> DataFrame:
        """asks with the cells to visit, and those known so far."""
        index, length, scale, names = self.index, self.length, self.scale, asks.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                queries = whole(vectors.matrix(batch.column("vector"), length), scale)
                found = [
                    index.value.cells(q, list(zip(lows, highs)), room, frozenset(known))
                    for q, lows, highs, known in zip(queries, *(batch.column(c).to_pylist() for c in ("lows", "highs", "known")))]
                yield pa.RecordBatch.from_arrays(
                    [*batch.select(names).columns, pa.array(found, pa.list_(pa.int32()))], names=[*names, "cells"])

        return asks.mapInArrow(run, StructType([*asks.schema.fields, StructField("cells", ArrayType(IntegerType()))]))

    def _round(self, asks: DataFrame, same: bool, k: int) -> DataFrame:
        """ask, slot, other, score: the first k rows of every chunk in the cells that an ask visits."""
        chunks, length, scale = self.chunks, self.length, self.scale
        payload = ["ask", "own", "label", "vector", "lows", "highs", "block"]

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                origin, chunk, cells = [], [], []
                for i, visit in enumerate(batch.column("cells").to_pylist()):
                    by_chunk: dict[int, list[int]] = {}
                    for cell in visit:
                        first, parts = chunks.value[cell]
                        for c in range(first, first + parts):
                            by_chunk.setdefault(c, []).append(cell)
                    origin += [i] * len(by_chunk)
                    chunk += by_chunk
                    cells += by_chunk.values()
                for at in range(0, len(origin), 4096):
                    part = slice(at, at + 4096)
                    own = batch.select(payload).take(pa.array(origin[part], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [*own.columns, pa.array(cells[part], pa.list_(pa.int32())), pa.array(chunk[part], pa.int32())],
                        names=[*payload, "cells", "chunk"])

        fields = [asks.schema[c] for c in payload]
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", cells array<int>, chunk int"
        path = scratch_path(asks.sparkSession, "visits")
        asks.filter(F.size("cells") > 0).mapInArrow(spread, schema).write.parquet(path)
        visits = asks.sparkSession.read.parquet(path)
        given = visits.select("block", "chunk").distinct().join(self.rows, "chunk").select(
            "block", "chunk", F.col("own"), F.col("label"), F.col("vector"), F.array("cell").alias("cells"))

        def meet(table: pa.Table) -> pa.Table:
            is_ask = table.column("ask").is_valid().to_numpy()
            asked, held = table.filter(pa.array(is_ask)), table.filter(pa.array(~is_ask))
            keys = held.column("own").to_numpy()
            names = pa.concat_arrays([*asked.column("label").chunks, *held.column("label").chunks]).dictionary_encode().indices.to_numpy()
            ask_names, names = names[:len(asked)], names[len(asked):]
            found = scores(*(whole(vectors.matrix(t.column("vector"), length), scale) for t in (asked, held)))
            cell = np.array(held.column("cells").to_pylist(), np.int64).reshape(-1)
            out = []
            for i, (ask, own, lows, highs, visit) in enumerate(zip(
                    *(asked.column(c).to_pylist() for c in ("ask", "own", "lows", "highs", "cells")))):
                use = np.flatnonzero(np.isin(cell, visit) & ((names == ask_names[i]) == same) & (keys != own))
                if not len(use):
                    continue
                values = found[i, use]
                for slot, places in enumerate(first_rows(values, keys[use], list(zip(lows, highs)), k)):
                    out += [(ask, slot, key, value) for key, value in zip(keys[use[places]].tolist(), values[places].tolist())]
            columns = list(zip(*out)) or [()] * 4
            return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("ask", "slot", "other", "score"), columns)})

        return visits.unionByName(given, allowMissingColumns=True).groupBy("block", "chunk").applyInArrow(
            meet, "ask long, slot long, other long, score long")

    def first(self, asks: DataFrame, same: bool, k: int) -> DataFrame:
        """ask, slot, rank, other, score: the first k rows of the ask's label, or of others, in each of its windows.

        asks: ask (a name of its own), own, label, vector, block and the windows' ends lows and highs.
        """
        spark = asks.sparkSession

        def saved(df: DataFrame, name: str) -> DataFrame:
            path = scratch_path(spark, name)
            df.write.parquet(path)
            return spark.read.parquet(path)

        begun = saved(self._walked(asks.withColumn("known", F.array().cast("array<int>")), FIRST), "asks")
        some = saved(self._round(begun, same, k), "found")
        order = Window.partitionBy("ask", "slot").orderBy(F.desc("score"), "other")
        ranked = some.withColumn("rank", F.row_number().over(order))
        floors = ranked.filter(F.col("rank") == k).groupBy("ask").agg(
            F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("floors"))  # one entry a window
        lows = F.transform("lows", lambda low, i: F.greatest(low, F.coalesce(F.col("floors")[i.cast("long")], low)))
        rest = begun.join(floors, "ask", "left").withColumn("lows", F.when(F.col("floors").isNull(), F.col("lows")).otherwise(lows))
        more = self._walked(rest.select(*asks.columns, F.col("cells").alias("known")), float("inf"))
        every = some.unionByName(self._round(more, same, k))
        return every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, label: Column, key: str = "vec_id", vector: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST,
         scale: int = SCALE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A negative's score is at least `least` and at most `most` hundredths of the positive's.
    """
    spark = rows.sparkSession
    length = vectors.usual_length(rows, vector)
    usable = rows.filter(F.col(key).isNotNull() & label.isNotNull() & vectors.sound(vector) & (F.size(vector) == length)).select(
        F.col(key).cast("long").alias("own"), label.cast("string").alias("label"), F.col(vector).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    n = usable.count() if length else 0
    if n == 0:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    drawn = usable.select("vector", F.xxhash64("own", "vector").alias("h")).orderBy("h").limit(SAMPLE).collect()
    sample = whole(np.array([r["vector"] for r in drawn], np.float64), scale)
    blank = spark.sparkContext.broadcast(MultiIndex.fit(sample, max(1, min(CODES, math.isqrt(n // CELL)))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, left, right = blank.value.place(whole(vectors.matrix(batch.column("vector"), length), scale))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(left), pa.array(right)],
                                             names=[*batch.schema.names, "cell", "left", "right"])

    path = scratch_path(spark, "multi-index")
    kind = usable.schema["vector"].dataType.simpleString()
    usable.mapInArrow(place, f"own long, label string, vector {kind}, asks boolean, cell int, left double, right double").write.parquet(path)
    placed = spark.read.parquet(path)
    cells = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("left").alias("left"), F.max("right").alias("right"),
                                       F.count_if("asks").alias("asks")).collect()  # CODES ** 2 rows at most
    index = spark.sparkContext.broadcast(blank.value.filled([(r["cell"], r["n"], r["left"], r["right"]) for r in cells]))
    chunks = bundles({r["cell"]: r["n"] for r in cells}, ROWS)
    blocks = bundles({r["cell"]: r["asks"] for r in cells}, ASKS)

    def bundled(df: DataFrame, by_cell: dict[int, tuple[int, int]], name: str) -> DataFrame:
        shares = spark.createDataFrame([(c, first, parts) for c, (first, parts) in by_cell.items()], "cell int, first int, parts int")
        spot = F.col("first") + F.pmod(F.xxhash64("own", "vector"), "parts").cast("int")
        return df.join(F.broadcast(shares), "cell").withColumn(name, spot).drop("first", "parts")

    search = _Search(bundled(placed.select("own", "label", "vector", "cell"), chunks, "chunk"), index, chunks, length, scale)
    anchors = bundled(placed.filter("asks"), blocks, "block").withColumn("ask", F.xxhash64("own", "label", "vector")) \
        .select("ask", "own", "label", "vector", "block").dropDuplicates(["ask"])
    every = anchors.withColumn("lows", F.array(F.lit(_LOWEST))).withColumn("highs", F.array(F.lit(_HIGHEST)))
    path = scratch_path(spark, "positives")
    search.first(every, True, positives).write.parquet(path)
    liked = spark.read.parquet(path)
    # ceil and floor in whole numbers, also below zero; a window that ends before it begins is left out
    low = F.ceil(F.col("score").cast("decimal(38,0)") * least / 100).cast("long")
    high = F.floor(F.col("score").cast("decimal(38,0)") * most / 100).cast("long")
    windows = liked.withColumn("low", low).withColumn("high", high).filter("low <= high")
    order = Window.partitionBy("ask").orderBy("rank")
    windows = windows.withColumn("slot", (F.row_number().over(order) - 1).cast("long"))
    ends = windows.groupBy("ask").agg(F.array_sort(F.collect_list(F.struct("slot", "low", "high"))).alias("ends"))  # one a positive
    asked = anchors.join(ends, "ask").select(*anchors.columns, F.col("ends.low").alias("lows"), F.col("ends.high").alias("highs"))
    found = search.first(asked, False, negatives)
    return found.join(windows.select("ask", "slot", F.col("other").alias("positive_id"), F.col("score").alias("positive_score")),
                      ["ask", "slot"]).join(anchors.select("ask", F.col("own").alias("anchor_id")), "ask").select(
        "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of five positives of every fiftieth of all `embeddings`."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows, F.col("vec_id") % 50 == 0, label)
