"""Exact top-k inner products by elimination with a table of pivot distances.

Every vector's distances to PIVOTS pivots are computed once. For a query q and
a candidate x, the largest |d(q, p) - d(x, p)| is a lower bound of d(q, x), and
as 2<q, x> = |q|^2 + |x|^2 - d(q, x)^2, that gives an upper bound of the score.
In a block, candidates are taken by falling bound until the bound is below the
k-th best score found; what can't reach the query's k-th best score among a
fixed sample isn't looked at.

The table is cut into cells around SAMPLE vectors. A cell knows the least and largest
distance to each pivot and the largest norm in it, which bound the scores of all
its vectors, so a query asks only for cells that can reach its floor. Queries
from cells side by side make blocks, cells side by side or parts of large cells make
chunks, both of bounded size, and only chunks are sent to a block in which it asks
for a cell. Pivots and the sample are drawn by hash order from the table and bounded
by parameters; they steer the work, not the result.

Components are floor(1024 * x); scores are exact integers (doubles hold them up
to 2^53, beyond that Python's integers; a score outside of 64 bits is cut to
the nearest). Defined results: vectors that are null, empty or hold null or
non-finite components, those of another than the commonest length and rows
without key take no part; equal scores go by key; rows repeated are candidates
each and one query, but a query's own key never is a candidate; different
vectors of one key are ranked together; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from innlake.llm import vectors
from innlake.llm.multi_index import bundles
from innlake.session import scratch_path

SCALE = 1024
K = 10
PIVOTS = 64
SAMPLE = 512
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 4096
_EXACT = float(1 << 53)


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products."""
    if queries.size and rows.size and np.abs(queries).max() * np.abs(rows).max() * queries.shape[1] >= _EXACT:
        whole = np.array([[int(x) for x in r] for r in rows], object).T
        found = np.array([[int(x) for x in q] for q in queries], object) @ whole
        return np.array([[min(max(x, -(1 << 63)), (1 << 63) - 1) for x in r] for r in found], np.int64)
    return (queries @ rows.T).astype(np.int64)


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.sqrt(((rows - p) ** 2).sum(axis=1)) for p in pivots], axis=1)


def cell_bounds(query: np.ndarray, far: np.ndarray, low: np.ndarray, high: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores in cells, from a query's pivot distances and the cells' (cells, pivots) ends."""
    apart = np.maximum(np.maximum(low - far, far - high).max(axis=1), 0)
    return _above(((query @ query) + norm - apart * apart) / 2, query @ query + norm)


def _above(bound: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A little more than the bound: above the rounding of distances that are kept in single precision."""
    return bound + 1e-6 * size + 1


def _spread(rows: np.ndarray, n: int) -> np.ndarray:
    """Rows far from each other, greedily."""
    chosen = [0]
    far = ((rows - rows[0]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(rows)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    return rows[chosen]


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search_block(queries: tuple, rows: tuple, k: int) -> list[tuple[int, int, int]]:
    """(query, id, score) of each query's k best; both are (ids, vectors, pivot distances), queries with floors."""
    q_ids, q_rows, q_far, floors = queries
    ids, own, far = rows
    out = []
    norm = (own * own).sum(axis=1)
    for i in range(len(q_ids)):
        apart = np.abs(far - q_far[i]).max(axis=1)
        bound = ((q_rows[i] @ q_rows[i]) + norm - apart * apart) / 2
        bound = _above(bound, q_rows[i] @ q_rows[i] + norm)
        live = np.flatnonzero((bound >= floors[i]) & (ids != q_ids[i]))
        live = live[np.argsort(-bound[live])]
        taken, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least = floors[i]
        for at in range(0, len(live), 256):
            part = live[at: at + 256]
            if bound[part[0]] < least:
                break
            taken = np.concatenate([taken, part])
            scores = np.concatenate([scores, _scores(q_rows[i: i + 1], own[part])[0]])
            keep = _best(scores, ids[taken], k)
            taken, scores = taken[keep], scores[keep]
            if len(scores) == k:
                least = max(least, int(scores[-1]))
        out += [(int(q_ids[i]), int(ids[t]), int(s)) for t, s in zip(taken, scores)]
    return out


def top_k(rows: DataFrame, is_query: Column, k: int = K, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row with is_query."""
    spark = rows.sparkSession
    length = vectors.usual_length(rows, vector)
    # floor() returns a long; components too large for one are whole numbers already.
    scaled = F.col(vector).cast("array<double>")
    large = F.transform(scaled, lambda x: F.when(
        F.abs(x) < 1e12, F.floor(x * SCALE).cast("double")).otherwise(x * SCALE))
    usable = rows.filter(F.col(key).isNotNull() & vectors.sound(vector) & (F.size(vector) == length)) \
        .select(F.col(key).cast("long").alias("own"), large.alias("whole"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    sample = usable.orderBy(F.xxhash64("own"), "own").limit(SAMPLE).collect()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    sample_ids = np.array([r["own"] for r in sample], np.int64)
    sample_rows = np.array([r["whole"] for r in sample])
    shared = spark.sparkContext.broadcast((sample_ids, sample_rows, _spread(sample_rows, PIVOTS)))

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, known, pivots = shared.value
        half = (known * known).sum(axis=1) / 2
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                own = part.column("own").to_numpy()
                values = vectors.matrix(part.column("whole"), length)
                asks = part.column("asks").to_numpy(zero_copy_only=False)
                floors = np.full(len(own), -(1 << 63), np.int64)
                for i in np.flatnonzero(asks):
                    others = known[ids != own[i]]
                    if len(others) >= k:
                        floors[i] = np.sort(_scores(values[i: i + 1], others)[0])[-k]
                cell = (values @ known.T - half).argmax(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), part.column("whole"), vectors.lists(_distances(values, pivots), pa.float32()),
                     part.column("asks"), pa.array(floors), pa.array(cell), pa.array((values * values).sum(axis=1))],
                    names=["own", "whole", "far", "asks", "floor", "cell", "norm"])

    path = scratch_path(spark, "pivot-table")
    usable.mapInArrow(table, "own long, whole array<double>, far array<float>, asks boolean, floor long, cell int, norm double") \
        .write.parquet(path)
    known = spark.read.parquet(path)
    n_pivots = min(PIVOTS, len(sample_rows))
    ends = [f(F.col("far")[i]).alias(f"{name}{i}") for i in range(n_pivots) for name, f in (("low", F.min), ("high", F.max))]
    cells = sorted(known.groupBy("cell").agg(F.count("*").alias("n"), F.count_if("asks").alias("q"), F.max("norm").alias("norm"), *ends)
                   .collect(), key=lambda r: r["cell"])  # SAMPLE rows at most
    low, high = (np.array([[r[f"{name}{i}"] for i in range(n_pivots)] for r in cells], np.float64) for name in ("low", "high"))
    chunks = bundles({r["cell"]: r["n"] for r in cells}, CANDIDATE_BLOCK)
    blocks = bundles({r["cell"]: r["q"] for r in cells}, QUERY_BLOCK)
    facts = spark.sparkContext.broadcast((low, high, np.array([r["norm"] for r in cells]), [chunks[r["cell"]] for r in cells]))

    def bundled(df: DataFrame, by_cell: dict[int, tuple[int, int]], name: str) -> DataFrame:
        shares = spark.createDataFrame([(c, first, parts) for c, (first, parts) in by_cell.items()], "cell int, first int, parts int")
        spot = F.col("first") + F.pmod(F.xxhash64("own", "whole"), "parts").cast("int")
        return df.join(F.broadcast(shares), "cell").withColumn(name, spot).drop("first", "parts")

    payload = ["own", "whole", "far", "floor", "block"]

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lows, highs, norms, places = facts.value
        for batch in batches:
            values = vectors.matrix(batch.column("whole"), length)
            far = batch.column("far").flatten().to_numpy().astype(np.float64).reshape(len(values), -1)
            for i, floor in enumerate(batch.column("floor").to_pylist()):
                cells_in = np.flatnonzero(cell_bounds(values[i], far[i], lows, highs, norms) >= floor)
                found = sorted({c for j in cells_in for c in range(places[j][0], sum(places[j]))})
                rows = batch.select(payload).take(pa.array(np.full(len(found), i)))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(found, pa.int32())], names=[*payload, "chunk"])

    path = scratch_path(spark, "pivot-visits")
    bundled(known.filter("asks"), blocks, "block").dropDuplicates(["own", "whole"]).select(payload).mapInArrow(
        visit, "own long, whole array<double>, far array<float>, floor long, block int, chunk int") \
        .withColumn("asks", F.lit(True)).write.parquet(path)
    visits = spark.read.parquet(path)
    given = visits.select("block", "chunk").distinct().join(
        bundled(known.select("own", "whole", "far", "floor", "cell"), chunks, "chunk"), "chunk").drop("cell").withColumn("asks", F.lit(False))

    def meet(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy(zero_copy_only=False)
        ids, values = group.column("own").to_numpy(), vectors.matrix(group.column("whole"), length)
        far = group.column("far").combine_chunks().flatten().to_numpy().astype(np.float64).reshape(len(ids), -1)
        floors = group.column("floor").to_numpy()
        found = search_block((ids[asks], values[asks], far[asks], floors[asks]),
                             (ids[~asks], values[~asks], far[~asks]), k)
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns)})

    found = visits.unionByName(given).groupBy("block", "chunk").applyInArrow(meet, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products among all `embeddings` for every hundredth id."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)
