"""Exact k-nearest-neighbour classification as a pruned, blocked join.

Training rows belong to one of a bounded number of cells, cut out one after the other at the
middle of the feature that spreads most, and each cell has a box: the ends of its
rows' features. A query first meets the cell whose box is nearest, which gives it the k-th distance
there; then only cells whose boxes are no farther than that are visited, so the result equals
a full comparison. Cells are cut into blocks of bounded size, however many rows share a cell,
and a task compares one query block with one training block, keeping only k rows per query.
Inside a task both are cut the same way again, and groups of queries meet leaves of
training rows, nearest first, until no box is near enough. No pair ever leaves a task.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from innlake.session import scratch_path

#: Rows that a task takes of either side.
BLOCK_ROWS = 65_536
#: Rows of a cell, and the number of cells that are cut out at most.
CELL_ROWS = 32_768
MAX_CELLS = 1024
#: Rows that the cells are found from, for each of them.
CELL_SAMPLE = 32
VISIT_CHUNK = 512
#: In a task: queries of a group, training rows of a leaf, leaves that a group meets at once.
GROUP_ROWS = 256
LEAF_ROWS = 256
LEAVES = 8
# Guards the pruning bounds against rounding; the final distances are exact.
SLACK = 1e-9


def feature_array(columns: list[str]) -> Column:
    return F.array(*[F.col(f"`{c}`").cast("double") for c in columns])


def _matrix(series: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in series]) if len(series) else np.empty((0, 0))


def _points(table: pa.Table) -> np.ndarray:
    """(rows, features) of a table's feature arrays."""
    flat = table.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(len(table), -1)


def _halved(points: np.ndarray) -> tuple[int, float] | None:
    """The feature that spreads most and the value next to its middle, up to which rows go left; None if rows are alike."""
    spread = np.ptp(points, axis=0)
    if not (spread > 0).any():
        return None
    with np.errstate(invalid="ignore", over="ignore"):
        wide = np.where(spread > 0, np.nan_to_num(points.var(axis=0), nan=np.inf, posinf=np.inf), -1)
    feature = int(wide.argmax())
    column = points[:, feature]
    middle = np.partition(column, len(column) // 2)[len(column) // 2]
    below, upto = (column < middle).sum(), (column <= middle).sum()
    if 0 < below and (upto == len(column) or len(column) - 2 * below <= 2 * upto - len(column)):
        return feature, float(column[column < middle].max())
    return feature, float(middle)


def _cut(points: np.ndarray, size: int, most: int | None = None) -> tuple[list[np.ndarray], list[tuple[int, float, int, int]]]:
    """(rows of each leaf, nodes): rows are halved until leaves have at most size rows or there are most of them, the
    largest leaf first. A node is (feature, value up to which rows go left, left, right); below 0: leaf -1 - i.
    """
    leaves, nodes = [np.arange(len(points))], [(0, math.inf, -1, -1)]
    owner = [(0, 2)]  # where a leaf hangs: the node, and the place of its link
    todo = [(-len(points), 0)]
    while todo and (most is None or len(leaves) < most):
        n, leaf = heapq.heappop(todo)
        rows = leaves[leaf]
        if -n <= size or (found := _halved(points[rows])) is None:
            continue
        feature, value = found
        left = points[rows, feature] <= value
        leaves[leaf] = rows[left]
        leaves.append(rows[~left])
        node, link = owner[leaf]
        nodes[node] = tuple(len(nodes) if i == link else x for i, x in enumerate(nodes[node]))
        owner[leaf] = len(nodes), 2
        owner.append((len(nodes), 3))
        nodes.append((feature, value, -1 - leaf, -len(leaves)))
        for i in (leaf, len(leaves) - 1):
            heapq.heappush(todo, (-len(leaves[i]), i))
    return leaves, nodes


def _leaf_of(points: np.ndarray, nodes: list[tuple[int, float, int, int]]) -> np.ndarray:
    feature, value, left, right = (np.array(x) for x in zip(*nodes))
    at, live = np.zeros(len(points), np.int64), np.arange(len(points))
    while len(live):
        own = at[live]
        at[live] = np.where(points[live, feature[own]] <= value[own], left[own], right[own])
        live = live[at[live] >= 0]
    return -1 - at


def _gaps(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(rows, boxes) squared distances; nan where a value isn't a number."""
    total = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d]
        if (low[:, d] == low[0, d]).all() and (high[:, d] == high[0, d]).all():
            gap = np.maximum(np.maximum(low[0, d] - x, x - high[0, d]), 0)
            if gap.any():
                total += (gap ** 2)[:, None]
            continue
        gap = np.maximum(low[None, :, d] - x[:, None], x[:, None] - high[None, :, d])
        np.maximum(gap, 0, out=gap)
        total += np.square(gap, out=gap)
    return total


def _squared_distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Summed in element order, so results do not depend on blocking."""
    total = np.zeros((len(queries), len(points)))
    for d in range(queries.shape[1]):
        total += (queries[:, d, None] - points[None, :, d]) ** 2
    return total


def _first(rows: np.ndarray, places: np.ndarray, distance: np.ndarray, k: int) -> np.ndarray:
    """Where the k nearest of each row stand, by row."""
    order = np.lexsort((places, distance, rows))
    rows = rows[order]
    return order[np.arange(len(rows)) - np.searchsorted(rows, rows) < k]


def nearest(queries: np.ndarray, points: np.ndarray, k: int, reach: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, squared distance) of the k nearest points of each query, equal distances by the point's place.

    A product of matrices leaves those that rounding allows among the k; only their distances
    are summed up. Values that are no finite numbers are compared one by one. reach: squared distances beyond which
    points may be left out.
    """
    out = []
    own = np.einsum("ij,ij->i", points, points)
    for start in range(0, len(queries), VISIT_CHUNK):
        q = queries[start:start + VISIT_CHUNK]
        norm = np.einsum("ij,ij->i", q, q)
        if len(points) <= k or not (np.isfinite(own).all() and np.isfinite(norm).all()):
            distance = _squared_distances(q, points)
            picked = np.argsort(distance, axis=1, kind="stable")[:, :k]
            rows = np.repeat(np.arange(len(q)), picked.shape[1])
            picked = picked.ravel()
            out.append((rows + start, picked, distance[rows, picked]))
            continue
        about = own - 2 * (q @ points.T)
        slack = 32 * (points.shape[1] + 4) * np.finfo(float).eps * (norm + own.max())
        if reach is not None and np.isfinite(own_reach := reach[start:start + VISIT_CHUNK]).all():
            limit = own_reach - norm + slack
        else:
            limit = np.partition(about, k - 1, axis=1)[:, k - 1] + slack
        rows, picked = np.nonzero(about <= limit[:, None])
        distance = np.zeros(len(rows))
        for d in range(points.shape[1]):
            distance += (q[rows, d] - points[picked, d]) ** 2
        order = _first(rows, picked, distance, k)
        out.append((rows[order] + start, picked[order], distance[order]))
    return tuple(np.concatenate(parts) for parts in zip(*out))


def search(queries: np.ndarray, points: np.ndarray, k: int, reach: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What nearest gives, of points within reach at least, without comparing what boxes keep apart."""
    if len(points) <= LEAVES * LEAF_ROWS:
        return nearest(queries, points, k)
    leaves, _ = _cut(points, LEAF_ROWS)
    low, high = (np.array([f(points[rows], axis=0) for rows in leaves]) for f in (np.min, np.max))
    out = []
    for group in _cut(queries, GROUP_ROWS)[0]:
        q = queries[group]
        ends = q.min(axis=0), q.max(axis=0)
        far = np.nan_to_num((np.maximum(np.maximum(low - ends[1], ends[0] - high), 0) ** 2).sum(axis=1))
        centre = ((low + high - ends[0] - ends[1]) ** 2).sum(axis=1)
        order = np.lexsort((centre, far))
        limit = np.full(len(q), np.inf) if reach is None else reach[group]
        rows, places, distance = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        for at in range(0, len(order), LEAVES):
            some = order[at:at + LEAVES]
            some = some[far[some] <= limit.max() * (1 + SLACK)]
            if not len(some):
                break
            meets = ~(_gaps(q, low[some], high[some]) > limit[:, None] * (1 + SLACK))
            asks = np.flatnonzero(meets.any(axis=1))
            if not len(asks):
                continue
            held = np.sort(np.concatenate([leaves[i] for i in some[meets.any(axis=0)]]))
            own, picked, new = nearest(q[asks], points[held], k, limit[asks])
            rows, places, distance = (np.concatenate(x) for x in ((rows, asks[own]), (places, held[picked]), (distance, new)))
            best = _first(rows, places, distance, k)
            rows, places, distance = rows[best], places[best], distance[best]
            counts = np.bincount(rows, minlength=len(q))
            full = np.flatnonzero(counts == k)
            limit[full] = np.fmin(limit[full], distance[np.cumsum(counts)[full] - 1])
        out.append((group[rows], places, distance))
    rows, places, distance = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((places, distance, rows))
    return rows[order], places[order], distance[order]


@dataclass
class KnnModel:
    """Training rows (id, features, label, cell) and their summary.

    rows is held by Spark; one row per cell, with its box, is the only part the driver sees.
    """

    rows: DataFrame
    k: int
    block_rows: int = BLOCK_ROWS

    def __post_init__(self):
        first = self.rows.first()
        features = range(len(first["features"]))
        ends = [F.array(*[f(F.get("features", F.lit(i))) for i in features]).alias(name) for f, name in ((F.min, "low"), (F.max, "high"))]
        self.cells = [r.asDict() for r in self.rows.groupBy("cell").agg(F.count("*").alias("n"), *ends).orderBy("cell").collect()]

    def classify(self, queries: DataFrame, id_col: str, features: str) -> DataFrame:
        """(id, prediction) per query, ids being unique: majority of the k nearest, ties go to
        the smaller label; equal distances go to the smaller training id."""
        nearest = self.neighbours(queries, id_col, features)
        votes = nearest.groupBy("query_id", "label").agg(F.count("*").alias("votes"))
        best = votes.groupBy("query_id").agg(
            F.min_by("label", F.struct((-F.col("votes")).alias("v"), F.col("label"))).alias("prediction"))
        return best.withColumnRenamed("query_id", id_col)

    def neighbours(self, queries: DataFrame, id_col: str, features: str) -> DataFrame:
        """(query_id, train_id, distance, label) of the k nearest rows."""
        spark = self.rows.sparkSession
        asked = queries.select(F.col(id_col).alias("query_id"), F.col(features).alias("features"))
        path = scratch_path(spark, "knn-visits")
        asked.withColumn("cell", self._own_cell()(F.col("features"))).withColumn("reach", F.lit(None).cast("double")) \
            .write.parquet(f"{path}/own")
        own = spark.read.parquet(f"{path}/own")
        self._compared(own).write.parquet(f"{path}/near")
        near = spark.read.parquet(f"{path}/near")
        reach = near.groupBy("query_id").agg(F.max_by("distance", "rank").alias("reach"), F.count("*").alias("n")) \
            .select("query_id", F.when(F.col("n") >= self.k, F.col("reach")).alias("reach"))
        (own.drop("reach").join(reach, "query_id", "left")
         .withColumn("visit", F.explode(self._others()(F.col("features"), F.col("reach"))))
         .filter("visit <> cell").select("query_id", "features", F.col("visit").alias("cell"), "reach")
         .write.parquet(f"{path}/others"))
        every = near.unionByName(self._compared(spark.read.parquet(f"{path}/others")))
        ranked = Window.partitionBy("query_id").orderBy("distance", "train_id", "label")
        return every.withColumn("rank", F.row_number().over(ranked)).filter(f"rank <= {self.k}").drop("rank")

    def _compared(self, visits: DataFrame) -> DataFrame:
        """(query_id, train_id, distance, label, rank) of the k nearest rows in the visited cells."""
        demand = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}
        blocks = self.rows.sparkSession.createDataFrame([
            (c["cell"], math.ceil(c["n"] / self.block_rows), math.ceil(demand[c["cell"]] / self.block_rows))
            for c in self.cells if c["cell"] in demand
        ], "cell int, train_blocks int, query_blocks int")
        # The joined table has a row for each cell, MAX_CELLS at most.

        def blocked(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
            # Own block by hash of the id, one copy per block of the other side.
            return (df.join(F.broadcast(blocks), "cell")
                    .withColumn(f"{own}_block", F.pmod(F.xxhash64(key), f"{own}_blocks").cast("int"))
                    .withColumn(f"{other}_block", F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)))
                    .drop("train_blocks", "query_blocks"))

        left = blocked(visits, "query_id", "query", "train")
        right = blocked(self.rows.select("id", "features", "label", "cell"), "id", "train", "query")
        k = self.k

        def nearest_in_block(q: pa.Table, t: pa.Table) -> pa.Table:
            if not len(q) or not len(t):
                return pa.table({"query_id": q.column("query_id").slice(0, 0), "train_id": t.column("id").slice(0, 0),
                                 "distance": pa.array([], pa.float64()), "label": t.column("label").slice(0, 0)})
            # Rows sorted by id: ties keep the smaller id.
            t = t.sort_by([("id", "ascending"), ("label", "ascending")])
            reach = q.column("reach").to_numpy(zero_copy_only=False).astype(np.float64)
            rows, picked, distance = search(_points(q), _points(t), k, np.where(np.isnan(reach), np.inf, reach))
            return pa.table({"query_id": q.column("query_id").take(pa.array(rows)), "train_id": t.column("id").take(pa.array(picked)),
                             "distance": pa.array(distance), "label": t.column("label").take(pa.array(picked))})

        keys = ["cell", "query_block", "train_block"]
        label_type = self.rows.schema["label"].dataType.simpleString()
        query_type = visits.schema["query_id"].dataType.simpleString()
        local = (left.groupBy(*keys).cogroup(right.groupBy(*keys))
                 .applyInArrow(nearest_in_block,
                               f"query_id {query_type}, train_id bigint, distance double, label {label_type}"))
        ranked = Window.partitionBy("query_id").orderBy("distance", "train_id", "label")
        return local.withColumn("rank", F.row_number().over(ranked)).filter(f"rank <= {k}")

    def _boxes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell, least, largest value of each feature) by cell."""
        low, high = (np.array([c[x] for c in self.cells], dtype=np.float64) for x in ("low", "high"))
        return np.array([c["cell"] for c in self.cells]), low, high

    def _own_cell(self):
        """The cell with the nearest box, of equal ones the one with the nearest middle."""
        index, low, high = self._boxes()

        @F.pandas_udf("int")
        def own_cell(series: pd.Series) -> pd.Series:
            found = []
            for start in range(0, len(series), VISIT_CHUNK):
                points = _matrix(series.iloc[start:start + VISIT_CHUNK])
                found.extend(index[np.nan_to_num(_gaps(points, low, high), nan=np.inf).argmin(axis=1)].tolist())
            return pd.Series(found, dtype="int32")

        return own_cell

    def _others(self):
        """Every cell that may hold a neighbour within the query's reach (NULL: unknown)."""
        index, low, high = self._boxes()

        @F.pandas_udf("array<int>")
        def cells_to_visit(series: pd.Series, reaches: pd.Series) -> pd.Series:
            visits = []
            known = np.nan_to_num(reaches.to_numpy(dtype=np.float64, na_value=np.nan), nan=np.inf)
            for start in range(0, len(series), VISIT_CHUNK):
                points = _matrix(series.iloc[start:start + VISIT_CHUNK])
                keep = ~(_gaps(points, low, high) > known[start:start + VISIT_CHUNK, None] * (1 + SLACK))
                visits.extend(index[row].tolist() for row in keep)
            return pd.Series(visits, dtype=object)

        return cells_to_visit

    def save(self, path: str) -> None:
        spark = self.rows.sparkSession
        self.rows.write.mode("overwrite").parquet(f"{path}/rows")
        spark.createDataFrame([(self.k,)], "k int").coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> KnnModel:
        rows = spark.read.parquet(f"{path}/rows")
        if "pivot" in rows.columns:  # as models were stored before: the cells of pivots have boxes too
            rows = rows.select("id", "features", "label", F.col("pivot").alias("cell"))
        return KnnModel(rows, spark.read.parquet(f"{path}/settings").first()["k"])


def fit_knn(
    df: DataFrame, id_col: str, features: str, label: str, k: int = 5, n_pivots: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> KnnModel:
    """Assign every training row to a cell.

    Cells are cut by the rows with the smallest key hash: spread like the data and
    the same on every run. They only steer the pruning, not the result, and
    their number (n_pivots, by default one for each CELL_ROWS rows) is bounded whatever the size of the data.

    Of training rows with equal features, the k smallest ids always win the
    ties, so the others can never be neighbours and are left out. However many
    copies a row has, k of them are kept; the limit works before the shuffle.

    The assigned rows are written once to the shared folder, as they are read
    several times.
    """
    spark = df.sparkSession
    copies = Window.partitionBy("features").orderBy("id", "label")
    rows = df.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(features).cast("array<double>").alias("features"), F.col(label).alias("label"))
    n_cells = n_pivots or max(8, min(MAX_CELLS, rows.count() // CELL_ROWS))
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(max(1024, CELL_SAMPLE * n_cells)).collect()
    if not picked:
        raise ValueError("no training rows")
    _, nodes = _cut(np.array([r["features"] for r in picked], dtype=np.float64), 1, n_cells)

    @F.pandas_udf("int")
    def cell(series: pd.Series) -> pd.Series:
        return pd.Series(_leaf_of(_matrix(series), nodes) if len(series) else [], dtype="int32")

    path = scratch_path(spark, "knn-rows")
    (rows.withColumn("copy", F.row_number().over(copies)).filter(f"copy <= {k}")
     .select("id", "features", "label", cell("features").alias("cell")).write.parquet(path))
    return KnnModel(spark.read.parquet(path), k, block_rows)
