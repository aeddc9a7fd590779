"""Near-duplicate vectors by sorted projection passes.

A pass gives every vector a key, the signs of its projections on many random
directions one after another, and sorts by it; vectors that are near agree in
a long head of their keys with good probability and so stand near. In sorted
order, a block of OWN vectors is compared with itself and the next WINDOW. The
passes use directions of their own; verified pairs of all passes are united.

That finds components. A component may hold more vectors than a window: its
blocks are then compared with each other, so that each vector's links are
counted in full. Two blocks that lie wholly within or beyond the angle are
counted without looking at pairs.

How many passes a vector needs is measured, not assumed: a pass tells how many
leading bits a key must share with a vector's to stand within WINDOW of it, and so
with what probability a neighbour at the threshold meets it there. A vector whose
neighbours have met it in some pass with a probability of RECALL leaves; the others,
in crowded regions, have more passes among themselves. When more passes would compare
more pairs than there are among those left, or after MAX_PASSES, all of these are
decided in full: they are dealt to cells around pivots, cells in blocks of bounded
size, and blocks meet unless the triangle inequality of angles keeps their cells apart.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and those of another than the commonest length, are linked with
nothing; equal vectors are linked; rows without key are left out; rows repeated
as a whole count as vectors; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innlake.llm import vectors
from innlake.llm.graph import components
from innlake.session import scratch_path

COSINE = 0.95
WINDOW = 256
BITS = 64
RECALL = 0.995
#: Vectors of a block in a pass, and passes at most.
OWN = 1024
MAX_PASSES = 64
#: Vectors that are compared with as many others in one task, and cells at most.
BLOCK = 1024
CELLS = 4096
_SEED = 20240


def passes_for(rows: int, cosine: float = COSINE, window: int = WINDOW, recall: float = RECALL) -> int:
    same_sign = 1 - math.acos(cosine) / math.pi
    meet = same_sign ** max(1.0, math.log2(max(2, rows) / window))
    return max(4, math.ceil(math.log(1 - recall) / math.log(1 - min(meet, 0.9))))


def _units(rows: np.ndarray) -> np.ndarray:
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow in the squares
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _keyed(nodes: DataFrame, length: int, first: int, passes: int) -> DataFrame:
    """(pass, key, node): signs of projections as one sortable number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)
        for batch in batches:
            rows = _units(vectors.matrix(batch.column("vector"), length))
            for i in range(first, first + passes):
                directions = np.random.default_rng([_SEED, i]).standard_normal((length, BITS))
                key = ((rows @ directions > 0) * weights).sum(axis=1, dtype=np.uint64) ^ np.uint64(1 << 63)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), i, np.int32)), pa.array(key.view(np.int64)), batch.column("node")],
                    names=["pass", "key", "node"])

    return nodes.mapInArrow(run, "pass int, key long, node long")


def _ranked(keyed: DataFrame, nodes: DataFrame, partitions: int) -> DataFrame:
    """Blocks of OWN neighbours in the order of (pass, key), and the WINDOW next to them: block, own (false for the
    latter), place, pass, key, node, vector."""
    spark = keyed.sparkSession

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield batch.append_column("part", pa.array(np.full(batch.num_rows, part, np.int32))).append_column(
                "place", pa.array(np.arange(at, at + batch.num_rows)))
            at += batch.num_rows

    order = ["pass", "key", "node"]
    path = scratch_path(spark, "projections")
    keyed.repartitionByRange(partitions, *order).sortWithinPartitions(*order).mapInArrow(
        number, "pass int, key long, node long, part int, place long").write.parquet(path)
    rows = spark.read.parquet(path)
    sizes = rows.groupBy("part").agg(F.count("*").alias("n")).collect()  # one row a partition
    offsets, at = [], 0
    for r in sorted(sizes, key=lambda r: r["part"]):
        offsets.append((r["part"], at))
        at += r["n"]
    begin = spark.createDataFrame(offsets, "part int, offset long")
    rank = F.col("offset") + F.col("place")
    placed = rows.join(F.broadcast(begin), "part").withColumn("block", F.floor(rank / OWN)) \
        .withColumn("place", (rank % OWN).cast("int"))
    own = F.struct(F.col("block").alias("block"), F.lit(True).alias("own"))
    ahead = F.struct((F.col("block") - 1).alias("block"), F.lit(False).alias("own"))
    views = F.when(F.col("place") < WINDOW, F.array(own, ahead)).otherwise(F.array(own))
    columns = ["pass", "key", "place", "node"]
    # Vectors come in only here, so that neither the sort nor its files hold them once a pass.
    return placed.select(*columns, F.explode(views).alias("v")).select(*columns, "v.*").join(nodes, "node")


def _forest(node: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
    """Of the links of the i-th and j-th nodes, those that join what wasn't joined."""
    root = list(range(len(node)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for a, b in zip(i.tolist(), j.tolist()):
        a_root, b_root = find(a), find(b)
        if a_root != b_root:
            root[b_root] = a_root
            links.append((int(node[a]), int(node[b])))
    return links


def _window_links(length: int, cosine: float):
    """(u, v) of links; and (u, pass, bits): leading bits that node u's key shares with the one WINDOW away."""
    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        own = np.flatnonzero(table.column("own").to_numpy(zero_copy_only=False))
        turn, key = table.column("pass").to_numpy(), table.column("key").to_numpy()
        rows = _units(vectors.matrix(table.column("vector"), length))
        near = rows[own] @ rows.T >= cosine
        near &= turn[own][:, None] == turn[None, :]
        i, j = np.nonzero(near)
        links = _forest(node, own[i], j)
        at = table.column("place").to_numpy().astype(np.int64) + OWN
        at[own] -= OWN
        standing = np.full(OWN + OWN + WINDOW, -1)
        standing[at] = np.arange(len(node))
        a, b = standing[:OWN], standing[WINDOW: OWN + WINDOW]
        both = (a >= 0) & (b >= 0)
        a, b = a[both], b[both]
        same = turn[a] == turn[b]
        a, b = a[same], b[same]
        differ = (key[a] ^ key[b]).view(np.uint64)
        bits = np.array([BITS - int(x).bit_length() for x in differ.tolist()], np.int32)
        u = np.concatenate([np.array([u for u, _ in links], np.int64), node[a], node[b]])
        none = [None] * len(links)
        return pa.table({
            "u": pa.array(u, pa.int64()), "v": pa.array([v for _, v in links] + [None] * (2 * len(a)), pa.int64()),
            "pass": pa.array(none + turn[a].tolist() + turn[b].tolist(), pa.int32()),
            "bits": pa.array(none + bits.tolist() * 2, pa.int32())})
    return run


def _all_links(length: int, cosine: float):
    """Links between the blocks `one` and `two`, or inside a block."""
    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        block = table.column("block").to_numpy()
        rows = _units(vectors.matrix(table.column("vector"), length))
        a = np.flatnonzero(block == table.column("one")[0].as_py())
        b = np.flatnonzero(block == table.column("two")[0].as_py())
        i, j = np.nonzero(rows[a] @ rows[b].T >= cosine)
        links = _forest(node, a[i], b[j])
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())})
    return run


def _angles(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(rows @ pivots.T, -1.0, 1.0))


def meeting_cells(pivots: np.ndarray, radius: np.ndarray, limit: float) -> list[list[int]]:
    """For each cell those, itself included, that may hold a vector within the angle `limit` of one of its own."""
    return [np.flatnonzero(_angles(pivots[i: i + 1], pivots)[0] - radius - radius[i] <= limit + 1e-6).tolist()
            for i in range(len(pivots))]


def _full_links(rest: DataFrame, n: int, length: int, cosine: float) -> DataFrame:
    """(u, v) that connect the components of n nodes (node, vector), from all pairs that may be links."""
    spark = rest.sparkSession
    drawn = rest.orderBy(F.xxhash64("node")).limit(min(CELLS, math.ceil(n / BLOCK))).collect()
    pivots = _units(np.array([r["vector"] for r in drawn], np.float64))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                angles = _angles(_units(vectors.matrix(part.column("vector"), length)), pivots)
                cell = angles.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), part.column("vector"), pa.array(cell.astype(np.int32)), pa.array(angles.min(axis=1))],
                    names=["node", "vector", "cell", "angle"])

    path = scratch_path(spark, "cells")
    kind = rest.schema["vector"].dataType.simpleString()
    rest.mapInArrow(place, f"node long, vector {kind}, cell int, angle double").write.parquet(path)
    placed = spark.read.parquet(path)
    sizes = {r["cell"]: r for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("far")).collect()}
    radius = np.array([sizes[i]["far"] if i in sizes else -math.inf for i in range(len(pivots))])  # CELLS rows at most
    first, blocks, at = {}, {}, 0
    for i in sorted(sizes):
        first[i], blocks[i] = at, math.ceil(sizes[i]["n"] / BLOCK)
        at += blocks[i]
    meets = {i: [j for j in others if j in sizes] for i, others in enumerate(meeting_cells(pivots, radius, math.acos(cosine)))
             if i in sizes}
    shared = spark.sparkContext.broadcast((first, blocks, meets))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, count, near = shared.value
        others = {c: np.concatenate([np.arange(begin[x], begin[x] + count[x]) for x in cells]) for c, cells in near.items()}
        for batch in batches:
            cells, deal = batch.column("cell").to_pylist(), batch.column("deal").to_pylist()
            for at in range(0, len(cells), 256):
                part = range(at, min(at + 256, len(cells)))
                theirs = [others[cells[i]] for i in part]
                sizes = [len(x) for x in theirs]
                mine = np.repeat([begin[cells[i]] + deal[i] % count[cells[i]] for i in part], sizes)
                row, their = np.repeat(list(part), sizes), np.concatenate(theirs)
                for first_row in range(0, len(row), 8192):
                    some = slice(first_row, first_row + 8192)
                    rows = batch.select(["node", "vector"]).take(pa.array(row[some]))
                    yield pa.RecordBatch.from_arrays(
                        [*rows.columns, pa.array(mine[some]), pa.array(np.minimum(mine, their)[some]),
                         pa.array(np.maximum(mine, their)[some])], names=["node", "vector", "block", "one", "two"])

    spread = placed.withColumn("deal", F.pmod(F.xxhash64("node"), F.lit(1 << 30)).cast("long")) \
        .mapInArrow(dealt, f"node long, vector {kind}, block long, one long, two long")
    return spread.groupBy("one", "two").applyInArrow(_all_links(length, cosine), "u long, v long")


def _links(nodes: DataFrame, n: int, length: int, cosine: float) -> DataFrame:
    """(u, v) that connect the components of nodes (node, vector)."""
    spark = nodes.sparkSession
    same_sign = 1 - math.acos(cosine) / math.pi
    goal = math.log(1 - RECALL)
    found, done, left = spark.createDataFrame([], "u long, v long"), 0, n
    passes, rest = passes_for(n, cosine), nodes
    spent = None  # (node, missed): logarithm of the probability that a neighbour hasn't met the node
    while left:
        path = scratch_path(spark, "windows")
        blocks = _ranked(_keyed(rest, length, done, passes), rest, 1 + left * passes // 500_000)
        blocks.groupBy("block").applyInArrow(
            _window_links(length, cosine), "u long, v long, pass int, bits int").write.parquet(path)
        seen = spark.read.parquet(path)
        found = found.unionByName(seen.filter("v is not null").select("u", "v"))
        need = F.max("bits") + 1
        miss = seen.filter("v is null").groupBy(F.col("u").alias("node"), "pass").agg(need.alias("bits")) \
            .withColumn("missed", F.log(1 - F.pow(F.lit(same_sign), "bits"))) \
            .groupBy("node").agg(F.sum("missed").alias("missed"))
        # A node without a row has all others of its pass within its window.
        whole = rest.select("node").join(miss, "node", "left").select("node", F.coalesce("missed", F.lit(2 * goal)).alias("missed"))
        if spent is not None:
            before = spent.filter(F.col("missed") > goal).withColumnRenamed("missed", "earlier")
            whole = whole.join(before, "node").select("node", (F.col("missed") + F.col("earlier")).alias("missed"))
        path = scratch_path(spark, "missed")
        whole.write.parquet(path)
        spent = spark.read.parquet(path)
        done += passes
        open_ = spent.filter(F.col("missed") > goal)
        left, middle = open_.agg(F.count("*"), F.percentile_approx("missed", 0.5)).first()
        rest = nodes.join(open_.select("node"), "node")
        if not left:
            break
        more = math.ceil(done * (goal / middle - 1)) if middle < 0 else MAX_PASSES
        if done + more > MAX_PASSES or 2 * more * (OWN + WINDOW) >= left:
            return found.unionByName(_full_links(rest, left, length, cosine))
        passes = max(4, min(32, more))
    return found


def _counted(length: int, cosine: float):
    """Links of each node by the nodes of a task; `weight` vectors share a node."""
    limit = math.acos(cosine)

    def linked(a: np.ndarray, b: np.ndarray) -> np.ndarray | bool:
        """Pairs that are linked; one truth value if it is the same for all."""
        centre_a, centre_b = a.mean(axis=0), b.mean(axis=0)
        size_a, size_b = np.linalg.norm(centre_a), np.linalg.norm(centre_b)
        if size_a > 0.5 and size_b > 0.5:
            centre_a, centre_b = centre_a / size_a, centre_b / size_b
            reach = sum(math.acos(min(1.0, max(-1.0, float((x @ c).min())))) for x, c in ((a, centre_a), (b, centre_b)))
            apart = math.acos(min(1.0, max(-1.0, float(centre_a @ centre_b))))
            if apart + reach < limit - 1e-6:
                return True
            if apart - reach > limit + 1e-6:
                return False
        return a @ b.T >= cosine

    def run(table: pa.Table) -> pa.Table:
        problem, block = table.column("problem").to_numpy(), table.column("block").to_numpy()
        order = np.lexsort((block, problem))
        table = table.take(pa.array(order))
        problem, block = problem[order], block[order]
        node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
        pair = (table.column("one")[0].as_py(), table.column("two")[0].as_py())
        rows = _units(vectors.matrix(table.column("vector"), length))
        count = np.zeros(len(node), np.int64)
        heads = np.flatnonzero(np.diff(problem, prepend=problem[0] - 1))
        for first, last in zip(heads, np.append(heads[1:], len(problem))):
            if pair[0] == pair[1]:
                halves = [(slice(first, last), slice(first, last))]
            else:
                middle = first + int(np.searchsorted(block[first:last], pair[1]))
                halves = [(slice(first, middle), slice(middle, last)), (slice(middle, last), slice(first, middle))]
            for mine, theirs in halves:
                for at in range(mine.start, mine.stop, 256):
                    part = slice(at, min(at + 256, mine.stop))
                    if part.stop == part.start or theirs.stop == theirs.start:
                        continue
                    near = linked(rows[part], rows[theirs])
                    count[part] += weight[theirs].sum() if near is True else 0 if near is False else near @ weight[theirs]
                    if mine == theirs and near is not False:
                        me = np.arange(part.start, part.stop)
                        met = np.ones(len(me), bool) if near is True else near[me - part.start, me - theirs.start]
                        count[part] -= np.where(met, weight[me], 0)  # copies are added once, by the caller
        return pa.table({"node": pa.array(node), "links": pa.array(count)})
    return run


def near_duplicates(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """key, n_links and component_id of every row with a key."""
    spark = rows.sparkSession
    length = vectors.usual_length(rows, vector)
    every = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("own"), F.col(vector).alias("vector"))
    usable = vectors.sound("vector") & (F.size("vector") == length) & F.exists("vector", lambda x: x != 0)
    # Copies share a node: adding zero makes -0.0 and 0.0 one.
    node = F.when(F.coalesce(usable, F.lit(False)), F.xxhash64(F.transform("vector", lambda x: x + F.lit(0).cast("float"))))
    named = every.withColumn("node", node)
    path = scratch_path(spark, "vectors")
    named.filter("node is not null").groupBy("node").agg(
        F.count("*").alias("weight"), F.min("own").alias("least"), F.first("vector").alias("vector")).write.parquet(path)
    nodes = spark.read.parquet(path)
    n = nodes.count()
    if n == 0:
        return every.select(F.col("own").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("own").alias("component_id"))
    found = components(_links(nodes.select("node", "vector"), n, length, cosine))

    sizes = found.groupBy("component").agg(F.count("*").alias("n"))
    placed = found.join(sizes, "component").join(nodes, "node") \
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")) \
        .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    tasks = 1 + n // BLOCK
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "node", "weight", "vector", F.col("component").alias("problem"), "block", (F.col("blocks") == 1).alias("alone"),
        F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(tasks))).otherwise(F.col("component")).alias("task"),
        F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    counts = met.groupBy("task", "alone", "one", "two").applyInArrow(
        _counted(length, cosine), "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))

    joined = nodes.select("node", "weight", "least").join(found, "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    first = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = joined.join(first, "component").join(counts, "node", "left").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    return named.select("own", "node").join(facts, "node", "left").select(
        F.col("own").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "own").alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all `embeddings`."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return found.withColumn("component_id", F.col("component_id").cast("long")) \
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
