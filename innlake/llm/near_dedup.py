"""Near-duplicate documents by MinHash.

1. Every document's set of word shingles gets a name (equal sets, one name) and
   a signature of least universal hashes. Copies are one node from here on.
2. Nodes that agree in all minima of a band are linked with the least of them;
   the components of these candidate links are disjoint problems.
3. A problem's nodes meet once, with their full sets; a larger problem is cut
   into blocks, every two of which meet. Inside, pairs are taken by falling
   agreement of signatures, pairs that are connected already are passed over,
   and the rest is decided on the full sets.
4. Components of the confirmed links.

A pair at the threshold of 0.8 shares no band with a probability of 5e-8, and
agrees in fewer than MIN_AGREEMENT minima with one of about 1e-8.

Defined results: text is lower-cased in A-Z only; null text, or text without
words, has an empty set, is linked with nothing and is its own component; fewer
words than a shingle make one shingle; a null key may be a copy but never names
a component unless all keys of it are null; other columns are ignored; rows
repeated as a whole are copies; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innlake.llm import minhash, sketch, units
from innlake.llm.graph import components
from innlake.llm.memory import released
from innlake.session import scratch_path

SHINGLE = 4
PERCENT = 80
MIN_AGREEMENT = 76
#: Nodes in a block of a problem; two blocks meet in a task. Nodes of small problems that share a task, about.
BLOCK = 2048
BLOCK_SMALL = 512


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("body"))


def _signed(docs: DataFrame, size: int) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = units.flat(batch.column("body"))
            for first, hashes, places in minhash.each_set(data, offsets, size):
                n = len(places) - 1
                signs = minhash.signatures(hashes, places)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, n), pa.array(np.diff(places)),
                     pa.array(minhash.set_keys(hashes, places)),
                     pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * minhash.MINIMA), n, [
                         None, pa.py_buffer(signs.tobytes())]).cast(pa.binary())],
                    names=["doc_id", "n_shingles", "node", "signature"])

    return docs.mapInArrow(released(run), f"doc_id {kind}, n_shingles long, node long, signature binary")


def _candidate_links(signed: DataFrame) -> DataFrame:
    """(u, v): nodes that share a band with v, the least such node."""
    step = 4 * minhash.BAND
    bands = F.transform(F.sequence(F.lit(0), F.lit(minhash.BANDS - 1)), lambda i: F.xxhash64(
        i, F.substring("signature", i * step + 1, F.lit(step))))
    rows = signed.select("node", F.explode(bands).alias("band"))
    shared = rows.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most")
    return rows.join(shared, "band").filter("node <> least").select(
        F.col("node").alias("u"), F.col("least").alias("v")).distinct()


def _wanted_sets(docs: DataFrame, wanted: DataFrame, n_wanted: int, size: int) -> DataFrame:
    """(node, members): the sets of wanted nodes, each from its least document.

    A bounded filter of (node, document) is broadcast, so only few texts' sets are shuffled.
    """
    def twice(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            tag = batch.column("tag").to_numpy().view(np.uint64)
            yield np.concatenate([tag, tag])  # the sketch keeps what occurs more than once

    tagged = docs.withColumn("own", F.xxhash64("doc_id"))
    tags = wanted.select(F.col("node").bitwiseXOR(F.xxhash64("least")).alias("tag"))
    shared = docs.sparkSession.sparkContext.broadcast(sketch.build(tags, twice, 2 * n_wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = units.flat(batch.column("body"))
            own = batch.column("own").to_numpy()
            for first, hashes, places in minhash.each_set(data, offsets, size):
                nodes = minhash.set_keys(hashes, places)
                tag = (nodes ^ own[first: first + len(nodes)]).view(np.uint64)
                keep = np.flatnonzero(shared.value.repeated(tag) & (np.diff(places) > 0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[keep]), pa.array([hashes[places[i]: places[i + 1]].tobytes() for i in keep], pa.binary())],
                    names=["node", "members"])

    return tagged.mapInArrow(released(run), "node long, members binary")


def confirmed(nodes: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the nodes."""
    n = len(nodes)
    sizes = np.array([len(s) for s in sets])
    signs = minhash.signatures(np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes)]))
    found = []
    for a in range(0, n, 64):
        agree = np.stack([(signs[a:] == signs[i]).sum(axis=1) for i in range(a, min(n, a + 64))])
        i, j = np.nonzero(agree >= MIN_AGREEMENT)
        small, large = np.minimum(sizes[a + i], sizes[a + j]), np.maximum(sizes[a + i], sizes[a + j])
        keep = (j > i) & (100 * small >= percent * large)
        found.append(np.stack([agree[i, j], i + a, j + a])[:, keep])
    pairs = np.concatenate(found, axis=1)
    pairs = pairs[:, np.argsort(-pairs[0], kind="stable")]
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for _, i, j in pairs.T.tolist():
        a, b = find(i), find(j)
        if a == b:
            continue
        both = np.sort(np.concatenate([sets[i], sets[j]]))
        common = int((both[1:] == both[:-1]).sum())
        if 100 * common >= percent * (len(both) - common):
            root[b] = a
            links.append((int(nodes[i]), int(nodes[j])))
    return links


def _solve(percent: int):
    def run(table: pa.Table) -> pa.Table:
        # A repeated row of a least document brings its node twice.
        order = np.lexsort((table.column("node").to_numpy(), table.column("problem").to_numpy()))
        problem, node = table.column("problem").to_numpy()[order], table.column("node").to_numpy()[order]
        fresh = np.concatenate([[True], (node[1:] != node[:-1]) | (problem[1:] != problem[:-1])])
        order, problem, node = order[fresh], problem[fresh], node[fresh]
        members = table.column("members")
        links = []
        heads = np.flatnonzero(np.diff(problem, prepend=problem[0] - 1))
        for a, z in zip(heads, np.append(heads[1:], len(problem))):
            sets = [np.frombuffer(members[i].as_py(), np.uint64) for i in order[a:z].tolist()]
            links += confirmed(node[a:z], sets, percent)
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array([v for _, v in links], pa.int64())})
    return run


def _links(docs: DataFrame, signed: DataFrame, size: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    problems = components(_candidate_links(signed.filter("n_shingles > 0")))
    least = signed.groupBy(F.col("node")).agg(F.min("doc_id").alias("least"))
    sizes = problems.groupBy("component").agg(F.count("*").alias("n"))
    path = scratch_path(spark, "near-dedup")
    problems.join(least, "node").join(sizes, "component") \
        .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")) \
        .write.parquet(path)
    wanted = spark.read.parquet(path)
    n_wanted = wanted.count()
    sets = _wanted_sets(docs, wanted, n_wanted, size)
    block = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    tasks = 1 + n_wanted // BLOCK_SMALL
    met = wanted.select("node", F.col("component").alias("problem"), "blocks", block.alias("block")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("node", "problem",
                F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("problem"), F.lit(tasks))).otherwise(F.col("problem")).alias("task"),
                "blocks", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    alone = F.col("blocks") == 1
    return met.join(sets, "node").groupBy("task", alone.alias("alone"), "one", "two").applyInArrow(
        _solve(percent), "u long, v long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (least key that is reachable) of every document."""
    rows = _rows(docs, key, text)
    path = scratch_path(docs.sparkSession, "signatures")
    _signed(rows, size).write.parquet(path)
    signed = docs.sparkSession.read.parquet(path)
    linked = components(_links(rows, signed, size, percent))
    own = signed.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = own.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    first = named.groupBy("component").agg(F.min("least").alias("component_id"))
    names = named.join(first, "component").select("node", "component_id")
    filled = signed.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node"))
    return filled.join(names, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all `documents`."""
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that with the least id (null last); shingles of five words."""
    name = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"),
                    F.xxhash64(*docs.columns).alias("row"))
    named = docs.withColumn("own_name", name)
    first = near_duplicates(named, "own_name", "text", size=5).filter("doc_id = component_id").select(
        F.col("doc_id").alias("own_name")).distinct()
    return named.join(first, "own_name", "left_semi").dropDuplicates(["own_name"]).select(*docs.columns)
