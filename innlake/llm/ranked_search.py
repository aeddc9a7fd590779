"""The best documents for each item by summed term weights, found in tries of documents.

One pass over the texts keeps of each document the number of its terms and its tf
of the terms that some item has. Counts over all documents then give weights.
Each task reads its documents' vectors, some SHARD_ENTRIES entries at a time,
numbers terms by falling frequency, builds a trie (`doc_tree`) and takes all items
through it, depth-first with bounds; a score that an item has reached in one trie
bounds the next. What leaves a task is k rows an item.

Items come in blocks of BLOCK_TERMS terms in all (an item with more is a block
of its own); a block's terms, their frequencies and the items go to the driver
and all tasks, which that number bounds. Each block reads the texts once.

Terms are maximal runs of ASCII letters and digits and of signs beyond ASCII,
A-Z lower-cased; they are told apart by 64-bit hashes. All arithmetic on scores is on
64-bit integers. Keys are integers.

Defined results: null text has no terms; documents without terms count nowhere;
documents without key count in the statistics and are never returned; a document with
score 0 isn't returned; equal scores go by key; repeated documents are ranked each;
texts of one item id are one item, repeated rows once; items without id, or
without terms that a document has, return nothing; other columns are ignored; empty
tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from innlake.llm import units
from innlake.llm.doc_tree import DocTree
from innlake.session import scratch_path

K = 20
BLOCK_TERMS = 500_000
SHARD_ENTRIES = 1_000_000

#: Bytes outside of terms read as white space.
_TERM = np.arange(256, dtype=np.uint8)
_TERM[:0x30] = _TERM[0x3A:0x41] = _TERM[0x5B:0x61] = _TERM[0x7B:0x80] = 0x20


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each term, term offsets of the texts)."""
    return units.words(_TERM[data], offsets, units.LOWER_CODES)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _texts(rows: DataFrame, key: str, text: str) -> DataFrame:
    return rows.select(F.col(key).cast("long").alias("own"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("body"))


def _items(items: DataFrame, key: str, text: str) -> DataFrame:
    """own, n (distinct terms), hashes and counts (64-bit numbers) of every item with terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, ends = terms(*units.flat(batch.column("body")))
            found = [np.unique(hashes[a:z], return_counts=True) for a, z in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("own"), pa.array([len(h) for h, _ in found], pa.int64()),
                 pa.array([h.tobytes() for h, _ in found], pa.binary()),
                 pa.array([c.astype(np.int64).tobytes() for _, c in found], pa.binary())],
                names=["own", "n", "hashes", "counts"])

    one = items.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("own")).agg(
        F.array_join(F.array_sort(F.collect_set(text)), " ").alias("body"))
    return _texts(one, "own", "body").mapInArrow(run, "own long, n long, hashes binary, counts binary").filter("n > 0")


def vectors(docs: DataFrame, vocabulary: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """own, n (terms with repeats) and vector of every document with terms.

    vector holds pairs of 32-bit numbers, the place of a term in the sorted hashes `vocabulary` and its tf, by place.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            data, offsets = units.flat(batch.column("body"))
            for first, chunk, own in units.chunks(data, offsets):
                hashes, ends = terms(chunk, own)
                place = np.searchsorted(known, hashes)
                place[place == len(known)] = 0
                hit = np.flatnonzero(known[place] == hashes)
                n = np.diff(ends)
                doc = np.repeat(np.arange(len(n)), n)[hit]
                pairs, tf = np.unique(doc * len(known) + place[hit], return_counts=True)
                flat = np.stack([pairs % len(known), tf], axis=1).astype("<u4")
                cuts = np.searchsorted(pairs, np.arange(len(n) + 1) * len(known)) * 8
                use = pa.array(n > 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("own").slice(first, len(n)), pa.array(n.astype(np.int64)),
                     pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(flat)])],
                    names=["own", "n", "vector"]).filter(use)

    return _texts(docs, key, text).mapInArrow(run, "own long, n long, vector binary")


def _frequencies(known: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of a vocabulary of the given size."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            pairs = units.flat(batch.column("vector"))[0].view("<u4").reshape(-1, 2)
            total += np.bincount(pairs[:, 0], minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for r in known.select("vector").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


def _shards(batches: Iterator[pa.RecordBatch], rank: np.ndarray, n_docs: int, n_terms: int) -> Iterator[DocTree]:
    """Tries of the documents of a task."""
    held: list[pa.RecordBatch] = []
    size = 0

    def tree() -> DocTree:
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        raw, offsets = units.flat(table.column("vector"))
        pairs, offsets = raw.view("<u4").reshape(-1, 2), offsets // 8
        n = table.column("n").to_numpy()
        owner = np.repeat(np.arange(len(n)), np.diff(offsets))
        own_rank = rank[pairs[:, 0]]
        order = np.argsort(owner * len(rank) + own_rank)
        m = 75 + 25 * n * n_docs // n_terms
        return DocTree(table.column("own").to_numpy(), m, offsets, own_rank[order], pairs[order, 1])

    for batch in batches:
        at = 0
        sizes = np.diff(units.flat(batch.column("vector"))[1]) // 8
        ends = np.cumsum(sizes)
        while at < len(sizes):
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + SHARD_ENTRIES - size, side="right")))
            held.append(batch.slice(at, stop - at))
            size += int(ends[stop - 1]) - before
            at = stop
            if size >= SHARD_ENTRIES or at < len(sizes):
                yield tree()
                held, size = [], 0
    if held:
        yield tree()


def _block(docs: DataFrame, block: list, k: int, key: str, text: str) -> DataFrame:
    """item, own and score: each task's k best documents of the items (own, hashes, counts) of a block."""
    spark = docs.sparkSession
    vocabulary = np.unique(np.concatenate([h for _, h, _ in block]))
    path = scratch_path(spark, "term-vectors")
    vectors(docs, vocabulary, key, text).write.parquet(path)
    known = spark.read.parquet(path)
    n_docs, n_terms = known.agg(F.count("*"), F.sum("n")).first()
    df = _frequencies(known, len(vocabulary))
    rank = np.empty(len(vocabulary), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(vocabulary))
    asks = []
    for own, hashes, counts in block:
        place = np.searchsorted(vocabulary, hashes)
        held = df[place] > 0
        weights = np.array([weight(n_docs, int(d)) for d in df[place[held]]], np.int64) * counts[held]
        asks.append((own, rank[place[held]], weights))
    shared = spark.sparkContext.broadcast((asks, rank, n_docs, n_terms))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, order, docs_n, terms_n = shared.value
        none = np.zeros(0, np.int64)
        best = [(none, none)] * len(items)
        for tree in _shards(batches, order, docs_n, terms_n):
            for i, (_, own, weights) in enumerate(items):
                best[i] = tree.search(own, weights, k, best[i])
        sizes = [len(ids) for ids, _ in best]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array([own for own, _, _ in items], np.int64), sizes)),
             pa.array(np.concatenate([ids for ids, _ in best])), pa.array(np.concatenate([s for _, s in best]))],
            names=["item", "own", "score"])

    return known.filter("own is not null and octet_length(vector) > 0").mapInArrow(search, "item long, own long, score long")


def top_k(docs: DataFrame, items: DataFrame, k: int = K, key: str = "doc_id", text: str = "text",
          item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id and score (under the given names of the keys) of the k best documents for each item."""
    spark = docs.sparkSession
    path = scratch_path(spark, "items")
    _items(items, item_key, item_text).write.parquet(path)
    asked = spark.read.parquet(path)
    sizes = asked.select("own", "n").orderBy("own").collect()  # one row an item
    blocks: list[list[int]] = []
    room = 0
    for r in sizes:
        if not blocks or r["n"] > room:
            blocks.append([])
            room = BLOCK_TERMS
        blocks[-1].append(r["own"])
        room -= r["n"]
    found = spark.createDataFrame([], "item long, own long, score long")
    for owns in blocks:
        rows = asked.filter(F.col("own").between(owns[0], owns[-1])).orderBy("own").collect()
        block = [(r["own"], np.frombuffer(r["hashes"], np.uint64), np.frombuffer(r["counts"], np.int64)) for r in rows]
        found = found.unionByName(_block(docs, block, k, key, text))
    best = Window.partitionBy("item").orderBy(F.desc("score"), "own")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        F.col("item").cast(items.schema[item_key].dataType).alias(item_key), "rank",
        F.col("own").cast(docs.schema[key].dataType).alias(key), "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best of all `documents` for every item of `benchmark`."""
    return top_k(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
