"""Best-fit packing of documents into sequences, without conflicts inside a sequence.

A sequence (bin) holds pieces of at most `capacity` tokens in all, no two of the
same source and no two of the same duplicate cluster. Bins stand in order of
the room left, and each carries bitmaps of the sources and clusters it holds; a
piece goes to the tightest bin that it fits and doesn't conflict with: the
search starts at the first bin with room enough and goes on to the next until
one is compatible. Pieces are taken longest first.

A document longer than a bin is cut; its full pieces are bins of their own (with
negative numbers), the rest is packed like any document. Packing is independent in
groups that rows are dealt to by a hash, of about GROUP_PIECES pieces whatever the
table's size, and full pieces have groups of their own, so hot sources, repeated
rows and long documents spread evenly and no group grows with the input.

Defined results: a null source or cluster conflicts with nothing; documents
without tokens are left out; equal lengths are ordered by key, then piece; rows
repeated are packed each; columns other than those named are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CAPACITY = 2048
GROUP_PIECES = 4096


def pack(items: list[tuple[int, object, object]], capacity: int) -> list[tuple[int, int]]:
    """(bin, start in the bin) for items of (size, source, cluster), longest first."""
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(s for _, s, _ in items if s is not None))}
    cluster_bit = {c: 1 << i for i, c in enumerate(dict.fromkeys(c for _, _, c in items if c is not None))}
    sources, clusters = [], []
    order: list[tuple[int, int]] = []  # (room left, bin), ascending; full bins leave
    placed = []
    for size, source, cluster in items:
        s, c = source_bit.get(source, 0), cluster_bit.get(cluster, 0)
        at = bisect_left(order, (size, -1))
        while at < len(order) and (sources[order[at][1]] & s or clusters[order[at][1]] & c):
            at += 1
        if at < len(order):
            room, bin_ = order.pop(at)
        else:
            room, bin_ = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[bin_] |= s
        clusters[bin_] |= c
        placed.append((bin_, capacity - room))
        if room > size:
            insort(order, (room - size, bin_))
    return placed


def packed(docs: DataFrame, tokens: Column, cluster: Column, capacity: int = CAPACITY, key: str = "doc_id",
           source: str = "source", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row for each piece: key, piece, start and n_tokens (in the document), bin, position (in the bin).

    tokens: expression for a document's length; cluster: expression for its duplicate cluster.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("own"), F.col(source).cast("string").alias("source"),
                       cluster.cast("long").alias("cluster"), tokens.cast("long").alias("size")).filter("size > 0")
    pieces = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / capacity)))) \
        .withColumn("start", F.col("piece") * capacity) \
        .withColumn("length", F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("start")))
    # Of a place in the table, not of the row alone: rows repeated as a whole spread, too.
    pieces = pieces.withColumn("at", F.monotonically_increasing_id())
    full = F.col("length") == capacity
    n = pieces.agg(F.count_if(~full).alias("partial"), F.count_if(full).alias("full")).first()
    place = F.xxhash64("own", "cluster", "piece", "at")
    group = F.when(full, -1 - F.pmod(place, F.lit(1 + n["full"] // group_pieces))).otherwise(
        F.pmod(place, F.lit(1 + n["partial"] // group_pieces)))

    def run(table: pa.Table) -> pa.Table:
        own, piece = table.column("own").to_pylist(), table.column("piece").to_pylist()
        length = table.column("length").to_pylist()
        order = sorted(range(len(own)), key=lambda i: (-length[i], own[i] is None, 0 if own[i] is None else own[i], piece[i]))
        source, cluster = table.column("source").to_pylist(), table.column("cluster").to_pylist()
        found = pack([(length[i], source[i], cluster[i]) for i in order], capacity)
        group = table.column("group")[0].as_py()
        return table.take(order).select(["own", "piece", "start", "length"]).append_column(
            "bin", pa.array([(group << 32) | b for b, _ in found], pa.int64())).append_column(
            "position", pa.array([p for _, p in found], pa.int64()))

    return pieces.withColumn("group", group) \
        .select("group", "own", "source", "cluster", "piece", "start", "length") \
        .groupBy("group").applyInArrow(
            run, f"own {kind}, piece long, start long, length long, bin long, position long") \
        .withColumnsRenamed({"own": key, "length": "n_tokens"})


def _words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def _cluster(text: str = "text") -> Column:
    """Texts that agree in their letters and digits, whatever their case."""
    return F.xxhash64(F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}]+", ""))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of 2,048 words from all `documents`."""
    return packed(spark.read.parquet(f"{sf_dir}/documents.parquet"), _words(), _cluster())


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: pieces of what its predecessor kept; documents without words are in none."""
    return packed(docs, _words(), _cluster())
