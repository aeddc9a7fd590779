"""Removal of long byte strings that occur more than once in a corpus.

Candidates come from anchors (see anchors.py); the contexts of one anchor go to
one shard, where a run-length index (see run_index.py) marks what occurs again.
An anchor with more than HOT_CONTEXTS distinct contexts would not fit a shard;
its windows are grouped one by one over all tasks instead, by the same rule.

Defined results: null text counts as empty; a text shorter than the length
loses nothing; rows repeated as a whole are documents of their own, so their
long texts go; columns other than key and text are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innlake.llm.anchors import Windows, in_slices, keyed, merged, repeated_spans, windows_repeated
from innlake.llm.memory import released
from innlake.llm.run_index import RunIndex

LENGTH = 200
ANCHOR = 32
#: Bytes of context text in a shard, and distinct contexts of one anchor that a shard takes.
SHARD_BYTES = 1 << 20
HOT_CONTEXTS = 4096


def _shard(length: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        index = RunIndex(table.column("body").to_pylist(), length)
        which, start, end = index.repeats(length)
        once = table.column("copies").to_numpy()[which] == 1
        take = pa.array(which[once])
        return pa.table({"anchor": table.column("anchor").take(take), "context": table.column("context").take(take),
                         "offset": pa.array(start[once], pa.int32()), "end": pa.array(end[once], pa.int32())})
    return run


def marked(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
           extra: list[str] | None = None) -> DataFrame:
    """doc_id, body (bytes), extra (a struct of columns, if named) and spans: byte ranges covered by strings of
    `length` that start elsewhere too."""
    shape = Windows(length, min(ANCHOR, length), by_word=False)
    total = docs.agg(F.sum(F.octet_length(F.col(text).cast("binary"))).alias("n")).first()["n"] or 0
    # The contexts of all anchors together are shorter than twice the corpus.
    shards = 1 + 2 * total // SHARD_BYTES

    def refine(texts) -> DataFrame:
        near = texts(f"n_alike <= {HOT_CONTEXTS}").withColumn("shard", F.pmod("anchor", F.lit(shards))) \
            .groupBy("shard").applyInArrow(_shard(length), "anchor long, context long, offset int, end int")
        return near.unionByName(windows_repeated(texts(f"n_alike > {HOT_CONTEXTS}"), shape))

    return repeated_spans(keyed(docs, key, text, extra), shape, refine, "suffix-dedup")


def _cut(body: bytes, spans) -> tuple[list[tuple[int, int]], bytes]:
    runs = merged([(s["start"], s["end"]) for s in spans]) if spans is not None else []
    kept, at = [], 0
    for start, end in runs:
        kept.append(body[at:start])
        at = end
    kept.append(body[at:])
    return runs, b"".join(kept)


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, runs (removed byte ranges) and kept (the remaining bytes) of every document."""
    found = marked(docs, key, text, length)
    kind = found.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            pairs = [_cut(b, s) for b, s in zip(batch.column("body").to_pylist(), batch.column("spans").to_pylist())]
            runs = pa.array([[{"start": a, "end": z} for a, z in r] for r, _ in pairs], _RUNS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(b) for b in batch.column("body").to_pylist()], pa.int64()),
                 runs, pa.array([k for _, k in pairs], pa.binary())],
                names=["doc_id", "n_bytes", "runs", "kept"])

    return found.mapInArrow(released(cut), f"doc_id {kind}, n_bytes long, runs array<struct<start:int,end:int>>, kept binary")


_RUNS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of `documents` covered by a repeated 200-byte string, removed."""
    cut = removed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return cut.select(
        "doc_id", "n_bytes",
        F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"]).alias("n_removed"),
        F.size("runs").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))



def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated strings; a character that a cut divides goes, a null text stays null."""
    columns = docs.columns
    named = docs.withColumn("own_name", F.xxhash64(*columns))
    others = [c for c in columns if c != "text"] + ["has_text"]
    found = marked(named.withColumn("has_text", F.col("text").isNotNull()), "own_name", "text", LENGTH, others)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            kept = [_cut(b, s)[1].decode("utf-8", "ignore")
                    for b, s in zip(batch.column("body").to_pylist(), batch.column("spans").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("extra"), pa.array(kept, pa.string())], names=["extra", "text"])

    schema = found.select("extra").schema.add("text", "string")
    text = F.when(F.col("extra.has_text"), F.col("text")).alias("text")
    kept = found.mapInArrow(released(cut), schema).select(text, *[F.col(f"extra.`{c}`") for c in others if c != "has_text"])
    if "n_chars" in columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*columns)
