"""Windows that occur again anywhere in a corpus, found through shared anchors.

Every window of `length` units holds one anchor: its k-gram of least hash, the
leftmost on a tie. Equal windows have equal anchors at equal places, so windows
need comparing within one anchor's hash only. Consecutive windows with the same
anchor form a context: the span of text that they cover. Each window lies in
exactly one context and each context's windows are exactly those its span holds.

Contexts stand for windows in all shuffles. One row is kept for each distinct
context, however many copies it has (partial aggregation before the shuffle):

* a context that occurs twice or more is repeated as a whole;
* a context that is the only one of its anchor holds no other repeat;
* the rest, where a shared passage ends, are settled by a `refine` step, which
  gets the text of every distinct context of such anchors.

A count-min sketch drops anchors that occur once before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innlake.llm import sketch, units
from innlake.llm.memory import released
from innlake.session import scratch_path

U64 = np.uint64
_PLACE = U64(0xFFFFFF)
#: Units handled at once; places inside a chunk have 24 bits.
_PIECE = 1 << 22


@dataclass(frozen=True)
class Windows:
    """Windows of `length` units with anchors of `gram` units; the units are bytes or words."""

    length: int
    gram: int
    by_word: bool

    @property
    def span(self) -> int:
        """Grams in a window."""
        return self.length - self.gram + 1


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    n, step = len(keys) - width + 1, 1
    while 2 * step <= width:
        keys = np.minimum(keys[:-step], keys[step:])
        step *= 2
    rest = width - step
    return np.minimum(keys[:n], keys[rest: rest + n]) if rest else keys


def contexts(codes: np.ndarray, offsets: np.ndarray, shape: Windows) -> tuple[np.ndarray, ...]:
    """(document, start, end, anchor hash, context hash) of every context."""
    found = []
    n = len(codes)
    for base in range(0, max(0, n - shape.length + 1), _PIECE):
        piece = codes[base: base + _PIECE + shape.length - 1]
        sums = units.prefix_sums(piece)
        grams = units.gram_hash(sums, shape.gram)
        least = _least((grams & ~_PLACE) | np.arange(len(grams), dtype=U64), shape.span)
        anchor = (least & _PLACE).astype(np.int64)
        at = np.arange(len(anchor)) + base
        stop = np.repeat(offsets[1:], np.diff(offsets))[base: base + len(anchor)]
        anchor[at + shape.length > stop] = -1
        heads = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        ends = np.append(heads[1:], len(anchor)) + shape.length - 1
        held = anchor[heads] >= 0
        heads, ends = heads[held], ends[held]
        doc = np.searchsorted(offsets, heads + base, side="right") - 1
        found.append((doc, heads + base - offsets[doc], ends + base - offsets[doc],
                      grams[anchor[heads]], units.span_hash(sums, heads, ends)))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, U64, U64))
    return tuple(np.concatenate(x) for x in zip(*found))


def unit_codes(data: np.ndarray, offsets: np.ndarray, shape: Windows) -> tuple[np.ndarray, np.ndarray]:
    return units.words(data, offsets, units.BYTE_CODES) if shape.by_word else (units.BYTE_CODES[data], offsets)


def _each(batch: pa.RecordBatch, shape: Windows) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    data, offsets = units.flat(batch.column("body"))
    for first, part, part_offsets in units.chunks(data, offsets):
        codes, places = unit_codes(part, part_offsets, shape)
        yield first, contexts(codes, places, shape)


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Smaller batches, for steps that make Python objects of the rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def keyed(docs: DataFrame, key: str, text: str, extra: list[str] | None = None) -> DataFrame:
    """doc_id, body (UTF-8 bytes, empty for null), extra (a struct of other columns) and doc_key, a hash of the first two.

    Rows that agree in both have the same repeats, so they may share marks.
    """
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    more = [F.struct(*[F.col(f"`{c}`") for c in extra]).alias("extra")] if extra else []
    return docs.select(F.col(f"`{key}`").alias("doc_id"), body.alias("body"), *more).withColumn(
        "doc_key", F.xxhash64("doc_id", "body"))


def repeated_spans(docs: DataFrame, shape: Windows, refine: Callable[[Callable[[str], DataFrame]], DataFrame],
                   label: str) -> DataFrame:
    """The frame of keyed() without doc_key and with spans, an array of (start, end) in units, null if nothing repeats.

    Spans may overlap. refine gets a function from a condition on n_alike to a frame of
    anchor, context, n_alike, copies, body; it returns (anchor, context, offset, end):
    what is repeated inside a context that occurs once.
    """
    spark = docs.sparkSession
    units_total = docs.agg(F.sum(F.octet_length("body")).alias("n")).first()["n"] or 0

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            for _, (_, _, _, anchor, _) in _each(batch, shape):
                yield anchor

    expected = 2 * units_total // (shape.span * (6 if shape.by_word else 1)) + 1
    counted = sketch.build(docs.select("body"), hashes, expected)
    shared = spark.sparkContext.broadcast(counted)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("doc_key")
            for first, (doc, start, end, anchor, context) in _each(batch, shape):
                keep = np.flatnonzero(shared.value.repeated(anchor))
                rows = pa.array(doc[keep] + first)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(rows), keys.take(rows), pa.array(anchor[keep].view(np.int64)),
                     pa.array(context[keep].view(np.int64)), pa.array((start[keep] << 24) | (end - start)[keep])],
                    names=["doc_id", "doc_key", "anchor", "context", "place"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    path = scratch_path(spark, label)
    docs.select("doc_id", "doc_key", "body").mapInArrow(released(candidates), f"doc_id {kind}, doc_key long, anchor long, context long, place long") \
        .write.parquet(f"{path}/candidates")
    seen = spark.read.parquet(f"{path}/candidates")
    distinct = seen.groupBy("anchor", "context").agg(
        F.count("*").alias("copies"), F.min("doc_key").alias("doc_key"),
        F.min_by("place", "doc_key").alias("place"))
    alike = distinct.groupBy("anchor").agg(F.count("*").alias("n_alike")).filter("n_alike > 1")
    distinct.join(alike, "anchor").write.parquet(f"{path}/open")
    still_open = spark.read.parquet(f"{path}/open")

    # The same exchange of the texts serves the cutting-out and the final join.
    dealt = docs.repartition("doc_key")
    own = [c for c in docs.columns if c != "doc_key"]
    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            rows = {name: [] for name in ("anchor", "context", "n_alike", "copies", "body")}
            for i in range(batch.num_rows):
                body = batch.column("body")[i].as_py()
                if shape.by_word:
                    body = body.split()
                for x in batch.column("asked")[i].as_py():
                    start, size = x["place"] >> 24, x["place"] & 0xFFFFFF
                    part = body[start: start + size]
                    rows["body"].append(b" ".join(part) if shape.by_word else part)
                    for name in ("anchor", "context", "n_alike", "copies"):
                        rows[name].append(x[name])
            yield pa.RecordBatch.from_pydict(rows, schema=_ASKED)

    def texts(where: str) -> DataFrame:
        asked = still_open.filter(where).groupBy("doc_key").agg(
            F.collect_list(F.struct("anchor", "context", "n_alike", "copies", "place")).alias("asked"))
        # All columns go along so that this exchange is the same as that of the final join.
        return dealt.join(asked, "doc_key").select(*own, "asked").mapInArrow(
            released(cut_out), "anchor long, context long, n_alike long, copies long, body binary")

    parts = refine(texts)
    whole = seen.groupBy("anchor", "context").agg(F.count("*").alias("copies")).filter("copies > 1").select(
        "anchor", "context", F.lit(None).cast("array<struct<offset:int,end:int>>").alias("pieces"))
    found = whole.unionByName(parts.groupBy("anchor", "context").agg(
        F.collect_set(F.struct("offset", "end")).alias("pieces")))
    # A computed key makes Spark shuffle this side too, so that it can split hot contexts of the other.
    found = found.select(F.col("anchor").bitwiseXOR(F.lit(0)).alias("anchor"), "context", "pieces")
    start, size = F.shiftright("place", 24), F.col("place").bitwiseAND(0xFFFFFF)

    def span(begin, end):
        return F.struct(F.col("doc_id"), begin.cast("int").alias("start"), end.cast("int").alias("end"))

    inside = F.transform("pieces", lambda p: span(start + p["offset"], start + p["end"]))
    spans = F.coalesce(inside, F.array(span(start, start + size)))
    marks = seen.join(found, ["anchor", "context"]).select("doc_key", F.explode(spans).alias("s")) \
        .groupBy("doc_key").agg(F.collect_set("s").alias("marked"))
    # Joined by one key, so the texts stay where they are; the id settles equal keys.
    marked = F.filter("marked", lambda m: m["doc_id"].eqNullSafe(F.col("doc_id")))
    return dealt.join(marks, "doc_key", "left").select(
        *own, F.transform(marked, lambda m: F.struct(m["start"], m["end"])).alias("spans"))


_ASKED = pa.schema([("anchor", pa.int64()), ("context", pa.int64()), ("n_alike", pa.int64()),
                    ("copies", pa.int64()), ("body", pa.binary())])


def windows_repeated(texts: DataFrame, shape: Windows) -> DataFrame:
    """Exact grouping of single windows: (anchor, context, offset, end) of those that occur twice."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = units.flat(batch.column("body"))
            for first, part, part_offsets in units.chunks(data, offsets, 1 << 18):
                codes, places = unit_codes(part, part_offsets, shape)
                n = np.maximum(0, np.diff(places) - shape.length + 1)
                at = units.ragged(places[:-1], n)
                one = units.span_hash(units.prefix_sums(codes), at, at + shape.length)
                two = units.span_hash(units.prefix_sums(units.mix(codes)), at, at + shape.length)
                row = np.repeat(np.arange(len(n)), n)
                take = pa.array(row + first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(take) for c in ("anchor", "context", "copies")]
                    + [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                       pa.array((at - places[:-1][row]).astype(np.int32))],
                    names=["anchor", "context", "copies", "one", "two", "offset"])

    windows = texts.mapInArrow(
        expand, "anchor long, context long, copies long, one long, two long, offset int")
    # A context's own windows may repeat inside it, so every start counts, copies of the context too.
    twice = windows.groupBy("one", "two").agg(F.sum("copies").alias("n")).filter("n > 1")
    return windows.filter("copies = 1").join(twice, ["one", "two"]).select(
        "anchor", "context", "offset", (F.col("offset") + shape.length).alias("end"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of a union of spans; touching spans are one run."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out
