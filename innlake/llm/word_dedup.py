"""Removal of runs of words that occur more than once in a corpus.

Pass one builds a count-min sketch over the anchors of all windows and merges
the partitions' sketches: a window's estimate is that of its anchor, never too
low. Pass two groups exactly, and only windows estimated repeated: contexts of
equal text as wholes, the windows of the remaining contexts one by one.

Words are [^\\x20\\x09-\\x0D]+, unchanged. Defined results: null or empty text
has no words and keeps nothing; fewer words than the length lose nothing; rows
repeated as a whole are documents of their own; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innlake.llm.anchors import Windows, in_slices, keyed, merged, repeated_spans, windows_repeated

LENGTH = 35
ANCHOR = 8


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the other words, joined by one space) of every document."""
    shape = Windows(length, min(ANCHOR, length), by_word=True)
    found = repeated_spans(keyed(docs, key, text), shape, lambda texts: windows_repeated(texts("true"), shape), "word-dedup")
    kind = found.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            n_words, n_removed, kept = [], [], []
            for body, spans in zip(batch.column("body").to_pylist(), batch.column("spans").to_pylist()):
                own = body.split()
                n_words.append(len(own))
                for start, end in reversed(merged([(s["start"], s["end"]) for s in spans or ()])):
                    del own[start:end]
                n_removed.append(n_words[-1] - len(own))
                kept.append(b" ".join(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"])

    return found.mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of `documents` covered by a repeated window of 35 words, removed."""
    cut = removed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
