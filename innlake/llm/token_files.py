"""Token ids of documents in binary record files, in ascending order of their keys.

Documents are dealt by ranges of (key, hash of the text), sorted inside, encoded
and written, one file a task; a payload is the key as text and the ids in the
narrowest width that holds the vocabulary. What returns to the driver is one
row a file.

Defined results: null or empty text has the end id only; a null key sorts
first; equal keys are ordered by the texts' hashes; rows repeated as a whole
are written each; other columns are ignored; an empty table gives no files'
worth of records and an empty result.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innlake.llm import units
from innlake.llm.chunk_codes import ChunkCodes, by_lists, gap_starts
from innlake.llm.record_files import read_all, write_records
from innlake.session import scratch_path

END = 1
#: Bytes of text in a file, about.
FILE_BYTES = 24 << 20

# Fixed value: a pre-tokenizer's pattern under which a letter and an ASCII sign next to it are never in one token.
_LETTERS_APART = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_BORDER = "\x1e"

_ascii = np.arange(128)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SIGN = np.zeros(256, bool)
_SIGN[33:127] = ~(_LETTER[33:127] | ((_ascii[33:127] >= 48) & (_ascii[33:127] < 58)))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


@dataclass(frozen=True)
class _Encoder:
    """Encoder of one tokenizer; white space must be a boundary for it."""

    codes: ChunkCodes
    width: type
    lowers: bool
    letters_apart: bool

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.lowers:
            data = _FOLD[data]
        cuts = gap_starts(units.SPACE[data])
        if self.letters_apart:
            letter = _LETTER[data]
            # Two-byte Latin letters: U+00C0 to U+00FF without the two signs among them.
            letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
            cuts[1:] |= letter[:-1] & _SIGN[data[1:]]
        return self.codes.encode(data, offsets, cuts)


_encoders: dict[str, _Encoder] = {}


def _encoder(path: str) -> _Encoder:
    """One per worker and tokenizer."""
    if path not in _encoders:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        width = np.uint16 if tokenizer.get_vocab_size() <= 1 << 16 else np.uint32

        def alone(chunks: list[str]) -> list[list[int]]:
            return [e.ids for e in tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

        border = alone([_BORDER])[0]

        def together(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
            """All chunks as one text, with a sign between them that is a token of its own."""
            if len(border) == 1:
                ids = np.array(alone([f" {_BORDER} ".join(chunks)])[0], np.int64)
                at = np.flatnonzero(ids == border[0])
                if len(at) == len(chunks) - 1:
                    return np.delete(ids, at), np.diff(at, prepend=-1, append=len(ids)) - 1
            return by_lists(alone)(chunks)  # the sign isn't one token, or a chunk has it

        rules = json.loads(tokenizer.to_str())["pre_tokenizer"] or {}
        first = (rules.get("pretokenizers") or [rules])[0]
        _encoders[path] = _Encoder(
            ChunkCodes(together, width), width,
            tokenizer.normalizer is not None and tokenizer.normalizer.normalize_str("AZ") == "az",
            first.get("type") == "Split" and first.get("pattern") == {"Regex": _LETTERS_APART})
    return _encoders[path]


def _payload(key: str | None, ids: np.ndarray) -> bytes:
    name = b"" if key is None else key.encode()
    return struct.pack("<BiI", ids.itemsize, -1 if key is None else len(name), len(ids)) + name + ids.tobytes()


def parse(payload: bytes) -> tuple[str | None, np.ndarray]:
    """(key, ids) of a payload."""
    width, size, count = struct.unpack_from("<BiI", payload)
    at = 9 + max(0, size)
    ids = np.frombuffer(payload, f"<u{width}", count, at)
    return None if size < 0 else payload[9:at].decode(), ids


def write(docs: DataFrame, tokenizer: str, folder: str, key: str = "doc_id", text: str = "text",
          end: int = END) -> list[tuple[str, int, int]]:
    """(file, documents, ids) of every file written, in key order."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("own"), F.col(key).cast("string").alias("name"), body.alias("body"),
                       F.xxhash64(body).alias("tie"))
    total = rows.agg(F.sum(F.octet_length("body")).alias("n")).first()["n"] or 0
    files = 1 + total // FILE_BYTES

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        task = TaskContext.get()
        name = f"part-{task.partitionId():06d}"
        n_ids = 0

        def payloads() -> Iterator[bytes]:
            nonlocal n_ids
            for batch in batches:
                data, offsets = units.flat(batch.column("body"))
                names = batch.column("name").to_pylist()
                for first, part, own in units.chunks(data, offsets, 4 << 20):
                    ids, ends = encoder.encode(part, own)
                    for i in range(len(own) - 1):
                        piece = np.append(ids[ends[i]: ends[i + 1]], np.asarray(end, encoder.width))
                        n_ids += len(piece)
                        yield _payload(names[first + i], piece)

        records, _ = write_records(folder, name, task.taskAttemptId(), payloads())
        yield pa.RecordBatch.from_pydict({"file": [name], "records": [records], "ids": [n_ids]})

    dealt = rows.repartitionByRange(files, "own", "tie").sortWithinPartitions("own", "tie").select("name", "body")
    done = dealt.mapInArrow(save, "file string, records long, ids long").collect()
    return sorted((r["file"], r["records"], r["ids"]) for r in done)


def read(spark: SparkSession, folder: str, files: list[tuple[str, int, int]]) -> DataFrame:
    """name (key as text), start, n_tokens, ids_crc32 of every record, read from the files."""
    starts, at = [], 0
    for name, _, ids in files:
        starts.append((name, at))
        at += ids
    listing = spark.createDataFrame(starts, "file string, start long").repartition(max(1, len(starts)), "file")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, begin in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                rows = []
                for payload in read_all(folder, name):
                    key, ids = parse(payload)
                    rows.append((key, begin, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    begin += len(ids)
                columns = list(zip(*rows)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["name", "start", "n_tokens", "ids_crc32"])

    return listing.mapInArrow(load, "name string, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all `documents`, written in order of doc_id and read back."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, "token-files")
    files = write(docs, public_tokenizers.path("word_bpe_49k.json"), folder)
    kind = docs.schema["doc_id"].dataType
    return read(spark, folder, files).select(F.col("name").cast(kind).alias("doc_id"), "start", "n_tokens", "ids_crc32")
