"""SentencePiece models run by the tokenizers library.

The model file's protobuf is read field by field; normaliser, white-space
marker, vocabulary, unigram scores or merges, and byte fallback are rebuilt as
a tokenizers pipeline. Texts are cut before each run of markers, which no
piece of the model crosses (checked on loading), so chunks are encoded in
multithreaded batches and remembered. Every text's ids are compared with the
sentencepiece library's own for the whole text as it came: `verified` says whether
they are equal. The library gets one text at a time, and one of more than SPAN
characters in spans that are cut between words, which bounds its memory.

Defined results: null or empty text has no ids; rows repeated are encoded each;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innlake.llm import units
from innlake.llm.chunk_codes import ChunkCodes, by_lists, gap_starts

MARK = "▁"
#: Chunks that a worker remembers.
REMEMBERED = 250_000
#: Characters that the sentencepiece library encodes at once, up to the next cut.
SPAN = 65_536
#: Threads of the tokenizers library in a task; each holds memory of its own.
THREADS = 2

# Fixed values of the model format: kinds of models and of pieces.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_CUT = re.compile("(?<=[^ ▁]) (?=[^ ▁])")


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message; lengths-delimited and fixed values come as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        size = varint() if size is None else size
        yield tag >> 3, data[at: at + size]
        at += size


@dataclass
class PieceModel:
    """What a model file says; the defaults are those of the format."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    suffix_marker: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim: bool = True
    escape: bool = True

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        model = cls()
        for number, value in fields(data):
            if number == 1:
                piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(fields(value))
                model.pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
            elif number == 2:
                spec = dict(fields(value))
                model.kind = spec.get(3, UNIGRAM)
                model.byte_fallback = bool(spec.get(35, 0))
                model.suffix_marker = bool(spec.get(24, 0))
            elif number == 3:
                spec = dict(fields(value))
                model.charsmap = spec.get(2, b"")
                model.dummy_prefix = bool(spec.get(3, 1))
                model.trim = bool(spec.get(4, 1))
                model.escape = bool(spec.get(5, 1))
        return model

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)

    def chunkable(self) -> bool:
        """No piece has a marker behind another character."""
        return self.escape and not self.suffix_marker and not any(
            a != MARK and b == MARK for p, _, kind in self.pieces if kind in (NORMAL, USER) for a, b in zip(p, p[1:]))


def _merges(model: PieceModel) -> list[tuple[str, str]]:
    """Pairs that join to a piece, best score first.

    The model joins the leftmost of equally good pairs, so a run of markers, whose
    pieces all score the same, grows from the left: longer pieces go first.
    """
    usable = {p: s for p, s, kind in model.pieces if kind in (NORMAL, USER)}
    place = {p: i for i, (p, _, _) in enumerate(model.pieces)}
    found = [(-score, -len(piece), place[left], place[right], left, right)
             for piece, score in usable.items()
             for i in range(1, len(piece))
             if (left := piece[:i]) in usable and (right := piece[i:]) in usable]
    return [(left, right) for *_, left, right in sorted(found)]


def build(model: PieceModel):
    """A tokenizers.Tokenizer for text whose spaces are markers already, prefix included."""
    from tokenizers import AddedToken, Tokenizer, models

    if model.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unknown, model.byte_fallback)
    elif model.kind == BPE:
        core = models.BPE({p: i for i, (p, _, _) in enumerate(model.pieces)}, _merges(model),
                          unk_token=model.pieces[model.unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        raise ValueError(f"model kind {model.kind} has neither scores nor merges")
    tokenizer = Tokenizer(core)
    tokenizer.add_tokens([AddedToken(p, normalized=False) for p, _, kind in model.pieces if kind == USER])
    return tokenizer


def normaliser(model: PieceModel):
    """Function from a text to its normal form, with spaces as spaces and without the dummy prefix."""
    from tokenizers import Regex, normalizers

    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.trim:
        steps += [normalizers.Replace(Regex("[ ▁]+"), " "), normalizers.Strip()]
    chain = normalizers.Sequence(steps) if steps else None
    return chain.normalize_str if chain else None


class Codec:
    """Encoder and decoder of one model; differing counts texts unlike the sentencepiece library's."""

    def __init__(self, path: str, checked: bool = True):
        """checked: texts can be compared with the sentencepiece library."""
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        with open(path, "rb") as source:
            self.model = PieceModel.parse(source.read())
        self._tokenizer = build(self.model)
        self._normalise = normaliser(self.model)
        self._whole = not self.model.chunkable()
        self.differing = 0
        self._reference = None
        if checked:
            import sentencepiece

            self._reference = sentencepiece.SentencePieceProcessor(model_file=path)
        self._codes = ChunkCodes(by_lists(self._encode), np.int32, REMEMBERED)
        pieces = [self._surface(p, kind) for p, _, kind in self.model.pieces]
        self._bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self._ends = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])

    def _surface(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return " ⁇ ".encode()
        return piece.replace(MARK, " ").encode()

    def _encode(self, chunks: list[str]) -> list[list[int]]:
        marked = [c.replace(" ", MARK) if self.model.escape else c for c in chunks]
        return [e.ids for e in self._tokenizer.encode_batch_fast(marked, add_special_tokens=False)]

    def verified(self, text: str, normal: str, ids: np.ndarray) -> bool | None:
        """Whether the sentencepiece library gives the text these ids; None if it isn't asked."""
        if self._reference is None:
            return None
        at = 0
        for span in self._spans(text, normal):
            theirs = self._reference.encode(span)
            if not np.array_equal(ids[at: at + len(theirs)], np.array(theirs, np.int64)):
                break
            at += len(theirs)
        else:
            if at == len(ids):
                return True
        self.differing += 1
        return False

    def _spans(self, text: str, normal: str) -> Iterator[str]:
        """The text, or if it is long, spans of its normal form without the space at each cut, which the library adds."""
        if len(text) <= SPAN or self._whole or not self.model.dummy_prefix:
            yield text
            return
        at = 0
        while cut := _CUT.search(normal, at + SPAN):
            yield normal[at: cut.start()]
            at = cut.end()
        yield normal[at:]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, id offsets) of texts that are normalised already."""
        gaps = np.zeros(len(data), bool)
        if not self._whole:
            gaps = data == 0x20
            mark = MARK.encode()
            if len(data) > 2:
                literal = (data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2])
                for i in range(3):
                    gaps[i: len(data) - 2 + i] |= literal
        return self._codes.encode(data, offsets, gap_starts(gaps), " " if self.model.dummy_prefix else "")

    def normal(self, texts: list[str]) -> list[str]:
        return texts if self._normalise is None else [self._normalise(t) for t in texts]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, byte offsets) of the texts; the dummy prefix goes."""
        sizes = self._ends[ids + 1] - self._ends[ids]
        data = self._bytes[units.ragged(self._ends[ids], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])[offsets]
        if self.model.dummy_prefix:
            heads = ends[:-1][np.diff(ends) > 0]
            led = heads[data[heads] == 0x20]
            ends = ends - np.searchsorted(led, ends)
            data = np.delete(data, led)
        return data, ends


_codecs: dict[str, Codec] = {}


def _codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encoded(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, ids, decoded (text from the ids) and normal (the normalised text) of every document,
    and verified: whether the ids are the sentencepiece library's own."""
    kind = docs.schema[key].dataType.simpleString()
    return _rows(docs, key, text).mapInArrow(
        lambda batches: _encode_batches(batches, model),
        f"own {kind}, ids array<int>, decoded binary, normal binary, verified boolean").withColumnRenamed("own", key)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("own"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("body"))


def _encode_batches(batches: Iterator[pa.RecordBatch], model: str) -> Iterator[pa.RecordBatch]:
    codec = _codec(model)
    for batch in batches:
        came = body = batch.column("body")
        if codec._normalise is not None:
            body = pa.array(codec.normal([b.decode() for b in body.to_pylist()])).cast(pa.binary())
        data, offsets = units.flat(body)
        for first, part, own in units.chunks(data, offsets, 1 << 20):
            ids, ends = codec.encode(part, own)
            back, back_ends = codec.decode(ids, ends)
            n = len(own) - 1
            verified = [codec.verified(came[first + i].as_py().decode(), body[first + i].as_py().decode(), ids[ends[i]: ends[i + 1]])
                        for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("own").slice(first, n), pa.ListArray.from_arrays(ends.astype(np.int32), ids),
                 pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(back_ends.astype(np.int32)), pa.py_buffer(back)]),
                 body.slice(first, n), pa.array(verified, pa.bool_())],
                names=["own", "ids", "decoded", "normal", "verified"])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all `documents`, with a digest of the ids and of the text they decode to."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = _rows(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    # Digested where the ids are made: neither ids nor texts leave the worker.
    return rows.mapInArrow(lambda batches: _digest(_encode_batches(batches, model)),
                           "doc_id long, n_tokens long, ids_crc32 long, n_bytes long, round_trip boolean, verified boolean")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        ends = ids.offsets.to_numpy()
        raw = ids.values.to_numpy().astype("<u4")
        decoded, normal = batch.column("decoded").to_pylist(), batch.column("normal").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("own").cast(pa.int64()), pa.array(np.diff(ends).astype(np.int64)),
             pa.array([zlib.crc32(raw[a:z].tobytes()) for a, z in zip(ends[:-1], ends[1:])], pa.int64()),
             pa.array([len(d) for d in decoded], pa.int64()),
             pa.array([a == b for a, b in zip(decoded, normal)]),
             batch.column("verified")],
            names=["doc_id", "n_tokens", "ids_crc32", "n_bytes", "round_trip", "verified"])
