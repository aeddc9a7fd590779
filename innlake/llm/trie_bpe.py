"""Byte-pair encoding by walking a trie of distinct words, and decoding.

A text is cut into words by the tokenizer's own rule. Where the encoding of a
prefix ends with token a, the encoding of a longer prefix that goes on with token
b is the former and b, if a and b side by side aren't merged across their border.
For every prefix exactly one b fits. So the last token of a prefix, and where it
begins, say all about its encoding, and they depend on nothing behind it: distinct
words are put into a trie, and one depth-first walk finds the last token of
every node from those above. A prefix that many words share is encoded once.

Whether two tokens stay apart is decided by merging their bytes plainly, and
remembered. Texts are cut before white space first, since no word crosses
that place, so that a chunk is looked at once; numpy puts the texts together.

Defined results: null or empty text has no ids; the strings of special tokens in
a text give those tokens, as in the library; ids whose bytes are no UTF-8 decode
with replacement signs; rows repeated are encoded each; a null key stays; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innlake.llm import units
from innlake.llm.chunk_codes import ChunkCodes, gap_starts

#: Chunks, words and pairs of tokens that a worker remembers.
REMEMBERED = 1_000_000
WORDS = 500_000
PAIRS = 1_000_000
#: A word of more characters is walked alone: a trie node for each would take too much memory.
LONG = 1024
_NONE = -1


def byte_signs() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others take the characters from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class TrieBpe:
    """Encoder and decoder of one byte-level tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
               if model.get(k)]
        cut = spec["pre_tokenizer"] or {}
        marked = [t["content"] for t in spec["added_tokens"] if t["lstrip"] or t["rstrip"] or t["single_word"]]
        if model.get("type", "BPE") != "BPE" or odd or marked or spec["normalizer"] or cut.get("type") != "ByteLevel" \
                or cut["add_prefix_space"] or not cut["use_regex"]:
            raise ValueError(f"no plain byte-level model: {path} {odd} {marked}")
        self._cutter = Tokenizer.from_file(path).pre_tokenizer
        self._vocabulary: dict[str, int] = model["vocab"]
        signs = byte_signs()
        if missing := [s for s in signs if s not in self._vocabulary]:
            raise ValueError(f"bytes without a token: {missing}")
        self._added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        longest_first = sorted(self._added, key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self._joined: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self._joined[self._vocabulary[left], self._vocabulary[right]] = rank, self._vocabulary[left + right]
        self._signs = [""] * (1 + max([*self._vocabulary.values(), *self._added.values()]))
        for sign, token in self._vocabulary.items():
            self._signs[token] = sign
        self._spelled()
        self._apart: dict[int, bool] = {}
        self._known: dict[str, tuple[int, ...]] = {}
        self._codes = ChunkCodes(self._encode_chunks, np.uint32, REMEMBERED)
        surfaces = list(self._signs)
        for sign, token in self._added.items():
            surfaces[token] = sign
        pieces = [bytes(signs[c] for c in s) if all(c in signs for c in s) else s.encode() for s in surfaces]
        self._bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self._ends = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])

    def _spelled(self) -> None:
        """The vocabulary as an automaton of suffixes.

        A state is the longest end of what was read that begins a token; _suffix leads to the
        longest token that ends a state's string, other than that itself.
        """
        self._steps: list[dict[str, int]] = [{}]
        self._token_at, self._size = [_NONE], [0]
        for sign, token in self._vocabulary.items():
            state = 0
            for c in sign:
                after = self._steps[state].get(c)
                if after is None:
                    after = self._steps[state][c] = len(self._steps)
                    self._steps.append({})
                    self._token_at.append(_NONE)
                    self._size.append(self._size[state] + 1)
                state = after
            self._token_at[state] = token
        self._fail = array("i", bytes(4 * len(self._steps)))
        self._suffix = array("i", bytes(4 * len(self._steps)))
        level = list(self._steps[0].values())
        while level:
            below = []
            for state in level:
                fail = self._fail[state]
                self._suffix[state] = fail if self._token_at[fail] != _NONE else self._suffix[fail]
                for c, after in self._steps[state].items():
                    self._fail[after] = self._after(fail, c)
                    below.append(after)
            level = below

    def _after(self, state: int, sign: str) -> int:
        while (found := self._steps[state].get(sign)) is None and state:
            state = self._fail[state]
        return found or 0

    def _merged(self, sign: str) -> list[int]:
        """Tokens of a short string by joining the best pair until none is left."""
        tokens = [self._vocabulary[c] for c in sign]
        while len(tokens) > 1:
            ranked = [(found[0], i, found[1]) for i in range(len(tokens) - 1)
                      if (found := self._joined.get((tokens[i], tokens[i + 1])))]
            if not ranked:
                break
            _, i, whole = min(ranked)
            tokens[i: i + 2] = [whole]
        return tokens

    def _fits(self, before: int, token: int) -> bool:
        """The token stands as it is behind the token before, or at the start of a word."""
        name = (before + 1) << 32 | token
        found = self._apart.get(name)
        if found is None:
            if len(self._apart) >= PAIRS:
                self._apart.clear()
            head = [before] if before != _NONE else []
            text = "".join(self._signs[t] for t in [*head, token])
            found = self._apart[name] = self._merged(text) == [*head, token]
        return found

    def _step(self, sign: str, state: int, depth: int, above) -> tuple[int, int, int]:
        """(last token, its length, state) one character further, at the given depth.

        above has the last tokens by depth, none for the root.
        """
        state = at = self._after(state, sign)
        if self._token_at[at] == _NONE:
            at = self._suffix[at]
        while at:
            token, size = self._token_at[at], self._size[at]
            before = above[depth - size]
            fits = self._apart.get((before + 1) << 32 | token)
            if fits or (fits is None and self._fits(before, token)):
                return token, size, state
            at = self._suffix[at]
        raise ValueError(f"no token ends with {sign!r}")

    def _walk(self, words: list[str]) -> None:
        """Learns the ids of distinct words from one trie."""
        below: list[dict[str, int] | None] = [{}]
        ends = []
        for word in words:
            node = 0
            for c in word:
                kids = below[node]
                if kids is None:
                    kids = below[node] = {}
                after = kids.get(c)
                if after is None:
                    after = kids[c] = len(below)
                    below.append(None)
                node = after
            ends.append(node)
        last, begin = [_NONE] * len(below), [0] * len(below)
        path = [0] * (2 + max(map(len, words), default=0))  # nodes by depth, and their last tokens
        above = [_NONE] * len(path)
        stack = [(0, 0, 0)]
        while stack:
            node, state, depth = stack.pop()
            path[depth], above[depth] = node, last[node]
            kids = below[node]
            if kids:
                depth += 1
                for c, after in kids.items():
                    last[after], size, on = self._step(c, state, depth, above)
                    begin[after] = path[depth - size]
                    stack.append((after, on, depth))
        for word, node in zip(words, ends):
            self._known[word] = _path(node, last, begin)

    def _alone(self, word: str) -> tuple[int, ...]:
        """The same along a single word; a node is a place in it."""
        last, begin, state = array("i", [_NONE]), array("q", [0]), 0
        for i, c in enumerate(word, 1):
            token, size, state = self._step(c, state, i, last)
            last.append(token)
            begin.append(i - size)
        return _path(len(word), last, begin)

    def _words(self, chunk: str) -> list[str | int]:
        """Words of a chunk in the signs of bytes; special tokens as their ids."""
        out: list[str | int] = []
        parts = self._special.split(chunk) if self._special else [chunk]
        for i, part in enumerate(parts):
            if i % 2:
                out.append(self._added[part])
            elif part:
                out += [word for word, _ in self._cutter.pre_tokenize_str(part)]
        return out

    def _encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = [self._words(c) for c in chunks]
        if len(self._known) >= WORDS:
            self._known.clear()
        fresh = {w for words in cut for w in words if isinstance(w, str) and w not in self._known}
        self._walk([w for w in fresh if len(w) <= LONG])
        once = {w: self._alone(w) for w in fresh if len(w) > LONG}
        ids, sizes = [], np.zeros(len(chunks), np.int64)
        for i, words in enumerate(cut):
            before = len(ids)
            for w in words:
                if isinstance(w, int):
                    ids.append(w)
                else:
                    ids += self._known[w] if w in self._known else once[w]
            sizes[i] = len(ids) - before
        return np.array(ids, np.uint32), sizes

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, id offsets) of UTF-8 texts."""
        cuts = gap_starts(units.SPACE[data])
        # A gap may go on from white space beyond ASCII; E1 to E3 lead all of its signs of three bytes, and others.
        at = np.flatnonzero(cuts)
        two = at[at >= 2]
        cuts[two[(data[two - 2] == 0xC2) & ((data[two - 1] == 0x85) | (data[two - 1] == 0xA0))]] = False
        three = at[at >= 3]
        cuts[three[(data[three - 3] >= 0xE1) & (data[three - 3] <= 0xE3)]] = False
        return self._codes.encode(data, offsets, cuts)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, byte offsets) of the texts, before signs that are no UTF-8 are replaced."""
        begin = self._ends[ids]
        sizes = self._ends[ids.astype(np.int64) + 1] - begin
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return self._bytes[units.ragged(begin, sizes)], ends[offsets]


def _path(node: int, last, begin) -> tuple[int, ...]:
    tokens = []
    while node:
        tokens.append(last[node])
        node = begin[node]
    return tuple(reversed(tokens))


_coders: dict[str, TrieBpe] = {}


def _coder(path: str) -> TrieBpe:
    """One per worker and tokenizer."""
    if path not in _coders:
        _coders[path] = TrieBpe(path)
    return _coders[path]


def _coded(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[tuple]:
    """(keys, ids, id offsets) of some whole texts at a time."""
    coder = _coder(tokenizer)
    for batch in batches:
        data, offsets = units.flat(batch.column("body"))
        for first, part, own in units.chunks(data, offsets):
            yield batch.column("own").slice(first, len(own) - 1), *coder.encode(part, own)


def _bodies(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("own"), F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("body"))


def encoded(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and ids of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, ids, ends in _coded(batches, tokenizer):
            yield pa.RecordBatch.from_arrays(
                [own, pa.ListArray.from_arrays(ends.astype(np.int32), ids.astype(np.int32))], names=["own", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return _bodies(docs, key, text).mapInArrow(run, f"own {kind}, ids array<int>").withColumnRenamed("own", key)


def decoded(rows: DataFrame, tokenizer: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key and text of every row of ids; null gives an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer)
        for batch in batches:
            lists = batch.column("ids")
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            data, places = coder.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.uint32), ends)
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("own"), pa.array([raw[a:z].decode(errors="replace") for a, z in zip(places, places[1:])], pa.string())],
                names=["own", "text"])

    kind = rows.schema[key].dataType.simpleString()
    given = rows.select(F.col(key).alias("own"), F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    return given.mapInArrow(run, f"own {kind}, text string").withColumnRenamed("own", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all `documents` and the texts that they decode to, as digests made where the ids are."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own, ids, ends in _coded(batches, path):
            raw, (data, places) = ids.astype("<u4"), _coder(path).decode(ids, ends)
            texts = [data[a:z].tobytes().decode(errors="replace").encode() for a, z in zip(places, places[1:])]
            yield pa.RecordBatch.from_arrays(
                [own, pa.array(np.diff(ends).astype(np.int64)),
                 pa.array([hashlib.sha256(raw[a:z].tobytes()).hexdigest() for a, z in zip(ends, ends[1:])], pa.string()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = _bodies(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
