"""Byte-pair encoding against the tokenizers library."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from innlake.llm import trie_bpe
from tests.llm import cases

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def coder():
    return trie_bpe.TrieBpe(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def joined(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def same(coder, library, texts):
    ids, ends = coder.encode(*joined(texts))
    data, places = coder.decode(ids, ends)
    for i, text in enumerate(texts):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert ids[ends[i]: ends[i + 1]].tolist() == wanted, text[:80]
        assert data[places[i]: places[i + 1]].tobytes().decode(errors="replace") == library.decode(wanted, skip_special_tokens=False)


def test_awkward_texts(coder, library):
    same(coder, library, [
        "", " ", "\n\n \t x", "a  b   c    ", "don't I'll we've 'sx", "<|endoftext|>", "x <|endoftext|> y\n <|endoftext|><|endoftext|>z",
        "x \n y", "x     y", "　　 a", "\u0085 b\u0085  c", "1e ١٢ ½", "\U0001F600\U0001F600 \U00020000",
        "café naïve à la", "\x00\x1c \x1d\x1f", "a" * 5000, "ab" * 3000 + " " + "-" * 300, "=" * 129, " " * 700 + "x",
        "日本 語 \n日", "é" * 40, "﻿​ ᠎"])


def test_random_strings(coder, library):
    rng = random.Random(5)
    signs = "abcdefghij  \n\t'.,;ABC019éß  一\U0001F600"
    same(coder, library, ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(3000)])


def test_random_merges(tmp_path):
    """A vocabulary of random merges: overlaps that a usual one doesn't have."""
    rng = random.Random(8)
    plain = list(trie_bpe.byte_signs())
    for turn in range(8):
        tokens, merges = list(plain), []
        pool = list("abc")
        while len(merges) < 40:
            pair = [rng.choice(pool), rng.choice(pool)]
            if pair in merges or "".join(pair) in tokens:
                continue
            merges.append(pair)
            tokens.append("".join(pair))
            pool.append("".join(pair))
        spec = json.loads(open(PATH, encoding="utf-8").read())
        spec["model"] |= {"vocab": {t: i for i, t in enumerate(tokens)}, "merges": merges}
        spec["added_tokens"] = []
        path = tmp_path / f"{turn}.json"
        path.write_text(json.dumps(spec), encoding="utf-8")
        same(trie_bpe.TrieBpe(str(path)), Tokenizer.from_file(str(path)),
             ["".join(rng.choice("abc") for _ in range(rng.randint(1, 40))) for _ in range(400)])


def test_shared_prefixes_are_encoded_once(coder, monkeypatch):
    steps = []
    own = trie_bpe.TrieBpe._step
    monkeypatch.setattr(trie_bpe.TrieBpe, "_step", lambda self, *a: steps.append(1) or own(self, *a))
    coder._walk(["unshareable" + c for c in "abcdefgh"])
    assert len(steps) == len("unshareable") + 8


def test_memory_bounds_do_not_change_ids(library, monkeypatch):
    monkeypatch.setattr(trie_bpe, "REMEMBERED", 5)
    monkeypatch.setattr(trie_bpe, "WORDS", 5)
    monkeypatch.setattr(trie_bpe, "PAIRS", 5)
    monkeypatch.setattr(trie_bpe, "LONG", 4)
    small = trie_bpe.TrieBpe(PATH)
    same(small, library, [cases.words(i, 50) for i in range(20)])


def test_query_equals_library(spark, tmp_path, library):
    rows = cases.rows() + [(90, "x <|endoftext|>  \ny", None, None, None, None, None, None, None)]
    folder = cases.saved(cases.documents(spark, rows), tmp_path, "documents")
    wanted = []
    for row in rows:
        ids = library.encode(row[1] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        wanted.append((row[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, trie_bpe.query(spark, folder).collect()))) == sorted(map(repr, wanted))
    empty = cases.saved(cases.documents(spark, []), tmp_path / "none", "documents")
    assert trie_bpe.query(spark, empty).collect() == []


def test_ids_and_texts(spark, library):
    docs = cases.documents(spark)
    ids = trie_bpe.encoded(docs, PATH)
    assert sorted(map(repr, map(tuple, trie_bpe.decoded(ids, PATH).collect()))) == \
        sorted(repr((r[0], r[1] or "")) for r in cases.rows())
    odd = spark.createDataFrame([(1, [220, 447]), (2, None), (3, [50256]), (4, [])], "doc_id int, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in trie_bpe.decoded(odd, PATH).collect()} == \
        {1: library.decode([220, 447]), 2: "", 3: "<|endoftext|>", 4: ""}


def test_other_models_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        trie_bpe.TrieBpe(public_tokenizers.path("word_bpe_49k.json"))
