"""Repeated byte strings and word windows against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from innlake.llm import anchors, sketch, suffix_dedup, word_dedup
from innlake.llm.run_index import RunIndex
from tests.llm import cases


def covered(units, length, counts):
    flags = [False] * len(units)
    for i in range(len(units) - length + 1):
        if counts[tuple(units[i:i + length])] > 1:
            flags[i:i + length] = [True] * length
    return flags


def runs(flags):
    return sum(b and not a for a, b in zip([False, *flags], flags))


def expected_bytes(rows, length):
    bodies = [(r[0], (r[1] or "").encode()) for r in rows]
    counts = Counter(tuple(b[i:i + length]) for _, b in bodies for i in range(len(b) - length + 1))
    out = []
    for key, body in bodies:
        flags = covered(body, length, counts)
        kept = bytes(b for b, f in zip(body, flags) if not f)
        out.append((key, len(body), sum(flags), runs(flags), hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


def expected_words(rows, length):
    bodies = [(r[0], (r[1] or "").encode().split()) for r in rows]
    counts = Counter(tuple(b[i:i + length]) for _, b in bodies for i in range(len(b) - length + 1))
    out = []
    for key, body in bodies:
        flags = covered(body, length, counts)
        kept = b" ".join(b for b, f in zip(body, flags) if not f)
        out.append((key, len(body), sum(flags), hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


def found(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def short_rows():
    """The awkward rows without the very long text, which brute force in Python can't take."""
    return [r for r in cases.rows() if r[0] != 12]


@pytest.mark.parametrize("length", [3, 8])
def test_run_index_finds_every_string_that_starts_twice(length):
    rng = random.Random(length)
    for _ in range(100):
        alphabet = rng.choice([b"a", b"ab", b"abcd"])
        texts = [bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 9))]
        counts = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
        wanted = {(k, i) for k, t in enumerate(texts) for i in range(len(t) - length + 1) if counts[t[i:i + length]] > 1}
        index = RunIndex(texts, rng.choice([1, length]))
        assert {(int(k), i) for k, a, z in zip(*index.repeats(length)) for i in range(a, z - length + 1)} == wanted


def test_repetitive_text_has_few_runs():
    assert RunIndex([b"abcdefgh" * 500]).runs < 50


def test_contexts_hold_each_window_once():
    rng = np.random.default_rng(1)
    shape = anchors.Windows(20, 6, by_word=False)
    codes = anchors.units.BYTE_CODES[rng.integers(97, 100, 900)]
    offsets = np.array([0, 300, 300, 310, 900])
    doc, start, end, _, _ = anchors.contexts(codes, offsets, shape)
    windows = sorted((int(d), i) for d, a, z in zip(doc, start, end) for i in range(a, z - 19))
    assert windows == [(d, i) for d in range(4) for i in range(offsets[d + 1] - offsets[d] - 19)]


def test_bytes_equal_brute_force(spark, tmp_path):
    folder = cases.saved(cases.documents(spark, short_rows()), tmp_path, "documents")
    assert found(suffix_dedup.query(spark, folder)) == expected_bytes(short_rows(), 200)


def test_hot_anchors_are_settled_by_single_windows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_CONTEXTS", 1)
    folder = cases.saved(cases.documents(spark, short_rows()), tmp_path, "documents")
    assert found(suffix_dedup.query(spark, folder)) == expected_bytes(short_rows(), 200)


def test_words_equal_brute_force(spark, tmp_path):
    folder = cases.saved(cases.documents(spark), tmp_path, "documents")
    assert found(word_dedup.query(spark, folder)) == expected_words(cases.rows(), 35)


def test_empty_tables(spark, tmp_path):
    folder = cases.saved(cases.documents(spark, []), tmp_path, "documents")
    assert suffix_dedup.query(spark, folder).collect() == word_dedup.query(spark, folder).collect() == []


def test_stage_keeps_columns_and_cuts_no_character(spark):
    docs = cases.documents(spark)
    left = suffix_dedup.stage(spark, docs, "")
    assert left.columns == docs.columns
    rows = {r["doc_id"]: r for r in left.collect()}
    assert left.count() == docs.count()
    assert rows[6]["text"] is None and rows[7]["text"] == "" and rows[1]["text"] == ""
    assert rows[15]["text"] == "" and rows[10]["text"] == "one two three"
    assert all(r["n_chars"] == len(r["text"]) for r in rows.values() if r["text"] is not None)


def test_sketch_never_undercounts(spark):
    def keys(batches):
        for batch in batches:
            yield batch.column("id").to_numpy().astype(np.uint64)

    once, twice = spark.range(0, 5000), spark.range(2000, 3000)
    built = sketch.build(once.union(twice), keys, 6000)
    hit = built.repeated(np.arange(5000, dtype=np.uint64))
    assert hit[2000:3000].all() and hit.sum() < 1200
