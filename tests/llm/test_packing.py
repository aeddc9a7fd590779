"""Conflict-free best fit against a search through all bins."""

import random

from pyspark.sql import functions as F

from innlake.llm import best_fit
from tests.llm import cases


def brute(items, capacity):
    bins, out = [], []
    for size, source, cluster in items:
        fits = [(capacity - b[0], i) for i, b in enumerate(bins) if b[0] + size <= capacity
                and (source is None or source not in b[1]) and (cluster is None or cluster not in b[2])]
        if not fits:
            bins.append([0, set(), set()])
        at = min(fits)[1] if fits else len(bins) - 1
        out.append((at, bins[at][0]))
        bins[at][0] += size
        bins[at][1].add(source)
        bins[at][2].add(cluster)
    return out


def test_tightest_compatible_bin():
    rng = random.Random(6)
    for _ in range(300):
        items = sorted(((rng.randint(1, 20), rng.choice([None, "a", "b", "c", "d", "e"]), rng.choice([None, 1, 2, 3]))
                        for _ in range(rng.randint(0, 50))), key=lambda x: -x[0])
        assert best_fit.pack(items, 20) == brute(items, 20)


def test_every_token_is_packed_once_without_conflict(spark):
    rows = [r for r in cases.rows()]
    docs = cases.documents(spark, rows)
    length = F.coalesce(F.size(F.split("text", " ")), F.lit(0))
    found = best_fit.packed(docs, length, F.length("text"), capacity=64, group_pieces=40).collect()
    wanted = sum(len(r[1].split(" ")) for r in rows if r[1] is not None)
    assert sum(r["n_tokens"] for r in found) == wanted
    bins = {}
    for r in found:
        bins.setdefault(r["bin"], []).append(r)
    # One id has a repeated row; all others say which source and cluster they are.
    facts = {r[0]: (r[3], len(r[1] or "")) for r in rows}
    for own in bins.values():
        own.sort(key=lambda r: r["position"])
        at = 0
        for r in own:
            assert r["position"] == at
            at += r["n_tokens"]
        assert at <= 64
        sources = [facts[r["doc_id"]][0] for r in own if facts[r["doc_id"]][0] is not None]
        clusters = [facts[r["doc_id"]][1] for r in own]
        assert len(set(sources)) == len(sources) and len(set(clusters)) == len(clusters)
    pieces = sorted((r["start"], r["n_tokens"]) for r in found if r["doc_id"] == 12)
    assert [s for s, _ in pieces] == list(range(0, 20_000, 64)) and sum(n for _, n in pieces) == 20_000


def test_query_and_empty_table(spark, tmp_path):
    folder = cases.saved(cases.documents(spark), tmp_path, "documents")
    found = best_fit.query(spark, folder).collect()
    wanted = sum(len((r[1] or "").encode().split()) for r in cases.rows())
    assert sum(r["n_tokens"] for r in found) == wanted
    folder = cases.saved(cases.documents(spark, []), tmp_path, "documents")
    assert best_fit.query(spark, folder).collect() == []


def test_full_pieces_and_repeated_rows_stay_out_of_large_groups(spark, monkeypatch):
    """A text of two million words, and one row many times."""
    docs = spark.createDataFrame([(1, "a " * 2_000_000, "s"), *[(2, "b " * 30, None)] * 500], "doc_id long, text string, source string")
    found = best_fit.packed(docs, best_fit._words(), F.lit(None), capacity=64, group_pieces=50).collect()
    full = [r for r in found if r["bin"] < 0]
    assert len(full) == 2_000_000 // 64 and {r["n_tokens"] for r in full} == {64}
    assert len({r["bin"] for r in full}) == len(full)
    rest = [r for r in found if r["bin"] >= 0]
    assert len(rest) == 500 and len({r["bin"] >> 32 for r in rest}) > 5
    assert max(sum(r["bin"] >> 32 == g for r in rest) for g in range(11)) < 100
