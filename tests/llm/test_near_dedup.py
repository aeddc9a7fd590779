"""MinHash near-duplicates and components against brute force."""

import random

import pytest

from innlake.llm import near_dedup
from innlake.llm.graph import components
from tests.llm import cases


def classes(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, size):
    own = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not own:
        return frozenset()
    return frozenset(tuple(own[i:i + size]) for i in range(max(1, len(own) - size + 1)))


def linked(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 80 * len(a | b)


def copies_of_copies():
    """Chains and stars of near copies around the threshold, and one big group."""
    rng = random.Random(5)
    rows = []
    for group in range(6):
        base = cases.words(100 + group, 120).split()
        for i in range(25):
            text = list(base)
            for _ in range(rng.randint(0, 6)):
                text[rng.randrange(len(text))] = cases.words(rng.random(), 1)
            rows.append((len(rows) + 1000, " ".join(text), None, None, None, None, None, None, None))
    return rows


@pytest.mark.parametrize("block", [512, 8])
def test_components_equal_brute_force(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = [r for r in cases.rows() if r[0] is not None] + copies_of_copies()
    folder = cases.saved(cases.documents(spark, rows), tmp_path, "documents")
    sets = {r[0]: shingles(r[1], 4) for r in rows}
    keys = sorted(sets)
    wanted = classes(keys, [(a, b) for i, a in enumerate(keys) for b in keys[:i] if linked(sets[a], sets[b])])
    for r in near_dedup.query(spark, folder).collect():
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), wanted[r["doc_id"]])
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_null_keys_and_empty_tables(spark, tmp_path):
    folder = cases.saved(cases.documents(spark), tmp_path, "documents")
    found = near_dedup.query(spark, folder).collect()
    assert len(found) == len(cases.rows())
    assert [r["component_id"] for r in found if r["doc_id"] is None] == [None]
    folder = cases.saved(cases.documents(spark, []), tmp_path, "documents")
    assert near_dedup.query(spark, folder).collect() == []


def test_stage_keeps_one_of_each_group(spark):
    docs = cases.documents(spark)
    left = near_dedup.stage(spark, docs, "")
    assert left.columns == docs.columns
    ids = sorted(str(r["doc_id"]) for r in left.select("doc_id").collect())
    # 1, its repeated row, 2 and 3 are a group, 10 and 11 another.
    assert ids == sorted(["1", *map(str, [4, 5, 6, 7, 8, 9, 10, 12, 13, 14, 15, 16, 17, 18, 19, 20]), "None"])


def test_components_of_random_graphs(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] \
        + [(200, i) for i in range(201, 230)] + [(5, 5)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {x for e in edges for x in e if e[0] != e[1]}
    assert found == classes(nodes, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
