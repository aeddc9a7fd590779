"""Ranked search against scores of all documents, and the bounds of the trie."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from innlake.llm import doc_tree, ranked_search
from tests.llm import cases

ITEMS = "item_id long, text string, own string, score int, doc_id int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(rows, items, k=20):
    docs = [(r[0], split(r[1])) for r in rows]
    docs = [(i, w) for i, w in docs if w]
    n_docs, n_terms = len(docs), sum(len(w) for _, w in docs)
    df = Counter(t for _, w in docs for t in set(w))
    texts = {}
    for item, text, *_ in items:
        if item is not None:
            texts.setdefault(item, set()).add(text or "")
    out = []
    for item, found in texts.items():
        scores = []
        for i, w in docs:
            m, tf, score = 75 + (25 * len(w) * n_docs) // n_terms, Counter(w), 0
            for t in split(" ".join(sorted(found))):
                if tf[t]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (
                        (10**9 * tf[t]) // (1000 * tf[t] + 12 * m))
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def items():
    texts = {1: cases.words(2, 30), 2: "one TWO two", 3: None, 4: "", 5: "日本 语 é!", 6: " ".join(cases.words(3, 20_000).split()[500:560]),
             7: "zzzz qqqq", 8: "the the of, and", 9: "x", 10: "TION\x00er in"}
    out = [(i, t, "o", 1, 2) for i, t in texts.items()]
    return out + [out[1], (2, "three", "o", 1, 2), (None, "one two", "o", 1, 2)]


def found(spark, rows, asked, folder):
    cases.saved(cases.documents(spark, rows), folder, "documents")
    cases.saved(spark.createDataFrame(asked, ITEMS), folder, "benchmark")
    return sorted(map(tuple, ranked_search.query(spark, str(folder)).select("item_id", "rank", "doc_id", "score").collect()))


@pytest.mark.parametrize("sizes", [(1024, 64, 1_000_000, 500_000), (4, 1, 300, 40)])
def test_ranks_equal_all_scores(spark, tmp_path, monkeypatch, sizes):
    monkeypatch.setattr(doc_tree, "BRANCH", sizes[0])
    monkeypatch.setattr(doc_tree, "TWIG", sizes[1])
    monkeypatch.setattr(ranked_search, "SHARD_ENTRIES", sizes[2])
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", sizes[3])
    rows = cases.rows() + [(200 + i, cases.words(i % 90, 5 + i % 60), None, None, None, None, None, None, None) for i in range(150)]
    assert found(spark, rows, items(), tmp_path) == brute(rows, items())


def test_empty_tables(spark, tmp_path):
    assert found(spark, [], items(), tmp_path / "a") == []
    assert found(spark, cases.rows(), [], tmp_path / "b") == []
    wordless = [(1, None, None, None, None, None, None, None, None), (2, " .", None, None, None, None, None, None, None)]
    assert found(spark, wordless, items(), tmp_path / "c") == []


def tree(n, rng, size=40):
    sets = [np.sort(rng.choice(size, rng.integers(1, size), replace=False, p=None)) for _ in range(n)]
    sets[5:9] = [sets[5]] * 4
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    terms = np.concatenate(sets)
    tf = rng.integers(1, 9, len(terms))
    m = rng.integers(75, 400, n)
    return doc_tree.DocTree(np.arange(n) * 3, m, offsets, terms, tf), sets, tf, m, offsets


def test_trie_shares_heads_and_bounds_hold(monkeypatch):
    monkeypatch.setattr(doc_tree, "BRANCH", 50)
    monkeypatch.setattr(doc_tree, "TWIG", 7)
    rng = np.random.default_rng(2)
    built, sets, tf, m, offsets = tree(400, rng)
    heads = {tuple(s[: i + 1]) for s in sets for i in range(len(s))}
    assert built.nodes == len(heads) < built.entries
    terms, weights = np.array([1, 5, 30, 33]), np.array([10, 200, 3000, 50])
    exact = {i * 3: sum(int(w) * int(doc_tree.part(tf[offsets[i] + list(s).index(t)], m[i]))
                        for t, w in zip(terms, weights) if t in s) for i, s in enumerate(sets)}
    for level in built.levels[:2]:
        ends = level.begin if level is built.levels[1] else built.levels[1].begin[level.begin]
        bounds = level.bounds(terms, weights, 0, len(level.m))
        for unit, bound in enumerate(bounds):
            below = built.ids[ends[unit]: ends[unit + 1]] if unit + 1 < len(ends) else []
            assert all(exact[i] <= bound for i in below)
    none = np.zeros(0, np.int64)
    ids, scores = built.search(terms, weights, 5, (none, none))
    wanted = sorted((-s, i) for i, s in exact.items() if s > 0)[:5]
    assert list(zip(-scores, ids)) == wanted
    assert built.scored < 400  # the bounds left documents out


def test_subtrees_are_bounded_and_whole():
    shared = np.array([0, 3, 3, 1, 2, 2, 0, 5, 5, 5, 5, 0, 1])
    begins = doc_tree.subtrees(shared, 0, 13, 3)
    assert begins == sorted(begins) and begins[0] == 0
    assert max(np.diff([*begins, 13])) <= 3
    assert doc_tree.subtrees(shared, 0, 13, 20) == [0]
