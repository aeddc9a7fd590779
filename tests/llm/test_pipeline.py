"""The pipeline's stages, one after another, against brute force on a small table."""

from collections import Counter

import __spark_entry__ as contract
import corpus_pipeline
from innlake.llm.queries import ORACLES, QUERIES
from tests.llm import cases
from tests.llm.test_near_dedup import classes, linked, shingles
from tests.llm.test_repeats import covered


def test_stages_equal_brute_force(spark, tmp_path):
    rows = [r for r in cases.rows() if r[0] is not None]
    folder = cases.saved(cases.documents(spark, rows), tmp_path, "documents")
    found = corpus_pipeline.run(spark, folder).collect()

    texts = {r[0]: r[1] for r in rows if r[1] and any(c.isalpha() for c in r[1])}
    sets = {k: shingles(t, 5) for k, t in texts.items()}
    keys = sorted(sets)
    names = classes(keys, [(a, b) for i, a in enumerate(keys) for b in keys[:i] if linked(sets[a], sets[b])])
    kept = {k: t.encode() for k, t in texts.items() if names[k] == k}
    counts = Counter(b[i:i + 200] for b in kept.values() for i in range(len(b) - 199))
    counts = {tuple(k): n for k, n in counts.items()}
    sizes = {}
    for k, b in kept.items():
        flags = covered(b, 200, counts)
        left = bytes(x for x, f in zip(b, flags) if not f).decode("utf-8", "ignore").encode()
        if left.split():
            sizes[k] = len(left.split())
    packed = Counter()
    for r in found:
        packed[r["doc_id"]] += r["n_tokens"]
    assert packed == sizes


def test_rows_without_id_and_empty_tables(spark, tmp_path):
    rows = [(None, cases.words(10, 50), "en", "s1", None, None, None, None, None), (1, cases.words(11, 2100), None, None, 7, None, None, None, None),
            (2, cases.words(12, 40), "en", None, 7, None, None, None, None), (3, cases.words(13, 40), "en", None, 7, None, None, None, None),
            (None, None, None, None, None, None, None, None, None)]
    folder = cases.saved(cases.documents(spark, rows), tmp_path / "a", "documents")
    found = Counter()
    for r in corpus_pipeline.run(spark, folder).collect():
        found[r["doc_id"]] += r["n_tokens"]
    assert found == {None: 50, 1: 2100, 2: 40, 3: 40}
    folder = cases.saved(cases.documents(spark, []), tmp_path / "b", "documents")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_names_of_stages_and_queries():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "suffix_dedup", "packing"]
    names = contract.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) <= set(names) and "pipeline" in names
    assert set(ORACLES) <= set(QUERIES)
