"""Near-duplicate vectors and exact top-k against all pairs."""

import numpy as np
import pytest
from pyspark.sql import types as T

from innlake.llm import pivot_search, vector_dedup
from innlake.session import scratch_path
from tests.llm import cases
from tests.llm.test_near_dedup import classes

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("node", T.StringType()),
                       T.StructField("own", T.StringType())])


def rows(n=700, length=16):
    rng = np.random.default_rng(3)
    values = rng.standard_normal((n, length))
    values[100:220] = values[100] + 0.08 * rng.standard_normal((120, length))
    values[300:330] = values[300]
    for i in range(400, 440, 2):
        values[i + 1] = values[i] * 3 + 0.2 * rng.standard_normal(length)
    out = [(i * 2, [float(np.float32(x)) for x in v], i % 4, "n", "o") for i, v in enumerate(values)]
    odd = [None, [], [0.0] * length, [float("nan")] * length, [1.0] * (length - 1) + [float("inf")],
           [None] + [1.0] * (length - 1), [1.0] * (length + 3), [-0.0] * length]
    out += [(20_000 + i, v, None, None, None) for i, v in enumerate(odd)]
    return out + [out[150], (None, out[100][1], 1, "n", "o")]


def sound(v, length=16):
    return v is not None and len(v) == length and all(x is not None and np.isfinite(x) for x in v)


def table(spark, some, folder):
    return cases.saved(spark.createDataFrame(some, SCHEMA), folder, "embeddings")


@pytest.mark.parametrize("block", [1024, 32])
def test_links_equal_all_pairs(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    monkeypatch.setattr(vector_dedup, "WINDOW", 32)
    some = [r for r in rows() if r[0] is not None]
    good = [(r[0], np.array(r[1])) for r in some if sound(r[1]) and any(r[1])]
    unit = np.array([v / np.linalg.norm(v) for _, v in good])
    near = unit @ unit.T >= 0.95
    ids = [k for k, _ in good]
    links = {k: int(near[i].sum()) - 1 for i, k in enumerate(ids)}
    names = classes({r[0] for r in some}, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(near)) if ids[i] != ids[j]])
    found = vector_dedup.query(spark, table(spark, rows(), tmp_path)).collect()
    assert len(found) == len(some)
    exact = [r["n_links"] == links.get(r["vec_id"], 0) and r["component_id"] == names[r["vec_id"]] for r in found]
    assert sum(r["n_links"] for r in found) <= sum(links[k] for k in ids)
    assert np.mean(exact) > 0.98
    big = [r for r in found if 200 <= r["vec_id"] < 440]
    assert {r["component_id"] for r in big} == {200} and all(r["n_links"] == links[r["vec_id"]] for r in big)


@pytest.mark.parametrize("sizes", [(512, 4096), (4, 60)])
def test_top_k_equals_all_scores(spark, tmp_path, monkeypatch, sizes):
    monkeypatch.setattr(pivot_search, "QUERY_BLOCK", sizes[0])
    monkeypatch.setattr(pivot_search, "CANDIDATE_BLOCK", sizes[1])
    good = [(r[0], np.floor(np.array(r[1]) * 1024).astype(np.int64)) for r in rows() if r[0] is not None and sound(r[1])]
    wanted = []
    for key in {k for k, _ in good if k % 100 == 0}:
        mine = next(v for k, v in good if k == key)
        best = sorted((-int(mine @ v), k) for k, v in good if k != key)[:10]
        wanted += [(key, i + 1, k, -s) for i, (s, k) in enumerate(best)]
    found = pivot_search.query(spark, table(spark, rows(), tmp_path))
    assert sorted(map(tuple, found.collect())) == sorted(wanted)


def test_cells_that_cannot_reach_the_floor_are_not_sent(spark, tmp_path, monkeypatch):
    """Clusters far from each other: a query's block meets few of the chunks, and the bounds hold."""
    rng = np.random.default_rng(8)
    centres = 20 * rng.standard_normal((12, 16))
    values = centres[rng.integers(0, 12, 1200)] + 0.3 * rng.standard_normal((1200, 16))
    some = [(i, [float(np.float32(x)) for x in v], 0, "n", "o") for i, v in enumerate(values)]
    sent = []
    folder = table(spark, some, tmp_path)
    monkeypatch.setattr(pivot_search, "CANDIDATE_BLOCK", 50)
    monkeypatch.setattr(pivot_search, "QUERY_BLOCK", 1)
    monkeypatch.setattr(pivot_search, "scratch_path", lambda *a: sent.append(scratch_path(*a)) or sent[-1])
    found = sorted(map(tuple, pivot_search.query(spark, folder).collect()))
    whole = [(i, np.floor(np.array(v) * 1024).astype(np.int64)) for i, v, *_ in some]
    wanted = []
    for key in range(0, 1200, 100):
        best = sorted((-int(whole[key][1] @ v), i) for i, v in whole if i != key)[:10]
        wanted += [(key, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    assert found == sorted(wanted)
    visits = spark.read.parquet(sent[-1])
    assert visits.count() < 12 * 24 / 2  # of the pairs of a query and a chunk of at most 50


def test_large_components_stay_exact():
    big = np.array([[2.0 ** 60, 3.0], [2.0 ** 61, -5.0]])
    assert pivot_search._scores(big[:1], big).tolist() == [[(1 << 63) - 1] * 2]
    assert pivot_search._scores(np.array([[2.0 ** 30, 1.0]]), np.array([[2.0 ** 30, 1.0]])).tolist() == [[2 ** 60 + 1]]


def test_few_and_no_rows(spark, tmp_path):
    folder = table(spark, rows()[:4], tmp_path)
    assert [tuple(r)[:2] for r in pivot_search.query(spark, folder).collect()] == [(0, 1), (0, 2), (0, 3)]
    for some in ([], [(1, None, 1, None, None)]):
        folder = table(spark, some, tmp_path)
        assert pivot_search.query(spark, folder).collect() == []
        assert [tuple(r) for r in vector_dedup.query(spark, folder).collect()] == [(1, 0, 1, True)][: len(some)]


@pytest.mark.parametrize("passes", [4, 64])
def test_pairs_in_a_hot_cone_are_met(spark, tmp_path, monkeypatch, passes):
    """With few passes most of the cone is decided in full, in many blocks; with many, by passes."""
    monkeypatch.setattr(vector_dedup, "WINDOW", 16)
    monkeypatch.setattr(vector_dedup, "OWN", 16)
    monkeypatch.setattr(vector_dedup, "BLOCK", 128)
    monkeypatch.setattr(vector_dedup, "MAX_PASSES", passes)
    ran, full = [], []
    keyed, decided = vector_dedup._keyed, vector_dedup._full_links
    monkeypatch.setattr(vector_dedup, "_keyed", lambda *a: ran.append(a[3]) or keyed(*a))
    monkeypatch.setattr(vector_dedup, "_full_links", lambda *a: full.append(a[1]) or decided(*a))
    rng = np.random.default_rng(5)
    n, length, pairs = 3000, 64, 150
    unit = rng.standard_normal((n, length))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    values = np.sqrt(0.8) * np.eye(length)[0] + np.sqrt(0.2) * unit  # about 0.8 of each other
    values[1500:] = unit[1500:]
    for i in range(0, 2 * pairs, 2):
        side = rng.standard_normal(length)
        side -= side @ values[i] * values[i] / (values[i] @ values[i])
        values[i + 1] = values[i] + 0.3 * np.linalg.norm(values[i]) * side / np.linalg.norm(side)
    folder = table(spark, [(i, [float(x) for x in v], 0, None, None) for i, v in enumerate(values)], tmp_path)
    names = {r["vec_id"]: r["component_id"] for r in vector_dedup.query(spark, folder).collect()}
    met = [names[i] == names[i + 1] for i in range(0, 2 * pairs, 2)]
    assert np.mean(met) >= 0.98
    assert sum(ran) >= 4
    if passes == 4:
        assert full and full[0] > 4 * 128


def test_every_table_has_passes(spark, tmp_path, monkeypatch):
    ran = []
    keyed = vector_dedup._keyed
    monkeypatch.setattr(vector_dedup, "_keyed", lambda *a: ran.append(a[3]) or keyed(*a))
    vector_dedup.query(spark, table(spark, rows()[:40], tmp_path)).collect()
    assert sum(ran) >= 4


def test_cells_that_meet_hold_all_near_pairs():
    rng = np.random.default_rng(6)
    values = rng.standard_normal((20, 8))[rng.integers(0, 20, 600)] + 0.15 * rng.standard_normal((600, 8))
    unit = values / np.linalg.norm(values, axis=1, keepdims=True)
    pivots = unit[:40]
    angles = vector_dedup._angles(unit, pivots)
    cell, far = angles.argmin(axis=1), angles.min(axis=1)
    radius = np.array([far[cell == i].max() for i in range(40)])
    meets = vector_dedup.meeting_cells(pivots, radius, np.arccos(0.95))
    for a, b in zip(*np.nonzero(unit @ unit.T >= 0.95)):
        assert cell[b] in meets[cell[a]]
    assert sum(map(len, meets)) < 40 * 40
