"""Hard negatives against all scores, and the cells' bounds and order."""

import numpy as np
import pytest

from innlake.llm import hard_negatives, multi_index
from tests.llm import cases
from tests.llm.test_vectors import SCHEMA, rows, sound


def brute(some, length=16, scale=256):
    good = [(r[0], (r[2] + 1) % 10 if r[0] % 7 == 0 else r[2], np.floor(np.array(r[1]) * scale).astype(int)) for r in some
            if r[0] is not None and r[2] is not None and sound(r[1], length)]
    out = []
    done = set()
    for a, label, v in good:
        if a % 50 or (a, label, tuple(v)) in done:
            continue
        done.add((a, label, tuple(v)))
        near = sorted((-int(v @ w), i, other) for i, other, w in good if i != a)
        for s, positive, _ in [x for x in near if x[2] == label][:5]:
            fits = [(-t, i) for t, i, other in near if other != label and 50 * -s <= 100 * -t <= 95 * -s][:3]
            out += [(a, positive, rank, i, -s, t) for rank, (t, i) in enumerate(fits, 1)]
    return sorted(out)


def mined(spark, some, folder):
    path = cases.saved(spark.createDataFrame(some, SCHEMA), folder, "embeddings")
    found = hard_negatives.query(spark, path).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("sizes", [(8192, 64, 1024, 256, 4096), (100, 4, 20, 3, 30)])
def test_negatives_equal_all_scores(spark, tmp_path, monkeypatch, sizes):
    for name, size in zip(("SAMPLE", "CELL", "FIRST", "ASKS", "ROWS"), sizes):
        monkeypatch.setattr(hard_negatives, name, size)
    some = [(r[0], r[1], None if i % 41 == 5 else r[2], r[3], r[4]) for i, r in enumerate(rows())]
    some += [some[50], some[0]]  # a repeated candidate and a repeated anchor
    wanted = brute(some)
    assert wanted and mined(spark, some, tmp_path) == wanted


def test_few_rows_and_no_rows(spark, tmp_path):
    assert mined(spark, [], tmp_path / "a") == []
    some = [(50, [1.0, 0.0], 1, "n", "o"), (51, [0.9, 0.1], 1, "n", "o"), (52, [0.8, 0.1], 2, "n", "o"), (53, [-1.0, 0.0], 2, "n", "o"),
            (100, [-0.5, 0.0], 1, "n", "o"), (150, None, 1, "n", "o"), (200, [1.0, 0.0], None, "n", "o")]
    assert mined(spark, some, tmp_path / "b") == brute(some, 2) != []
    alone = [(50, [1.0, 0.0], 1, "n", "o")]
    assert mined(spark, alone, tmp_path / "c") == []


def test_huge_components_are_whole_numbers():
    a = np.array([[2.0 ** 40, 1.0]])
    assert hard_negatives.scores(a, np.array([[2.0 ** 15, 3.0]]))[0, 0] == 2 ** 55 + 3
    assert hard_negatives.scores(a, np.array([[2.0 ** 60, 0.0]]))[0, 0] == (1 << 63) - 1


def index(n=500, length=8):
    rng = np.random.default_rng(4)
    values = np.floor(rng.standard_normal((9, length))[rng.integers(0, 9, n)] * 1000 + rng.standard_normal((n, length)) * 50)
    blank = multi_index.MultiIndex.fit(values[:200], 6)
    cell, left, right = blank.place(values)
    return values, cell, blank.filled([(int(c), int((cell == c).sum()), left[cell == c].max(), right[cell == c].max())
                                       for c in np.unique(cell)])


def test_cells_come_by_falling_bound_and_bounds_hold():
    values, cell, built = index()
    for query in values[:20]:
        walked = list(built.walk(query))
        assert sorted(c for _, _, c, _ in walked) == sorted(set(cell.tolist()))
        uppers = [u for u, *_ in walked]
        assert uppers == sorted(uppers, reverse=True)
        for upper, lower, c, n in walked:
            inside = values[cell == c] @ query
            assert len(inside) == n and lower <= inside.min() and inside.max() <= upper


def test_cells_beyond_the_windows_are_not_visited():
    values, cell, built = index()
    query = values[0]
    found = values @ query
    windows = [(int(np.sort(found)[-40]), int(np.sort(found)[-20]))]
    visit = built.cells(query, windows)
    assert set(cell[(found >= windows[0][0]) & (found <= windows[0][1])].tolist()) <= set(visit)
    assert len(visit) < len(set(cell.tolist()))
    assert built.cells(query, []) == []
    some = built.cells(query, windows, room=10)
    assert some == visit[:len(some)] and built.cells(query, windows, known=frozenset(some)) == visit[len(some):]


def test_bundles_are_bounded():
    found = multi_index.bundles({3: 10, 1: 2, 2: 2, 7: 1, 8: 0}, 4)
    assert found == {1: (0, 1), 2: (0, 1), 3: (1, 3), 7: (4, 1), 8: (4, 1)}
