import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from innlake.operators import profiling, quantiles
from innlake.operators.quantiles import interpolated_quantiles, order_statistics


@pytest.mark.parametrize("values", [
    [float(v) for v in range(1, 4001)],
    [0.0] * 1500 + [float(v) for v in range(2500)],
    [1e300, -1e300, 5e-324] + [random.Random(1).gauss(0, 1) for _ in range(3000)],
    [7.5] * 100,
    [1.0] * 1999 + [3.0, 4.0] + [9.0] * 1999,
    [2.0],
    [-0.0, 0.0, -5e-324, float("inf"), float("-inf")] * 20,
    [1.0 + i * 2**-52 for i in range(500)],
])
def test_four_scans_find_exact_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double").repartition(7)
    ranks = [0, len(values) // 3, len(values) // 2, len(values) - 1]
    found = order_statistics(df, {"x": ranks})
    assert [found["x", r] for r in ranks] == [sorted(values)[r] for r in ranks]
    if np.isfinite(values).all():
        spots = [0.0, 0.25, 0.5, 0.75, 1.0]
        assert interpolated_quantiles(df, spots, {"x": len(values)})["x"] == pytest.approx(np.quantile(values, spots).tolist(), rel=1e-12)


def test_nan_is_largest_and_scans_are_fixed(spark, monkeypatch):
    df = spark.createDataFrame([(float("nan"), i) for i in range(3)] + [(float(i), None) for i in range(50)], "x double, y int")
    scans = []
    own = quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", lambda *a: scans.append(1) or own(*a))
    found = order_statistics(df, {"x": [0, 49, 50, 52], "y": [0, 2]})
    assert [found["x", r] for r in (0, 49)] == [0.0, 49.0] and np.isnan([found["x", 50], found["x", 52]]).all()
    assert [found["y", r] for r in (0, 2)] == [0.0, 2.0]
    assert len(scans) == 4  # all columns and ranks together
    scans.clear()
    rows = spark.createDataFrame([(float(i % 97), float(i)) for i in range(1000)], "a double, b double")
    profiling.staged_iqr_outliers(rows, ["a", "b"], {"all": F.lit(True), "low": F.col("b") < 300}).collect()
    assert len(scans) == 4


def test_empty_columns(spark):
    df = spark.createDataFrame([(i % 10, None) for i in range(1000)], "x int, y double")
    assert interpolated_quantiles(df, [0.25, 0.5], {"x": 1000, "y": 0}) == {"x": [2.0, 4.5], "y": [None, None]}


def test_describe_matches_numpy(spark):
    values = [random.Random(3).uniform(-5, 5) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = profiling.describe_numeric(df, ["x"]).first()
    expected = [500, np.mean(values), np.std(values, ddof=1), min(values),
                *np.quantile(values, [0.25, 0.5, 0.75]), max(values)]
    assert list(row)[1:] == pytest.approx(expected)


def test_iqr_outliers(spark):
    values = [float(v) for v in range(1, 101)] + [1000.0, -1000.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = profiling.iqr_outliers(df, ["x"]).first()
    assert (row.n_below, row.n_above, row.whisker_low, row.whisker_high) == (1, 1, 1.0, 100.0)


def test_correlation_of_constant_column_is_null(spark):
    rows = [(float(i), 2.0 * i, 3.0, None if i % 2 else -float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    cells = {(r.column_x, r.column_y): r["corr"] for r in profiling.corr_matrix(df, ["a", "b", "c", "d"]).collect()}
    assert len(cells) == 16
    assert cells["a", "b"] == pytest.approx(1.0) and cells["b", "a"] == pytest.approx(1.0)
    assert cells["a", "c"] is None and cells["c", "c"] is None
    assert cells["a", "d"] == pytest.approx(-1.0)
    ranked = [r.column_name for r in profiling.corr_rank(df, "a", ["a", "b", "c", "d"]).collect()]
    assert ranked[-1] == "c" and set(ranked[:3]) == {"a", "b", "d"}


def test_null_and_shape_profiles(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None)], "a int, b string")
    assert [tuple(r) for r in profiling.null_profile(df).collect()] == [("b", 2)]
    shape = {r.column_name: r for r in profiling.shape_report(df).collect()}
    assert (shape["b"].position, shape["b"].data_type, shape["b"].n_present, shape["b"].n_rows) == (1, "string", 1, 3)
