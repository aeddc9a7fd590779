"""Column profiles. Each reads the frame once, with one aggregate row that is
unfolded into one row per column (no shuffle beyond the final merge)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innlake.functions.sqltext import name, number, rows, text
from innlake.operators.encoding import value_pairs
from innlake.operators.quantiles import interpolated_quantiles

QUARTILES = [0.25, 0.5, 0.75]


def _unfold(
    df: DataFrame, stats: dict[str, dict[str, str]], constants: dict[str, dict[str, str]] | None = None,
) -> DataFrame:
    """One aggregate, then a row (column_name, stat..., constant...) per column."""
    wide = df.selectExpr(*[
        f"{expr} as `{i}:{stat}`"
        for i, exprs in enumerate(stats.values()) for stat, expr in exprs.items()
    ])
    return wide.selectExpr(rows([
        f"struct({text(c)} as column_name, " + ", ".join(
            [f"`{i}:{stat}` as {stat}" for stat in exprs]
            + [f"{value} as {label}" for label, value in (constants or {}).get(c, {}).items()]) + ")"
        for i, (c, exprs) in enumerate(stats.items())
    ]))


def null_profile(df: DataFrame) -> DataFrame:
    stats = {c: {"n_missing": f"count_if({name(c)} is null)"} for c in df.columns}
    return _unfold(df, stats).filter("n_missing > 0")


def max_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    return _unfold(df, {c: {"max_value": f"cast(max({name(c)}) as double)"} for c in columns})


def variance_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    return _unfold(df, {c: {"variance": f"var_samp({name(c)})"} for c in columns})


def shape_report(df: DataFrame) -> DataFrame:
    """Name, type, position and non-NULL count per column, plus the shape."""
    types = dict(df.dtypes)
    stats = {c: {"n_present": f"count({name(c)})", "n_rows": "count(*)"} for c in df.columns}
    constants = {
        c: {"position": str(i), "data_type": text(types[c]), "n_columns": str(len(df.columns))}
        for i, c in enumerate(df.columns)
    }
    return _unfold(df, stats, constants)


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    return value_pairs(df, columns).distinct()


def _centres(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Mean per column, None where all present values are the same."""
    row = df.selectExpr(*[
        f"if(min({name(c)}) = max({name(c)}), null, avg({name(c)})) as m{i}" for i, c in enumerate(columns)
    ]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(columns)}


def _pair_correlation(df: DataFrame, x: str, y: str, centres: dict[str, float | None]) -> str:
    """Pearson over rows where both are present; NULL for a constant column.

    Sums of products of centred values: cheap per row where corr() updates and
    divides, free of cancellation, and no division by zero under ANSI rules.
    The squares of columns that cannot be NULL are shared by all pairs.
    """
    if centres[x] is None or centres[y] is None:
        return "cast(null as double)"
    a, b = (f"({name(c)} - {number(centres[c])})" for c in (x, y))
    if not (df.schema[x].nullable or df.schema[y].nullable):
        return f"try_divide(sum({a} * {b}), sqrt(sum({a} * {a}) * sum({b} * {b})))"
    # Only rows with both values count, so their own means have to go as well.
    a, b = f"if({b} is null, null, {a})", f"if({a} is null, null, {b})"

    def centred(p: str, q: str) -> str:
        return f"(sum({p} * {q}) - try_divide(sum({p}) * sum({q}), count({p})))"

    return (f"if(min({a}) = max({a}) or min({b}) = max({b}), null, "
            f"try_divide({centred(a, b)}, sqrt({centred(a, a)} * {centred(b, b)})))")


def corr_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every ordered pair; each unordered pair is aggregated once."""
    centres = _centres(df, columns)
    pairs = [(x, y) for i, x in enumerate(columns) for y in columns[i:]]
    wide = df.selectExpr("count(*)", *[
        f"{_pair_correlation(df, x, y, centres)} as c{i}" for i, (x, y) in enumerate(pairs)])
    return wide.selectExpr(rows([
        f"struct({text(left)} as column_x, {text(right)} as column_y, c{i} as corr)"
        for i, (x, y) in enumerate(pairs) for left, right in dict.fromkeys([(x, y), (y, x)])
    ]))


def corr_rank(df: DataFrame, target: str, columns: list[str]) -> DataFrame:
    """|corr| with the target, strongest first, constant columns last."""
    centres = _centres(df, list(dict.fromkeys([*columns, target])))
    stats = {
        c: {"n_rows": "count(*)", "abs_corr": f"abs({_pair_correlation(df, c, target, centres)})"}
        for c in columns
    }
    return _unfold(df, stats).drop("n_rows").orderBy(F.desc_nulls_last("abs_corr"), "column_name")


def _summary(df: DataFrame, columns: list[str]) -> dict[str, dict]:
    """Count, moments and extremes: one small row."""
    stats = {
        "n": "count({})", "mean": "avg({})", "std": "stddev_samp({})",
        "min": "cast(min({}) as double)", "max": "cast(max({}) as double)",
    }
    row = df.selectExpr(*[
        f"{expr.format(name(c))} as {stat}{i}"
        for i, c in enumerate(columns) for stat, expr in stats.items()
    ]).first()
    return {c: {stat: row[f"{stat}{i}"] for stat in stats} for i, c in enumerate(columns)}


def _quartiles(df: DataFrame, columns: list[str]) -> dict[str, list]:
    return interpolated_quantiles(df, QUARTILES, {c: s["n"] for c, s in _summary(df, columns).items()})


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, std (sample), min, exact quartiles, max: a row per column."""
    summary = _summary(df, columns)
    quartiles = interpolated_quantiles(df, QUARTILES, {c: s["n"] for c, s in summary.items()})
    schema = T.StructType(
        [T.StructField("column_name", T.StringType()), T.StructField("n", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])
    rows = [
        (c, s["n"], s["mean"], s["std"], s["min"], *quartiles[c], s["max"])
        for c, s in summary.items()
    ]
    return df.sparkSession.createDataFrame(rows, schema)


def iqr_outliers(df: DataFrame, columns: list[str], whisker: float = 3.0) -> DataFrame:
    """Box-plot numbers: quartiles, whisker ends (furthest row within whisker x
    IQR of the box) and the rows beyond them."""
    return staged_iqr_outliers(df, columns, {"": F.lit(True)}, whisker).drop("stage")


def staged_iqr_outliers(df: DataFrame, columns: list[str], stages: dict[str, Column], whisker: float = 3.0) -> DataFrame:
    """The box-plot numbers of the rows of each stage, a name and a condition; all stages share the scans."""
    places = {f"s{i}_{j}": (stage, c) for i, stage in enumerate(stages) for j, c in enumerate(columns)}
    wide = df.select(*[F.when(stages[stage], F.col(f"`{c}`")).alias(place) for place, (stage, c) in places.items()])
    stats = {}
    for place, box in _quartiles(wide, list(places)).items():
        if box[0] is None:
            q1 = q2 = q3 = low = high = "cast(null as double)"
        else:
            reach = whisker * (box[2] - box[0])
            q1, q2, q3, low, high = map(number, [*box, box[0] - reach, box[2] + reach])
        inside = f"if({place} between {low} and {high}, cast({place} as double), null)"
        stats[place] = {
            "q1": q1, "median": q2, "q3": q3,
            "whisker_low": f"min({inside})", "whisker_high": f"max({inside})",
            "n_below": f"count_if({place} < {low})", "n_above": f"count_if({place} > {high})",
        }
    names = {place: {"stage": text(stage), "own_name": text(c)} for place, (stage, c) in places.items()}
    return _unfold(wide, stats, names).drop("column_name").withColumnRenamed("own_name", "column_name")
