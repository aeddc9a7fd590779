"""CSV in and out: files, lines held in a column, and missing-value tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innlake.functions.sqltext import name, text

# The texts read as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
_DIALECT = {
    "sep": ",", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def _typed(column: str, kind: T.DataType, strict: bool) -> str:
    """Cast after mapping tokens to NULL; '2.0' is a valid integer text.

    strict raises on text that is no value of the type, otherwise it is NULL.
    """
    tokens = ", ".join(map(text, MISSING_TOKENS))
    compared = name(column) if isinstance(kind, T.StringType) else f"trim({name(column)})"
    present = f"if({compared} in ({tokens}), null, {name(column)})"
    cast, target = ("cast" if strict else "try_cast"), kind.simpleString()
    if isinstance(kind, T.StringType):
        value = present
    elif isinstance(kind, (T.IntegerType, T.LongType)):
        # Text with a fraction is no integer: it goes through a decimal that must be whole.
        number = f"try_cast({present} as double)"
        fraction = f"{number} is not null and {number} <> floor({number})"
        refused = f"cast(concat('not whole: ', {present}) as bigint)" if strict else "null"
        whole = f"if({fraction}, {refused}, {cast}({cast}({present} as double) as bigint))"
        value = f"{cast}(coalesce(try_cast({present} as bigint), {whole}) as {target})"
    else:
        value = f"{cast}({present} as {target})"
    return f"{value} as {name(column)}"


def typed_columns(schema: T.StructType, strict: bool = True) -> list[str]:
    """Typed columns over text columns with the same names."""
    return [_typed(f.name, f.dataType, strict) for f in schema]


def read_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, strict: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Files with a header row, checked against the schema's names per file.

    No inference pass. multi_line allows line breaks inside quotes, at the
    price of one task per file.
    """
    raw = (spark.read.schema(_as_text(schema))
           .options(header=True, enforceSchema=False, multiLine=multi_line, mode="FAILFAST", **_DIALECT)
           .csv(path))
    return raw.selectExpr(*typed_columns(schema, strict))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(header=True, emptyValue="", **_DIALECT).csv(path)


def csv_header(columns: list[str]) -> str:
    return ",".join(columns)


def csv_line(columns: list[str]) -> Column:
    """One properly quoted CSV line per row; missing values are empty."""
    return F.to_csv(F.struct(*[F.col(f"`{c}`") for c in columns]), _DIALECT)


def parse_csv_messages(df: DataFrame, value: str, schema: T.StructType) -> DataFrame:
    """One row for each message, typed where possible, with `reason`: why it can't be taken, or NULL.

    A message is one record, line breaks inside quotes included; messages that
    are blank or the header are dropped, other columns and the message are kept.
    """
    ddl = ", ".join(f"`{f.name}` string" for f in schema)
    rows = df.filter(~F.trim(value).isin("", csv_header(schema.names)))
    read = F.from_csv(F.col(value), f"{ddl}, `_misread` string", {**_DIALECT, "columnNameOfCorruptRecord": "_misread"})
    parsed = rows.select("*", F.inline(F.array(read)))
    raw = [f"{name(f.name)} as {name('_raw_' + f.name)}" for f in schema]
    others = [name(c) for c in df.columns]
    typed = parsed.selectExpr(*others, "_misread", *raw, *typed_columns(schema, strict=False))
    tokens = ", ".join(map(text, MISSING_TOKENS))
    unread = [
        f"if({name(f.name)} is null and trim({name('_raw_' + f.name)}) not in ({tokens}), {text(f.name)}, null)"
        for f in schema if not isinstance(f.dataType, T.StringType)]
    reason = ("case when _misread is not null then 'wrong number of fields' when size({0}) > 0 "
              "then concat('unreadable: ', array_join({0}, ' ')) end").format(f"array_compact(array({', '.join(unread)}))")
    return typed.selectExpr(*others, *[name(f.name) for f in schema], f"{reason} as reason")


#: Stands for a line break inside quotes while text is cut into lines; no CSV text has it.
_KEPT_BREAK = "\ufdd0"


def _records(value: Column) -> Column:
    """The records of a CSV text: its lines, but for breaks inside quotes.

    Between two quotes text is quoted and outside by turns (a doubled quote only adds an
    empty turn), so one pass over the parts finds the breaks that stay.
    """
    parts = F.transform(F.split(value, '"'), lambda part, i: F.when(
        i % 2 == 1, F.translate(part, "\n", _KEPT_BREAK)).otherwise(part))
    lines = F.split(F.array_join(parts, '"'), "\r?\n")
    return F.transform(lines, lambda line: F.translate(line, _KEPT_BREAK, "\n"))


def once(df: DataFrame, *columns: Column) -> DataFrame:
    """The given columns, each computed once for a row.

    A generator keeps the optimiser from writing an expensive expression into every
    place where its column is used.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))


def parse_csv_lines(
    df: DataFrame, value: str, schema: T.StructType, strict: bool = True,
) -> DataFrame:
    """Rows from a text column holding one or more CSV records per value.

    A line break inside quotes belongs to its field. Header lines and blank lines are
    dropped; other columns are kept.
    """
    others = [c for c in df.columns if c != value]
    ddl = ", ".join(f"`{f.name}` string" for f in schema)
    texts = once(df, *[F.col(f"`{c}`") for c in others], F.col(f"`{value}`").alias("line"))
    has_break = F.instr("line", "\n") > 0
    lines = (texts.select(*[F.col(f"`{c}`") for c in others],
                          F.explode(F.when(has_break, _records(F.col("line"))).otherwise(F.array("line"))).alias("line"))
             .filter((F.col("line") != "") & (F.col("line") != csv_header(schema.names))))
    # A generator parses each record once; field access on from_csv would be
    # rewritten into one parse per field and use.
    options = {**_DIALECT, "lineSep": _KEPT_BREAK}
    fields = lines.select(*[F.col(f"`{c}`") for c in others], F.inline(F.array(F.from_csv("line", ddl, options))))
    return fields.selectExpr(*map(name, others), *typed_columns(schema, strict))


def join_quoted_lines(df: DataFrame, value: str, order: str, group: list[str], block_span: int = 1_000_000) -> DataFrame:
    """Records from the lines of a text: a line that starts inside quotes belongs to the record before it.

    df: the group's columns, an integer order that is unique in a group, and the line. Added
    up along a group, the lines' quotes tell by their parity where a record starts. Windows run
    inside blocks of consecutive orders; along a whole group only one row a block is added up.
    A record has the order of its first line. A null line counts as an empty one.
    """
    keys, place = [F.col(f"`{c}`") for c in group], F.col(f"`{order}`")
    text_ = F.coalesce(F.col(f"`{value}`"), F.lit(""))
    quotes = F.length(text_) - F.length(F.translate(text_, '"', ""))
    rows = once(df, *keys, place.alias("_order"), text_.alias("_line"), (quotes % 2).alias("_odd"),
                F.floor(place / block_span).alias("_block"))
    inside = Window.partitionBy(*keys, "_block").orderBy("_order")
    earlier, upto = inside.rowsBetween(Window.unboundedPreceding, -1), inside.rowsBetween(Window.unboundedPreceding, 0)
    blocks = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    parity = rows.groupBy(*keys, "_block").agg(F.sum("_odd").alias("_sum")) \
        .withColumn("_before", F.coalesce(F.sum("_sum").over(blocks), F.lit(0))).drop("_sum")
    marked = rows.withColumn("_in", F.coalesce(F.sum("_odd").over(earlier), F.lit(0))).join(parity, [*group, "_block"]) \
        .withColumn("_start", F.when((F.col("_in") + F.col("_before")) % 2 == 0, F.col("_order")))
    last = marked.groupBy(*keys, "_block").agg(F.max("_start").alias("_last")) \
        .withColumn("_carried", F.max("_last").over(blocks)).drop("_last")
    record = F.coalesce(F.max("_start").over(upto), F.col("_carried"))
    return marked.join(last, [*group, "_block"]).withColumn("_record", record).groupBy(*keys, F.col("_record").alias(order)).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_order", "_line"))), lambda x: x["_line"]), "\n").alias(value))
