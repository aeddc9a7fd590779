import pytest

from innlake.plans.catalog import QUERIES
from innlake.schemas import MONTHLY, struct
from innlake.session import scratch_path
from innlake.sources.csv_files import csv_header, csv_line, join_quoted_lines, parse_csv_lines, parse_csv_messages, read_csv, write_csv
from innlake.sources.tables import SchemaMismatchError, Table, TableMissingError

SF = "/root/testdata/sf0.001"
PAIR = struct({"name": "string", "n": "int", "x": "double"})


def write_text(spark, lines):
    path = scratch_path(spark, "text")
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


def test_missing_tokens_and_whole_numbers_with_point(spark):
    path = write_text(spark, ["name,n,x", 'a,2.0,1.5', 'NA,NaN,NULL', '"b,c",,', '"say ""hi""",7,n/a'])
    rows = sorted(read_csv(spark, path, PAIR).collect(), key=str)
    assert {tuple(r) for r in rows} == {
        ("a", 2, 1.5), (None, None, None), ("b,c", None, None), ('say "hi"', 7, None)}


def test_bad_numbers_fail_or_become_missing(spark):
    path = write_text(spark, ["name,n,x", "a,two,1.5"])
    with pytest.raises(Exception):
        read_csv(spark, path, PAIR).collect()
    assert read_csv(spark, path, PAIR, strict=False).first().n is None


def test_header_names_are_checked(spark):
    path = write_text(spark, ["name,x,n", "a,1.5,2"])
    with pytest.raises(Exception):
        read_csv(spark, path, PAIR).collect()


def test_csv_files_round_trip(spark):
    df = spark.createDataFrame([('q"uo,te', 1, 0.1), (None, None, None), (" pad ", -5, 1e-300)], PAIR)
    path = scratch_path(spark, "csv-test")
    write_csv(df, path)
    assert sorted(read_csv(spark, path, PAIR).collect(), key=str) == sorted(df.collect(), key=str)


def test_lines_keep_quoted_commas_and_skip_headers(spark):
    df = spark.createDataFrame([('a,"b"', 1, 2.5), (None, None, None)], PAIR)
    lines = df.select(csv_line(PAIR.names).alias("value"))
    header = spark.createDataFrame([(csv_header(PAIR.names),), ("x,1,1\n\ny,2,2",)], "value string")
    parsed = parse_csv_lines(lines.unionByName(header), "value", PAIR)
    assert {tuple(r) for r in parsed.collect()} == {
        ('a,"b"', 1, 2.5), (None, None, None), ("x", 1, 1.0), ("y", 2, 2.0)}


def test_line_breaks_inside_quotes_stay(spark):
    text = 'name,n,x\n"a\nb",1,2.5\r\n"say ""hi""\n\n, you",2,1\n\nplain,3,0\n"",4,\n"last\n",5,1'
    df = spark.createDataFrame([(text,), ('"one\ntwo",6,6',)], "value string")
    parsed = parse_csv_lines(df, "value", PAIR).collect()
    assert {tuple(r) for r in parsed} == {
        ("a\nb", 1, 2.5), ('say "hi"\n\n, you', 2, 1.0), ("plain", 3, 0.0), (None, 4, None), ("last\n", 5, 1.0), ("one\ntwo", 6, 6.0)}


@pytest.mark.parametrize("block_span", [1_000_000, 3])
def test_quoted_lines_are_joined(spark, block_span):
    lines = ["a,1", '"b', "c", 'd",2', '"e""', '"', '",3', "f,4", "", '"g"",", h",5', '"open', "end"]
    rows = [(g, i * 2 + g, line) for g in (0, 1) for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "g int, at long, line string").repartition(4)
    found = sorted(map(tuple, join_quoted_lines(df, "line", "at", ["g"], block_span).collect()))
    wanted, inside = [], False
    for g, at, line in rows:
        if inside:
            wanted[-1][2].append(line)
        else:
            wanted.append((g, at, [line]))
        inside ^= line.count('"') % 2 == 1
        if at >= 2 * (len(lines) - 1):
            inside = False
    assert found == sorted((g, at, "\n".join(x)) for g, at, x in wanted)


def test_csv_text_is_made_once(spark):
    spark.catalog.clearCache()  # a kept table's plan would be shown as well
    plan = QUERIES["csv_parse_lines"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("to_csv") == 1 and plan.count("from_csv") == 1


def test_overwrite_replaces_schema_and_append_is_by_name_and_idempotent(spark):
    table = Table(spark, scratch_path(spark, "warehouse"), "t")
    one = spark.createDataFrame([(1, "a")], "k int, `a b/c` string")
    with pytest.raises(TableMissingError):
        table.append(one, 1, "w")
    assert not table.exists()
    table.overwrite(spark.createDataFrame([(1,)], "other int"))
    table.overwrite(one)
    swapped = spark.createDataFrame([("b", 2)], "`a b/c` string, k int")
    for _ in range(2):
        table.append(swapped, 1, "w")
    assert sorted(tuple(r) for r in table.scan().collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(SchemaMismatchError):
        table.append(spark.createDataFrame([(1,)], "k int"), 2, "w")
    table.overwrite(one)
    assert table.scan().count() == 1


def test_created_table_is_empty_with_its_schema(spark):
    table = Table(spark, scratch_path(spark, "warehouse"), "t")
    table.create(MONTHLY)
    assert table.exists() and table.scan().count() == 0
    assert table.schema().names == MONTHLY.names


def test_a_fraction_is_no_whole_number(spark):
    path = write_text(spark, ["name,n,x", "a,2.7,1"])
    with pytest.raises(Exception, match="not whole"):
        read_csv(spark, path, PAIR).collect()
    assert read_csv(spark, path, PAIR, strict=False).first().n is None


def test_messages_are_one_row_each_with_a_reason(spark):
    values = ['a,1,2.5', '"two\nlines, one field",2,NA', "b,2.7,x", "c,1", csv_header(PAIR.names), " ", 'd,3.0,']
    df = spark.createDataFrame([(v,) for v in values], "line string")
    found = {r.name: (r.n, r.x, r.reason) for r in parse_csv_messages(df, "line", PAIR).collect()}
    assert found == {
        "a": (1, 2.5, None), "two\nlines, one field": (2, None, None), "d": (3, None, None),
        "b": (None, None, "unreadable: n x"), "c": (1, None, "wrong number of fields")}


def test_writers_keep_their_rows_apart(spark):
    table = Table(spark, scratch_path(spark, "warehouse"), "t")
    table.create(struct({"k": "int"}))
    for k, writer in enumerate(["stream-a", "files", "stream-b", "files"]):
        table.append(spark.createDataFrame([(k,)], "k int"), 1, writer)
    assert sorted(r.k for r in table.scan().collect()) == [0, 2, 3]
    for writer in ("load", "a/b", ""):
        with pytest.raises(ValueError):
            table.append(spark.createDataFrame([(1,)], "k int"), 1, writer)
