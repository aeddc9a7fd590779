"""Main text of web pages, by removing what recurs on a site.

Every element's subtree has a fingerprint. Spark counts, for each host, the
different texts (articles inside marked articles, else pages) that a fingerprint
stands in; one that stands in at least MIN_PAGES pages, or MIN_ARTICLES articles,
is part of the site's template, and its subtree is deleted. Copies of a page or
article count once, so that copied texts stay, and the numbers don't depend on
how many pages a host has. Prose is no template: lines without a class, id or role
(paragraphs, headings, quotations, items) stay, however many pages have the same,
and inside articles only labelled containers go. What a page alone can tell
(navigation, forms, advert or comment classes) is left out too. The main text is what
is left; where a page marks articles that hold a fair share of it, theirs alone.

A page meets its templates by a join on (host, fingerprint) and one on (host, hash
of the page); what is on very many pages is broadcast, and pages with very many
copies are salted, so that neither a host nor a template nor a page is one task's.

Defined results: null html gives an empty text; a null or odd url is a host of
its own; markup that isn't closed is closed where HTML says; repeated rows give
repeated results and count as one page; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innlake.llm import page_tree
from innlake.session import scratch_path

MIN_PAGES = 3
MIN_ARTICLES = 5
#: Rows of a fingerprint, and copies of a page, that one task may meet in a join.
HOT_ROWS = 10_000
HOT_COPIES = 1000
SALTS = 64
#: Rows of a table that every task gets; a larger one is joined by shuffles.
SHARED_ROWS = 200_000
#: Files that a filtered, small table is written to, whatever the number of partitions before.
FILES = 8


def host(url: str) -> Column:
    """Lower-case host of a url; empty if there is none."""
    found = F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def _shared(rows: DataFrame) -> DataFrame:
    """Broadcast if it has few rows."""
    return F.broadcast(rows) if rows.limit(SHARED_ROWS + 1).count() <= SHARED_ROWS else rows


def _candidates(pages: DataFrame) -> DataFrame:
    """(host, doc, print, vote, inside) of the elements of pages (host, doc, html) that may be templates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, int]] = set()
        for batch in batches:
            rows = []
            for h, d, source in zip(*(batch.column(c).to_pylist() for c in ("host", "doc", "html"))):
                if (h, d) not in seen:
                    if len(seen) > 100_000:
                        seen.clear()
                    seen.add((h, d))
                    rows += [(h, d, *found) for found in page_tree.prints(page_tree.parse(source or ""))]
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["host", "doc", "print", "vote", "inside"])

    return pages.select("host", "doc", "html").mapInArrow(
        run, "host string, doc long, print long, vote long, inside boolean")


def templates(pages: DataFrame) -> DataFrame:
    """(host, doc, prints): the fingerprints on each page that recur on its host, of pages (host, doc, html)."""
    spark = pages.sparkSession
    path, known = scratch_path(spark, "elements"), scratch_path(spark, "templates")
    _candidates(pages).write.parquet(path)
    rows = spark.read.parquet(path)
    rows.groupBy("host", "print", "inside", "vote").agg(F.count("*").alias("n")) \
        .groupBy("host", "print", "inside").agg(F.count("*").alias("votes"), F.sum("n").alias("n")) \
        .select("host", "print", (F.col("n") > HOT_ROWS).alias("hot"),
                (F.col("votes") >= F.when(F.col("inside"), MIN_ARTICLES).otherwise(MIN_PAGES)).alias("recurs")) \
        .filter("hot or recurs").repartition(FILES).write.parquet(known)
    counted = spark.read.parquet(known)
    hot = counted.filter("hot").select("host", "print", "recurs")
    tagged = rows.select("host", "doc", "print").join(_shared(hot), ["host", "print"], "left")
    rare = counted.filter("not hot").select("host", "print")
    found = tagged.filter("recurs").select("host", "doc", "print").unionByName(
        tagged.filter("recurs is null").join(rare, ["host", "print"]).select("host", "doc", "print"))
    return found.groupBy("host", "doc").agg(F.collect_set("print").alias("prints"))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """key, url and text of every page."""
    rows = pages.select(F.col(key).alias("own"), F.col(url).alias("url"), F.col(source).alias("html"),
                        host(url).alias("host"), F.xxhash64(source).alias("doc"))
    path = scratch_path(pages.sparkSession, "recurring")
    templates(rows).write.parquet(path)
    known = pages.sparkSession.read.parquet(path)
    path = scratch_path(pages.sparkSession, "copied")
    rows.groupBy("host", "doc").count().filter(F.col("count") > HOT_COPIES) \
        .select("host", "doc", F.lit(True).alias("copied")).repartition(FILES).write.parquet(path)
    copied = _shared(pages.sparkSession.read.parquet(path))
    kind = rows.schema["own"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [page_tree.text(page_tree.parse(html or ""), set(prints or ()))
                   for html, prints in zip(batch.column("html").to_pylist(), batch.column("prints").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("own"), batch.column("url"), pa.array(out, pa.string())], names=["own", "url", "text"])

    salts = F.when(F.col("copied"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    known = known.join(copied, ["host", "doc"], "left").withColumn("salt", F.explode(salts)).drop("copied")
    salt = F.when(F.col("copied"), F.col("at") % SALTS).otherwise(0).cast("int")
    salted = rows.withColumn("at", F.monotonically_increasing_id()).join(copied, ["host", "doc"], "left") \
        .withColumn("salt", salt)
    return salted.join(known, ["host", "doc", "salt"], "left").select("own", "url", "html", "prints") \
        .mapInArrow(run, f"own {kind}, url string, text string").withColumnRenamed("own", key)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all `pages`."""
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
