"""Registered queries against their SQL, and the shape of their plans."""

import re

import duckdb
import pytest

import __spark_entry__ as contract
from innlake.operators import conform
from innlake.operators.cleaning import clean_listings
from innlake.operators.splitting import quarter_slice
from innlake.plans.catalog import QUERIES
from innlake.plans.oracles import oracles
from innlake.session import scratch_path
from innlake.sources.booking_views import bookings, listings
from innlake.sources.tables import Table

SF = "/root/testdata/sf0.001"
NARROW = ["conform_price", "conform_cancel", "monthly_price", "monthly_cancel", "listing_clean",
          "quarter_slice", "train_test_split", "adr_category", "period_parse", "union_by_name"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("orders", "part", "events", "embeddings"):
        connection.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


def cells(rows, columns):
    return sorted(repr([row[c] for c in columns]) for row in rows)


# Hundreds of rounds or trees each; tests/test_learners.py fits the same presets at small sizes.
HEAVY = {n for n in QUERIES if re.match(r"(reg|cls)_(random_forest|extra_trees|gbt|adaboost|leafwise|second_order$|ordered)", n)}


@pytest.mark.parametrize("name", sorted(set(oracles()) - HEAVY))
def test_query_equals_its_sql(spark, duck, name):
    found = QUERIES[name](spark, SF).toArrow().to_pylist()
    relation = duck.sql(oracles()[name])
    expected = [dict(zip(relation.columns, row)) for row in relation.fetchall()]
    assert expected and set(found[0]) == set(expected[0])
    columns = sorted(expected[0])
    assert cells(found, columns) == cells(expected, columns)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NARROW)
def test_row_wise_queries_do_not_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "Exchange" not in text and "Python" not in text


def test_no_query_of_the_row_wise_kind_uses_a_cross_join(spark):
    for name in ("frame_messages", "frame_messages_unreset", "champion_select", "corr_matrix", "iqr_outliers",
                 "knn_classify"):
        text = plan(QUERIES[name](spark, SF))
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text), name


def test_stored_features_are_filtered_and_pruned_in_the_scan(spark):
    table = Table(spark, scratch_path(spark, "plans"), "price")
    table.overwrite(conform.historical_price(bookings(spark, SF)), ["arrival_date_year"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    text = plan(quarter_slice(table.scan(), 3, 1997).select("adr"))
    assert re.search(r"PartitionFilters: \[[^]]*\(arrival_date_year#\d+ = 1997\)", text)
    assert re.search(r"ReadSchema: struct<adr:int,(`?arrival_date_month_\w+`?:int,?){3}>", text)


def test_listing_bounds_reach_the_scan(spark, tmp_path):
    listings(spark, SF).write.parquet(str(tmp_path / "listings"))
    text = plan(clean_listings(spark.read.parquet(str(tmp_path / "listings"))))
    assert "Or(IsNull(accommodates),LessThanOrEqual(accommodates,10))" in text


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
