"""Queries with SQL against their SQL on the small tables."""

import duckdb
import pytest

from innlake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        duck.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    relation = duck.sql(ORACLES[name])
    found = QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(relation.columns)
    wanted = sorted(map(repr, relation.select(*found.columns).fetchall()))
    assert sorted(repr(tuple(r)) for r in found.collect()) == wanted
