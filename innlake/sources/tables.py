"""Warehouse-style Parquet tables: declared schema, overwrite, append by name.

An append replaces the partition of its own writer and batch, so a retried
batch never adds rows twice and writers never touch each other's rows.
"""

from __future__ import annotations

import json
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innlake.functions.sqltext import name

WRITER, BATCH = "writer", "batch_id"
LOAD = "load"
POINTER = "version int, schema string, partition_by array<string>"


class TableMissingError(LookupError):
    """The target of an append or a scan has not been created."""


class SchemaMismatchError(ValueError):
    """The frame lacks columns of the table, or brings others."""


def conform_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name, in table order and type."""
    if set(df.columns) != set(schema.names):
        raise SchemaMismatchError(
            f"missing {sorted(set(schema.names) - set(df.columns))}, "
            f"unexpected {sorted(set(df.columns) - set(schema.names))}")
    return df.selectExpr(*[
        f"cast({name(f.name)} as {f.dataType.simpleString()}) as {name(f.name)}" for f in schema
    ])


class Table:
    """A named table below the warehouse folder.

    Rows live in `<table>/v<version>/writer=<name>/batch_id=<n>`. An overwrite fills a new
    version and then adds a pointer row with its schema, so readers see either
    the old or the new table, and a job that dies half-way leaves the old one.
    """

    def __init__(self, spark: SparkSession, root: str, table: str):
        self.spark, self.name = spark, table
        self.path = f"{root.rstrip('/')}/{table}"

    def _current(self) -> tuple[int, T.StructType, list[str]]:
        try:
            pointers = self.spark.read.schema(POINTER).parquet(f"{self.path}.pointers")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                raise TableMissingError(self.name) from error
            raise
        latest = pointers.orderBy(F.desc("version")).first()
        if latest is None:
            raise TableMissingError(self.name)
        return latest["version"], T.StructType.fromJson(json.loads(latest["schema"])), latest["partition_by"] or []

    def schema(self) -> T.StructType:
        return self._current()[1]

    def exists(self) -> bool:
        try:
            self._current()
        except TableMissingError:
            return False
        return True

    def create(self, schema: T.StructType, partition_by: list[str] | None = None) -> None:
        """An empty table; creating an existing one empties it."""
        self.overwrite(self.spark.createDataFrame([], schema), partition_by)

    def overwrite(self, df: DataFrame, partition_by: list[str] | None = None) -> None:
        """Replace content, schema and the columns of few values that files are kept apart by."""
        try:
            version = self._current()[0] + 1
        except TableMissingError:
            version = 1
        df.write.mode("overwrite").partitionBy(*partition_by or []).parquet(f"{self.path}/v{version}/{WRITER}={LOAD}/{BATCH}=0")
        pointer = self.spark.createDataFrame([(version, df.schema.json(), partition_by or [])], POINTER)
        pointer.coalesce(1).write.mode("append").parquet(f"{self.path}.pointers")

    def append(self, df: DataFrame, batch_id: int, writer: str) -> None:
        """Add rows by column name under the writer's own batch.

        Batch ids count within a writer. A writer that repeats one replaces what
        it wrote under it; a different source of rows needs a name of its own.
        """
        if batch_id < 1:
            raise ValueError("batch ids of appends start at 1; 0 is the overwrite load")
        if writer == LOAD or not re.fullmatch(r"[A-Za-z0-9._-]+", writer):
            raise ValueError(f"{writer!r} is no name for a writer")
        version, schema, partition_by = self._current()
        rows = conform_to_schema(df, schema)
        rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{self.path}/v{version}/{WRITER}={writer}/{BATCH}={batch_id}")

    def batches(self) -> DataFrame:
        """All rows with the writer and the batch they came with."""
        # The known schema spares a footer scan over every stored file.
        version, schema, _ = self._current()
        stored = T.StructType([*schema, T.StructField(WRITER, T.StringType()), T.StructField(BATCH, T.LongType())])
        return self.spark.read.schema(stored).parquet(f"{self.path}/v{version}").select(*map(name, stored.names))

    def scan(self) -> DataFrame:
        return self.batches().drop(WRITER, BATCH)
