"""Query registry: each query stands next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``; without ``sql`` only the rows are checked."""
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table as it lies; its schema is read from a footer once per process and path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def spread(rows: DataFrame) -> DataFrame:
    """Short rows dealt out evenly before long work on each of them.

    A table of a few short columns is one split however many rows it has, so all texts made
    of it would be made and read in one task; its rows are moved before that, not the texts.
    """
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def texts_of(spark: SparkSession, sf_dir: str, name: str, *exprs: str) -> DataFrame:
    """``derived`` for texts that are read at length afterwards."""
    return spread(table(spark, sf_dir, name)).selectExpr(*exprs)


def derived(spark: SparkSession, sf_dir: str, name: str, *exprs: str) -> DataFrame:
    """A table with columns computed by SQL text that both engines read alike."""
    return table(spark, sf_dir, name).selectExpr(*exprs)
