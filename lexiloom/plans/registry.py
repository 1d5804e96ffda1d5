"""Registry of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` is the same result in DuckDB."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str, *key: str) -> DataFrame:
    """A table whose rows carry whole texts, dealt over the cores if its files
    give fewer scan tasks than there are cores. A table of many files or row
    groups is read as it lies, without a shuffle."""
    df = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores, *key) if df.rdd.getNumPartitions() < cores else df
