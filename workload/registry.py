"""Names of the registered queries, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threadlens.session import spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given Parquet tables by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


class SpreadTables(Tables):
    """The same tables for work that is costly per row."""

    def __getattr__(self, name: str) -> DataFrame:
        return spread(super().__getattr__(name))


def query(name: str, sql: str | None = None, tables: type[Tables] = Tables) -> Callable:
    """Register a function of the tables; without ``sql`` only its rows can be looked at."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
