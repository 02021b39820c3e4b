"""Registration of queries with their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablewright.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one scale."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        ship(spark)  # queries may run functions of the package in Python workers
        self.spark = spark
        self.folder = folder

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of `Tables` as a query, with SQL for the same result."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def columns(exprs: dict[str, str]) -> list[str]:
    """`name: expression` as a select list that both engines read."""
    return [f"{e} AS {n}" for n, e in exprs.items()]


def select_list(exprs: dict[str, str]) -> str:
    return ", ".join(columns(exprs))


def shifted(c: str) -> str:
    """A timestamp column as text, in DuckDB."""
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


STAMP = "yyyy-MM-dd HH:mm:ss"  # the same text in Spark's date_format
