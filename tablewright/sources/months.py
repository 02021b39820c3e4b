"""Fact tables laid out by month: clustered files, reads that prune, upserts that rewrite what they name.

A table is a folder of Parquet files partitioned by `month` (year * 100 + month of its date, an int, NULL for
rows without a date).  Rows are range-partitioned by month, date and further columns before the write, so a
month that holds a third of all rows is spread over many tasks, and each file covers one stretch of dates,
sorted: row groups outside a range of dates are skipped inside a month as well.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import attach
from ..operators.upsert import upsert
from ..session import materialize

MONTH = "month"
_DIGITS = "decimal(38,0)"
_ABOVE_IDS = "10000000000000000000"  # 10**19, above every long


def month_of(date: str | Column) -> Column:
    """The partition of a date or timestamp column."""
    d = F.col(f"`{date}`") if isinstance(date, str) else date
    return (F.year(d) * 100 + F.month(d)).cast("int")


def _clustered(df: DataFrame, date: str, within: Sequence[str]) -> DataFrame:
    keys = [F.col(MONTH), *[F.col(f"`{c}`") for c in (date, *within)]]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_months(df: DataFrame, path: str, date: str, within: Sequence[str] = ()) -> None:
    """Write a table by month of `date`; inside a month files follow `date` and the columns `within`."""
    placed = df.withColumn(MONTH, month_of(date))
    _clustered(placed, date, within).write.mode("errorifexists").partitionBy(MONTH).parquet(path)


def read_months(
    spark: SparkSession, path: str, date: str, since: datetime.date | None = None, until: datetime.date | None = None
) -> DataFrame:
    """The rows with `since` <= date < `until`; only partitions that can hold such rows are listed and read.

    Rows without a date are returned only if no bound is given.
    """
    df = spark.read.parquet(path)
    if since is not None:
        df = df.where((F.col(MONTH) >= since.year * 100 + since.month) & (F.col(date) >= F.lit(since)))
    if until is not None:
        df = df.where((F.col(MONTH) <= until.year * 100 + until.month) & (F.col(date) < F.lit(until)))
    return df


def latest_per(df: DataFrame, entity: Sequence[str], at: str, id_column: str) -> DataFrame:
    """The latest row of each entity; of rows at the same time the one with the greatest id.

    Ids are unique and not negative, times not before 1970; rows without a time or an id are never the latest.
    NULL is an entity like any other.  Two passes: the first reads the entity, the time and the id
    only and reduces them before the shuffle (one fixed-width number per entity, so it is a hash
    aggregate without any sort), the second keeps the rows whose ids won.
    """
    moment = F.unix_micros(F.col(f"`{at}`").cast("timestamp")).cast(_DIGITS)
    rank = moment * F.lit(_ABOVE_IDS).cast("decimal(20,0)") + F.col(f"`{id_column}`").cast("decimal(20,0)")
    best = df.groupBy(*[F.col(f"`{c}`") for c in entity]).agg(F.max(rank.cast(_DIGITS)).alias("__rank"))
    won = best.select((F.col("__rank") % F.lit(_ABOVE_IDS).cast("decimal(20,0)")).cast("long").alias("__won"))
    winners = materialize(won.dropna(), "latest")
    return attach(df, winners, {id_column: "__won"}, how="left_semi")


def upsert_months(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: Sequence[str],
    date: str,
    now: object,
    within: Sequence[str] = (),
    moved: bool = False,
    touched: str = "updated_at",
) -> list[int | None]:
    """Upsert into a table written by `write_months`; returns the months that were rewritten.

    `updates` must hold `date`.  Only the months that updates name are read and replaced, all others keep their
    files.  With `moved` the old months of updated keys count as named too; they are found by a semi-join
    over key and month alone.  The new months are staged first, so no file is read while it
    is replaced, and are put in place by one dynamic overwrite.
    """
    if date not in updates.columns:
        raise ValueError(f"updates need the column {date!r}, which tells the month")
    target = spark.read.parquet(path)
    order = [c for c in target.columns if c != MONTH]
    staged = materialize(updates, "updates")
    named = staged.select(month_of(date).alias(MONTH)).distinct()
    if moved:
        keyed = target.select(*key, MONTH)
        old = attach(keyed, staged.select(*key).distinct(), {k: k for k in key}, how="left_semi") if len(key) == 1 else (
            keyed.join(staged.select(*key).distinct(), list(key), "left_semi")
        )
        named = named.unionByName(old.select(MONTH)).distinct()
    months = [r[MONTH] for r in named.collect()]  # one row per month
    fresh = upsert(target.where(_within(months)).select(*order), staged, key, now, touched)
    ready = materialize(fresh.withColumn(MONTH, month_of(date)), "months")
    overwrite = _clustered(ready, date, within).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    overwrite.partitionBy(MONTH).parquet(path)
    if moved:  # months that all rows have left
        left = {r[MONTH] for r in ready.select(MONTH).distinct().collect()}
        _remove(spark, path, [m for m in months if m not in left])
    return sorted(months, key=lambda m: (m is None, m or 0))


def _within(months: Sequence[int | None]) -> Column:
    known = [m for m in months if m is not None]
    hit = F.col(MONTH).isin(known) if known else F.lit(False)
    return hit | F.col(MONTH).isNull() if None in months else hit


def _remove(spark: SparkSession, path: str, months: Sequence[int | None]) -> None:
    for m in months:
        name = "__HIVE_DEFAULT_PARTITION__" if m is None else str(m)
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MONTH}={name}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
