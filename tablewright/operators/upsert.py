"""Writing rows into existing tables: upsert with updated_at, insert-if-absent, seeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import keep_first


def upsert(
    target: DataFrame,
    updates: DataFrame,
    key: Sequence[str],
    now: object,
    touched: str = "updated_at",
) -> DataFrame:
    """The target after the updates; `touched` is `now` on rows an update changed.

    Both sides are unique by key.  Rows only in `updates` are inserted as they are.  Columns the
    updates lack keep their value.
    """
    stamp: Column = (now if isinstance(now, Column) else F.lit(now)).cast("timestamp")
    given = [c for c in updates.columns if c not in key]
    fresh = updates.select(
        *key, *[F.col(c).alias(f"__new_{c}") for c in given], F.lit(True).alias("__update")
    )
    old = target.withColumn("__old", F.lit(True))
    both = old.join(fresh, list(key), "full_outer")
    is_update = F.col("__update").isNotNull() & F.col("__old").isNotNull()
    changed = is_update & _any_change([c for c in given if c in target.columns and c != touched])
    columns = []
    for c in target.columns:
        if c in key:
            columns.append(F.col(c))
            continue
        value = F.when(F.col("__update"), F.col(f"__new_{c}")).otherwise(F.col(c)) if c in given else F.col(c)
        if c == touched:
            value = F.when(changed, stamp).when(F.col("__old"), F.col(c)).otherwise(value)
        columns.append(value.alias(c))
    return both.select(*columns)


def _any_change(columns: Sequence[str]) -> Column:
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"__new_{c}"))
    return changed


def insert_if_absent(
    target: DataFrame, batch: DataFrame, key: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The rows of a batch that may be inserted: first per key, and no such key in the target.

    As in a unique index, keys with a NULL part never collide, so those rows are all inserted.
    """
    complete = batch.dropna(subset=list(key))
    partial = batch.where(~_complete(key))
    first = keep_first(complete, key, order)
    fresh = first.join(target.select(*key).dropna(), list(key), "left_anti")
    return fresh.select(*batch.columns).unionByName(partial)


def _complete(key: Sequence[str]) -> Column:
    whole = F.lit(True)
    for c in key:
        whole = whole & F.col(c).isNotNull()
    return whole


def seed(target: DataFrame, rows: DataFrame, key: Sequence[str] = ("id",)) -> DataFrame:
    """The target plus the seed rows whose key it lacks."""
    fresh = rows.join(target.select(*key), list(key), "left_anti")
    return target.unionByName(fresh.select(*rows.columns), allowMissingColumns=True)
