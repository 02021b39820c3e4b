"""Surrogate keys and keep-first rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_SLOT_BITS = 33  # monotonically_increasing_id keeps the row position in the lower 33 bits


def dense_ids(df: DataFrame, order: Sequence[str], id_column: str = "id", start: int = 0) -> DataFrame:
    """Number the rows start+1, start+2, ... in the order of `order`, which must be unique.

    No global window: rows are range-partitioned and sorted, each takes its partition number and
    its position there, and the counts of the partitions before it are added.  The positions are
    written once, because they must be the same in the count and in the use.
    """
    keys = [F.col(f"`{c}`").asc_nulls_last() for c in order]
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("__at", F.monotonically_increasing_id())
    )
    placed = materialize(placed, "ids")
    slot = F.shiftright(F.col("__at"), _SLOT_BITS)
    position = F.col("__at").bitwiseAND((1 << _SLOT_BITS) - 1)
    # one row per partition, so the ordered window and the broadcast are bounded by their number
    counts = placed.groupBy(slot.alias("__slot")).agg((F.max(position) + 1).alias("__n"))
    before = Window.orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__slot", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    numbered = placed.withColumn("__slot", slot).join(F.broadcast(offsets), "__slot")
    number = (F.col("__before") + position + 1 + F.lit(start)).cast("long")
    return numbered.select(number.alias(id_column), *[f"`{c}`" for c in df.columns])


def high_water_mark(df: DataFrame, id_column: str = "id") -> int:
    """Largest id in use; 0 for an empty table or one without the column."""
    if id_column not in df.columns:
        return 0
    return df.agg(F.max(id_column).alias("m")).first()["m"] or 0


def next_ids(existing: DataFrame, fresh: DataFrame, order: Sequence[str], id_column: str = "id") -> DataFrame:
    """Give the rows of `fresh` the ids that follow those of `existing`."""
    return dense_ids(fresh, order, id_column, start=high_water_mark(existing, id_column))


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in the given order.

    An aggregate, not a window: rows of a key are reduced before the shuffle, so a key that holds
    most of the rows costs no more than any other.
    """
    rest = [c for c in df.columns if c not in key]
    by = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    first = df.groupBy(*key).agg(F.min_by(F.struct(*[f"`{c}`" for c in rest]), by).alias("__row"))
    return first.select(
        *[F.col(c) if c in key else F.col(f"__row.`{c}`").alias(c) for c in df.columns]
    )


def repeats(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All rows that are not the first of their key ("seen before").

    The first position per key is an aggregate; comparing it needs the key's rows next to it, which
    `attach` keeps balanced.
    """
    from .joins import attach

    place = F.struct(*[F.col(c) for c in order])
    firsts = df.dropna(subset=list(key)).groupBy(*key).agg(F.min(place).alias("__first"))
    marked = attach(df, firsts, {k: k for k in key}, take=["__first"])
    return marked.where(place > F.col("__first")).drop("__first")
