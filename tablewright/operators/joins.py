"""Equi-joins that stay balanced at any size.

`attach` is the one join used for lookups, crosswalks, foreign keys and deletes.  The right side is
broadcast only after its size was measured; otherwise the join is shuffled, and keys that hold a
large share of the left side are spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024  # right sides measured above this are shuffled
HOT_SHARE = 0.002  # a key with this share of the left rows is hot, and so is one that would fill a ...
HOT_ROWS = 1_000_000  # ... shuffle partition of average size, provided it has this many rows
HOT_KEYS = 1000  # keys that the sketch reports; with P partitions at most P keys can fill one
TRACKED_KEYS = 20_000  # sketch size


@dataclass(frozen=True)
class Limits:
    """Thresholds of `attach`; tests lower them to reach every branch."""

    broadcast_bytes: int = BROADCAST_BYTES
    hot_share: float = HOT_SHARE
    hot_rows: int = HOT_ROWS


def row_bytes(df: DataFrame) -> Column:
    """Approximate bytes of one row: text by length, everything else by 8 bytes."""
    size = F.lit(16)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + 8
        else:
            size = size + 8
    return size


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame, by one aggregate over it."""
    return df.agg(F.sum(row_bytes(df)).alias("b")).first()["b"] or 0


def fits_broadcast(df: DataFrame, limits: Limits = Limits()) -> bool:
    return measured_bytes(df) <= limits.broadcast_bytes


def hot_hashes(df: DataFrame, key_hash: Column, limits: Limits = Limits()) -> list[int]:
    """Hashes of the keys that hold a large share of all rows.

    One pass with a mergeable frequent-items sketch: whole data, no shuffle of rows, and a result
    of at most HOT_KEYS entries.  It only decides how rows are distributed, never which rows.
    """
    row = (
        df.select(key_hash.alias("h"))
        .agg(
            F.expr(f"approx_top_k(h, {HOT_KEYS}, {TRACKED_KEYS})").alias("top"),
            F.count(F.lit(1)).alias("n"),
        )
        .first()
    )
    share = min(limits.hot_share, 1 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    floor = max(limits.hot_rows, row["n"] * share)
    return [item["item"] for item in (row["top"] or []) if item["count"] >= floor]


def hot_keys(left: DataFrame, on: Mapping[str, str | T.DataType], limits: Limits = Limits()) -> list[int]:
    """`hot_hashes` of a join of `left` on columns `{column: type of the other side's}`."""
    return hot_hashes(left.dropna(subset=list(on)), F.xxhash64(*[left[c].cast(t) for c, t in on.items()]), limits)


def attach(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    how: str = "left",
    take: Sequence[str] = (),
    limits: Limits = Limits(),
    small: bool | None = None,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Join `right` to `left` on `{left column: right column}`.

    Returns the left columns plus, for left and inner joins, the `take` columns of `right`.
    `small` states a size check already made by the caller, `hot` its `hot_keys`; None measures here.  On a
    streaming left side no action runs: its hot keys stay unknown, and the join is a plain one.
    """
    semi = how in ("left_semi", "left_anti")
    wanted = [] if semi else list(take)
    clash = set(wanted) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    keys = list(on.values())
    side = right.select(
        *[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)],
        *[F.col(f"`{c}`") for c in wanted],
    ).dropna(subset=[f"__k{i}" for i in range(len(keys))])
    if small is None:
        small = fits_broadcast(side, limits)

    condition = None
    for i, column in enumerate(on):
        term = left[column] == side[f"__k{i}"]
        condition = term if condition is None else condition & term
    out = left.columns + wanted

    if small:
        joined = left.join(F.broadcast(side), condition, how)
        return joined.select(*[f"`{c}`" for c in out])

    types = [side.schema[f"__k{i}"].dataType for i in range(len(keys))]
    left_hash = F.xxhash64(*[left[c].cast(t) for c, t in zip(on, types)])
    if left.isStreaming:
        return left.join(side, condition, how).select(*[f"`{c}`" for c in out])
    if hot is None:
        hot = hot_keys(left, dict(zip(on, types)), limits)
    keyless = F.lit(False)
    if how in ("left", "left_anti"):  # rows without a key stay, and need no partner: spread them
        for column in on:
            keyless = keyless | left[column].isNull()

    # Hot keys get a salt derived from the whole row (so a retried task repeats it), and the few
    # right rows that carry a hot key are copied once per salt.
    salts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row_hash = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in left.columns])
    spread_row = keyless | left_hash.isin(*hot) if hot else keyless
    salted = left.withColumn("__salt", F.when(spread_row, F.pmod(row_hash, F.lit(salts))).otherwise(F.lit(0)).cast("int"))
    right_hash = F.xxhash64(*[F.col(f"__k{i}") for i in range(len(keys))])
    copies = F.when(right_hash.isin(*hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    spread = side.withColumn("__copy", F.explode(copies) if hot else F.lit(0))
    condition = salted["__salt"] == spread["__copy"]
    for i, column in enumerate(on):
        condition = condition & (salted[column] == spread[f"__k{i}"])
    return salted.join(spread, condition, how).select(*[f"`{c}`" for c in out])
