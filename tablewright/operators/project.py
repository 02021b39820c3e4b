"""Projections: renames, optional columns, audit columns, empty columns, row order."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip, text_columns

# --- fixed values -------------------------------------------------------------------------------
UNNAMED = re.compile(r"^unnamed(:\s*\d+)?$", re.IGNORECASE)
AUDIT_COLUMNS = {
    "created_at": "timestamp", "updated_at": "timestamp", "deleted_at": "timestamp",
    "deleted_by_user_id": "long", "ingest_event_id": "long",
}
# ------------------------------------------------------------------------------------------------


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def column_or(df: DataFrame, name: str, data_type: str, default: object = None) -> Column:
    """The column cast to a type, or a typed default if the frame lacks it."""
    found = F.col(f"`{name}`") if name in df.columns else F.lit(default)
    return found.cast(data_type).alias(name)


def _constant(value: object, data_type: str) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast(data_type)


def _add(df: DataFrame, columns: Mapping[str, Column], overwrite: bool) -> DataFrame:
    fresh = {c: v for c, v in columns.items() if overwrite or c not in df.columns}
    return df.withColumns(fresh) if fresh else df


def now_utc() -> datetime:
    return datetime.now(timezone.utc)


def audited(df: DataFrame, values: Mapping[str, object] | None = None, overwrite: bool = False) -> DataFrame:
    """Audit columns in one projection: those named in `values`, or all five for None.

    A value is a constant, or a Column for one per row; without one `created_at` is now and the others
    NULL.  Columns that are there stay unless `overwrite`.
    """
    given = dict.fromkeys(AUDIT_COLUMNS) if values is None else dict(values)
    unknown = sorted(set(given) - set(AUDIT_COLUMNS))
    if unknown:
        raise ValueError(f"no audit columns: {unknown}")
    if given.get("created_at", True) is None:
        given["created_at"] = now_utc()
    return _add(df, {c: _constant(given[c], kind) for c, kind in AUDIT_COLUMNS.items() if c in given}, overwrite)


def alive(df: DataFrame, column: str = "deleted_at") -> DataFrame:
    """Rows that are not soft-deleted."""
    return df.where(F.col(column).isNull())


def empty_columns(
    df: DataFrame, unnamed: bool = True, all_null: bool = True, all_blank: bool = True
) -> list[str]:
    """Columns without content, found by one aggregate over the table."""
    text = set(text_columns(df))
    checks = {}
    for name in df.columns:
        c = F.col(f"`{name}`")
        if all_blank and name in text:
            checks[name] = F.count_if(strip(c) != "")
            if not all_null:
                # an all-NULL text column counts as blank as well
                continue
        elif all_null:
            checks[name] = F.count(c)
    empty: set[str] = set()
    if checks:
        row = df.agg(*[v.alias(f"c{i}") for i, v in enumerate(checks.values())]).first()
        empty = {name for i, name in enumerate(checks) if row[f"c{i}"] == 0}
    if unnamed:
        empty |= {c for c in df.columns if UNNAMED.match(c.strip())}
    return [c for c in df.columns if c in empty]


def drop_empty_columns(df: DataFrame, **options: bool) -> DataFrame:
    return df.drop(*empty_columns(df, **options))


def union_aligned(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; columns one frame lacks are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def column_difference(df: DataFrame, target: Sequence[str]) -> tuple[list[str], list[str]]:
    """(columns of the target that are missing, columns that are not in the target)."""
    have = set(df.columns)
    return [c for c in target if c not in have], [c for c in df.columns if c not in set(target)]


def more_than_one(columns: Sequence[str]) -> Column:
    """True where more than one of the columns has a value."""
    return F.size(F.array_compact(F.array(*[F.col(c) for c in columns]))) > 1


def profile(df: DataFrame) -> DataFrame:
    """Per column: type, non-null count, null count.  One pass over the table."""
    types = dict(df.dtypes)
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit(types[c]).alias("dtype"),
                F.col(f"c{i}").alias("non_null"),
                (F.col("n") - F.col(f"c{i}")).alias("nulls"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return counts.select(F.inline(rows))


def dtypes_text(df: DataFrame) -> str:
    """`name: type` lines of a frame."""
    return "\n".join(f"{name}: {kind}" for name, kind in df.dtypes)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in floating-point columns."""
    return df.select(
        *[
            F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
