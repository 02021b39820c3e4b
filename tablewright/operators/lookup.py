"""Value-to-id lookups against dimension tables."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import is_plain_int
from ..functions.text import cleaned_key, match_key
from ..session import COMPILED, materialize
from .joins import Limits, attach, hot_keys, row_bytes

EXAMPLES = 10  # how many offending values an error message shows


class ConformError(ValueError):
    """Input breaks a rule that strict mode enforces."""


@dataclass(frozen=True)
class Lookup:
    """Replace `column` by `{column}_id`, found where `label` of `table` has the same match key.

    Where a label is unique only inside something else, `within` pairs columns that must be equal as
    well: (column of the frame, column of the table).  They are columns of ids and are looked up first.
    """

    column: str
    table: str
    label: str
    id_column: str = "id"
    within: tuple[tuple[str, str], ...] = ()

    @property
    def target(self) -> str:
        return f"{self.column}_id"


@dataclass(frozen=True)
class Dimension:
    """A lookup side: one row per unambiguous key, and what is wrong with the rest."""

    keys: DataFrame  # __key, __id, and __in0, ... for the columns it is within
    ambiguous: DataFrame  # __key, n
    small: bool
    clean: bool
    whole: bool = False  # every __id is digits alone, as far as that was looked at


def dimension(
    tables: Mapping[str, DataFrame],
    lookup: Lookup,
    exact_casefold: bool = False,
    limits: Limits = Limits(),
    written: bool = False,
    cleaned: bool = False,
) -> Dimension:
    """Prepare a lookup side; one job measures its size and whether any key is ambiguous.

    `written` keeps the keys in the shared folder, for sides that many tables use; `cleaned` says that the labels
    are clean text.
    """
    if lookup.table not in tables:
        raise ConformError(f"lookup table {lookup.table!r} is not available")
    table = tables[lookup.table]
    inside = [f"__in{i}" for i in range(len(lookup.within))]
    for needed in (lookup.label, lookup.id_column, *[c for _, c in lookup.within]):
        if needed not in table.columns:
            raise ConformError(f"lookup table {lookup.table!r} has no column {needed!r}")
    pairs = table.select(
        _label_key(table, lookup.label, exact_casefold, cleaned).alias("__key"),
        F.col(lookup.id_column).alias("__id"),
        *[F.col(c).cast("long").alias(name) for name, (_, c) in zip(inside, lookup.within)],
    ).dropna()
    grouped = pairs.groupBy("__key", *inside).agg(F.min("__id").alias("__id"), F.count(F.lit(1)).alias("n"))
    wanted = (F.sum(row_bytes(grouped)).alias("b"), F.max("n").alias("n"))
    if written:
        seen = Observation()
        whole = F.bool_and(is_plain_int(F.col("__id").cast("string"))).alias("whole")
        grouped = materialize(grouped.observe(seen, *wanted, whole), "side")
        facts = seen.get
    else:
        facts = grouped.agg(*wanted).first()
    return Dimension(
        keys=grouped.where("n = 1").select("__key", "__id", *inside),
        # within other columns, the same label may be ambiguous several times
        ambiguous=grouped.where("n > 1").groupBy("__key").agg(F.sum("n").alias("n")),
        small=(facts["b"] or 0) <= limits.broadcast_bytes,
        clean=(facts["n"] or 0) <= 1,
        whole=written and bool(facts["whole"]),
    )


class Dimensions:
    """Lookup sides over a set of tables, each prepared once however many tables use it."""

    def __init__(
        self,
        tables: Mapping[str, DataFrame],
        exact_casefold: bool = False,
        limits: Limits = Limits(),
        written: bool = False,
        cleaned: bool = False,
    ) -> None:
        """`written` and `cleaned` as in `dimension`; with `cleaned`, the tables that look up are clean as well."""
        self._tables = tables
        self.exact_casefold = exact_casefold
        self.limits = limits
        self.written = written
        self.cleaned = cleaned
        self._sides: dict[tuple, Dimension] = {}

    def side(self, lookup: Lookup) -> Dimension:
        key = (lookup.table, lookup.label, lookup.id_column, tuple(c for _, c in lookup.within))
        if key not in self._sides:
            self._sides[key] = dimension(self._tables, lookup, self.exact_casefold, self.limits, self.written, self.cleaned)
        return self._sides[key]


def _fail_if_ambiguous(lookup: Lookup, dim: Dimension) -> None:
    if dim.clean:
        return
    shown = [r["__key"] for r in dim.ambiguous.orderBy("__key").limit(EXAMPLES).collect()]
    raise ConformError(f"{lookup.table}.{lookup.label} repeats keys after normalization, e.g. {shown}")


def unmatched(lookup: Lookup) -> Column:
    """True where a value was given but found no id; needs the frame of `with_keys`."""
    return F.col(f"__key_{lookup.column}").isNotNull() & F.col(lookup.target).isNull()


def with_keys(
    df: DataFrame, lookups: Sequence[Lookup], dimensions: Dimensions, strict: bool = False
) -> tuple[DataFrame, list[Lookup]]:
    """Attach all ids, keeping each match key as `__key_{column}`.

    Lookups whose column is absent are skipped; the ones applied are returned.  Ambiguous keys get
    no id (and fail when strict).  Small dimensions are broadcast, so the chain adds no shuffle.
    """
    applied = [lk for lk in lookups if lk.column in df.columns]
    out = _keyed(df, applied, dimensions)
    for lk in applied:
        _check_side(lk, out.columns, dimensions, strict)
        out = _with_id(out, lk, dimensions)
    return out, applied


def _keyed(df: DataFrame, applied: Sequence[Lookup], dimensions: Dimensions) -> DataFrame:
    return df.drop(*[lk.target for lk in applied]).withColumns(
        {f"__key_{lk.column}": _label_key(df, lk.column, dimensions.exact_casefold, dimensions.cleaned) for lk in applied}
    )


def _label_key(df: DataFrame, column: str, exact_casefold: bool, cleaned: bool) -> Column:
    key = cleaned_key if cleaned and isinstance(df.schema[column].dataType, T.StringType) else match_key
    return key(F.col(column).cast("string"), exact_casefold=exact_casefold)


def _check_side(lookup: Lookup, columns: Sequence[str], dimensions: Dimensions, strict: bool) -> None:
    dim = dimensions.side(lookup)
    if strict:
        _fail_if_ambiguous(lookup, dim)
    for own, _ in lookup.within:
        if own not in columns:
            raise ConformError(f"{lookup.column!r} is looked up within {own!r}, which the table does not have")


def _with_id(
    df: DataFrame, lookup: Lookup, dimensions: Dimensions, hot: Sequence[int] | None = None, as_long: bool = False
) -> DataFrame:
    dim, out = dimensions.side(lookup), df
    keys = dim.keys.withColumn("__id", F.col("__id").cast("long")) if as_long and dim.whole else dim.keys
    on = {f"__key_{lookup.column}": "__key"}
    for i, (own, _) in enumerate(lookup.within):
        out = out.withColumn(f"__own{i}", F.col(own).try_cast("long") if dict(out.dtypes)[own] == "string" else F.col(own).cast("long"))
        on[f"__own{i}"] = f"__in{i}"
    return attach(
        out,
        keys.withColumnRenamed("__id", lookup.target),
        on,
        take=[lookup.target],
        small=dim.small,
        limits=dimensions.limits,
        hot=hot,
    ).drop(*[f"__own{i}" for i in range(len(lookup.within))])


def lookup_report(keyed: DataFrame, applied: Sequence[Lookup]) -> DataFrame:
    """One row per lookup: how many values matched, how many did not.  One pass for all of them."""
    if not applied:
        raise ValueError("no lookups to report")
    counts = keyed.agg(
        *[F.count(lk.target).alias(f"m{i}") for i, lk in enumerate(applied)],
        *[F.count_if(unmatched(lk)).alias(f"u{i}") for i, lk in enumerate(applied)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(lk.column).alias("column"),
                F.lit(f"{lk.table}.{lk.label}").alias("lookup"),
                F.col(f"m{i}").alias("matched"),
                F.col(f"u{i}").alias("unmatched"),
            )
            for i, lk in enumerate(applied)
        ]
    )
    return counts.select(F.inline(rows))


def unmatched_values(keyed: DataFrame, lookup: Lookup) -> DataFrame:
    """The values without an id, with the number of rows of each."""
    return (
        keyed.where(unmatched(lookup))
        .groupBy(F.col(f"__key_{lookup.column}").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _small_first(applied: Sequence[Lookup], dimensions: Dimensions) -> list[Lookup]:
    """The order of the joins: small sides first, so that a row is shuffled with ids in place of labels.

    A lookup within ids that others find comes after those.
    """
    rest, out = list(applied), []
    while rest:
        free = [lk for i, lk in enumerate(rest) if not {own for own, _ in lk.within} & {x.target for x in rest[:i]}]
        out.append(next((lk for lk in free if dimensions.side(lk).small), free[0]))
        rest.remove(out[-1])
    return out


def _strict_ids(
    df: DataFrame,
    lookups: Sequence[Lookup],
    dimensions: Dimensions,
    what: str,
    then: Callable[[DataFrame], DataFrame],
    ints: Collection[str],
) -> DataFrame:
    """The frame with ids in place of labels, through `then`, written once; fails if a value found no id.

    Only what is asked for goes through the joins and into the write: labels stay behind, and of the keys those without
    an id remain.  All is counted during the write.
    """
    applied = [lk for lk in lookups if lk.column in df.columns]
    keyed = _keyed(df, applied, dimensions)
    if not applied:
        return then(keyed)
    have = list(keyed.columns)
    for lk in applied:
        _check_side(lk, have, dimensions, strict=True)
        have.append(lk.target)
    labels, inside = {lk.column for lk in applied}, {own for lk in applied for own, _ in lk.within}
    kept = [c for c in df.columns if c in keyed.columns and (c not in labels or c in inside)]
    keys = list(dict.fromkeys(f"__key_{lk.column}" for lk in applied))
    out = keyed.select(*[f"`{c}`" for c in (*kept, *keys)])
    # a first count ends the generated code of the cleaning, whose length would keep that of the joins from being compiled
    out = out.observe(Observation(), F.count(F.lit(1)).alias("n"))
    for lk in _small_first(applied, dimensions):
        key = F.col(f"__key_{lk.column}")
        hot = None
        if not (dimensions.side(lk).small or lk.within or out.isStreaming):
            # the key is known before the joins: no join runs for the keys that hold many rows
            hot = hot_keys(keyed, {f"__key_{lk.column}": "string"}, dimensions.limits)
        out = _with_id(out, lk, dimensions, hot, as_long=lk.target in ints)
        out = out.withColumn(f"__key_{lk.column}", F.when(F.col(lk.target).isNull(), key))
    out = out.select(*[f"`{c}`" for c in kept if c not in labels], *[lk.target for lk in applied], *keys)
    seen = Observation()
    counts = [F.count_if(unmatched(lk)).alias(f"u{i}") for i, lk in enumerate(applied)]
    # counted before `then`, which may rename the ids
    written = materialize(then(out.observe(seen, *counts)), "keyed", conf=COMPILED)
    found = seen.get
    for i, lk in enumerate(applied):
        if found.get(f"u{i}"):
            key = F.col(f"__key_{lk.column}")
            values = written.where(key.isNotNull()).select(key.alias("value")).distinct()
            shown = [r["value"] for r in values.orderBy("value").limit(EXAMPLES).collect()]
            raise ConformError(
                f"{what}{found[f'u{i}']} values of {lk.column!r} are not in {lk.table}.{lk.label}, e.g. {shown}"
            )
    return written.drop(*keys)


def to_ids(
    df: DataFrame,
    lookups: Sequence[Lookup],
    tables: Mapping[str, DataFrame] | Dimensions,
    strict: bool = False,
    what: str = "",
    then: Callable[[DataFrame], DataFrame] = lambda out: out,
    ints: Collection[str] = (),
) -> DataFrame:
    """Replace label columns by id columns; strict fails on ambiguous and on unmatched values.

    `then` is a projection of the result.  Strict writes what it gives once and counts during that write, so that no
    later step looks the labels up again; `then` must let columns pass that it does not know.  `ints` names id
    columns that will be integers: a strict run over written sides may give them as such.
    """
    dimensions = tables if isinstance(tables, Dimensions) else Dimensions(tables)
    if strict:
        return _strict_ids(df, lookups, dimensions, what, then, ints)
    keyed, applied = with_keys(df, lookups, dimensions)
    return then(keyed.drop(*[f"__key_{lk.column}" for lk in applied], *[lk.column for lk in applied]))


def lookups_for(
    columns: Sequence[str], tables: str | Sequence[str], labels: str | Sequence[str], id_column: str = "id"
) -> list[Lookup]:
    """Several lookups with one table and label for all, or one of each per column."""

    def spread(value: str | Sequence[str], what: str) -> list[str]:
        values = [value] if isinstance(value, str) else list(value)
        if len(values) == 1:
            return values * len(columns)
        if len(values) != len(columns):
            raise ValueError(f"{what}: give one, or one for each of {list(columns)}")
        return values

    return [
        Lookup(c, t, label, id_column)
        for c, t, label in zip(columns, spread(tables, "tables"), spread(labels, "labels"))
    ]


def violations(
    keyed: DataFrame, applied: Sequence[Lookup], dimensions: Dimensions, table: str
) -> DataFrame:
    """Unmatched values and ambiguous labels in the shape shared by all rule checks."""
    parts = []
    for lk in applied:
        missing = unmatched_values(keyed, lk)
        parts.append(_shaped(missing, table, "unmatched", lk.column, "value", f"not in {lk.table}.{lk.label}"))
    for lk in {(lk.table, lk.label): lk for lk in applied}.values():
        repeated = dimensions.side(lk).ambiguous
        parts.append(
            _shaped(repeated, lk.table, "ambiguous", lk.label, "__key", "label repeats after normalization")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _shaped(df: DataFrame, table: str, rule: str, column: str, key: str, message: str) -> DataFrame:
    return df.select(
        F.lit(table).alias("table"),
        F.lit(rule).alias("rule"),
        F.lit(column).alias("column"),
        F.col(key).alias("key"),
        F.col("n").cast("string").alias("value"),
        F.lit(message).alias("message"),
    )
