"""A load that happens whole or not at all, and the identity marks it leaves behind.

Tables of a database are external tables over versioned folders: `<root>/<database>/<table>/<version>`.  A
load writes every table to a folder of its new version, validates what it wrote, and only then switches
the tables to the new folders, which moves no data.  A load that fails at any step before leaves tables and
files as they were; the switch itself is a few catalog calls, and if one fails those already made are undone.
Readers that have planned a query keep reading the old folders, which `forget` removes later.

With every load the largest id of each table is taken from the write itself, and kept as a table of marks
(`next_ids`), so that appends need no scan.  Blocks of ids are reserved by a file that only one writer can create.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lookup import ConformError
from ..operators.project import nan_to_null
from .sinks import LoadResult, Target, align, create_database, database, fitting, route

Validate = Callable[[Mapping[str, DataFrame]], DataFrame]


@dataclass(frozen=True)
class Staged:
    """One table of a load before it is visible."""

    target: Target
    path: str
    rows: int
    top: int | None  # largest id written
    lost: dict[str, int]


def stage(spark: SparkSession, frames: Sequence[DataFrame], target: Target, path: str, id_column: str | None, drop_extra: bool, strict: bool) -> Staged:
    """Write frames in the target's shape to a new folder; counts, losses and the largest id come from the write."""
    rows, top, lost = 0, None, {}
    kind = {f.name: f.dataType for f in target.schema.fields}
    numbered = id_column is not None and isinstance(kind.get(id_column), T.IntegralType)
    if not frames:
        frames = [spark.createDataFrame([], target.schema)]
    for df in frames:
        seen = Observation()
        ready = nan_to_null(target.prepare(df) if target.prepare else df)
        ready = ready.toDF(*[c.strip() for c in ready.columns])
        align(ready, target, drop_extra)  # fails on missing and on extra columns before anything is read
        marked = fitting(ready, target, strict)
        marks = [c for c in marked.columns if c.startswith("__lost_")]
        measures = [F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c)).alias(c) for c in marks]]
        if numbered and id_column in ready.columns:
            measures.append(F.max(F.col(id_column).try_cast(kind[id_column])).cast("long").alias("__top"))
        align(marked.observe(seen, *measures).drop(*marks), target).write.mode("append").parquet(path)
        found = seen.get
        rows += found["n"]
        top = max((v for v in (top, found.get("__top")) if v is not None), default=None)
        for c in marks:
            if found[c]:
                name = c.removeprefix("__lost_")
                lost[name] = lost.get(name, 0) + found[c]
    return Staged(target, path, rows, top, lost)


@dataclass(frozen=True)
class StagedResult(LoadResult):
    """What a load did, with the next free id of every table that has one."""

    next_ids: Mapping[str, int] = None
    version: str = ""


def load_whole(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    targets: Sequence[Target],
    areas: Mapping[str, str],
    root: str,
    ids: Mapping[str, str] | None = None,
    validate: Validate | None = None,
    drop_extra: bool = True,
    strict: bool = False,
) -> StagedResult:
    """Replace all tables of the targets by the frames, or raise and leave everything as it was.

    `ids` names the id column of a table (default `id`).  `validate` gets the staged tables by name and
    returns violations; any of them fails the load.
    """
    absent = [t for t in targets if t.load and t.frame not in frames]
    fatal = [t.name for t in absent if t.must_load]
    if fatal:
        raise ConformError(f"no frame for {fatal}, which other tables depend on")
    warnings = [f"no frame {t.frame!r} for table {t.name!r}" for t in absent]
    jobs: dict[str, list[DataFrame]] = {t.name: [frames[t.frame]] if t.frame in frames else [] for t in targets}
    taken = {t.frame for t in targets}
    for name, df in frames.items():
        target = None if name in taken else route(name, targets)
        if target is not None:
            jobs[target.name].append(df)
    version = uuid.uuid4().hex
    staged: list[Staged] = []
    try:
        for t in targets:
            path = f"{root.rstrip('/')}/{database(areas, t)}/{t.name}/{version}"
            staged.append(stage(spark, jobs[t.name], t, path, (ids or {}).get(t.name, "id"), drop_extra, strict))
        if validate is not None:
            from ..operators.quality import fail_on

            fail_on(validate({s.target.name: _read(spark, s) for s in staged}), "load refused: ")
        _switch(spark, staged, areas, root)
    except BaseException:
        for t in targets:  # nothing of a failed load is left, the unfinished table included
            _delete(spark, f"{root.rstrip('/')}/{database(areas, t)}/{t.name}/{version}")
        raise
    by_table = {f"{s.target.area}.{s.target.name}": s for s in staged}
    rows = {k: s.rows for k, s in by_table.items() if s.rows}
    lost = {f"{k}.{c}": n for k, s in by_table.items() for c, n in s.lost.items()}
    warnings += [f"{c}: {n} values do not fit and became NULL" for c, n in lost.items()]
    marks = {k: (s.top or 0) + 1 for k, s in by_table.items() if (ids or {}).get(s.target.name, "id") in s.target.schema.names}
    return StagedResult(len(rows), sum(rows.values()), rows, warnings, lost, marks, version)


def _read(spark: SparkSession, s: Staged) -> DataFrame:
    return spark.read.schema(s.target.schema).parquet(s.path)


def _location(spark: SparkSession, table: str) -> str | None:
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def _switch(spark: SparkSession, staged: Sequence[Staged], areas: Mapping[str, str], root: str) -> None:
    """Point all tables at their new folders; undo what was done if one cannot be switched."""
    for db in dict.fromkeys(database(areas, s.target) for s in staged):
        create_database(spark, db, root)
    names = [f"`{database(areas, s.target)}`.`{s.target.name}`" for s in staged]
    before = [_location(spark, n) for n in names]
    done: list[int] = []
    try:
        for i, s in enumerate(staged):
            done.append(i)
            _point(spark, names[i], s.target, s.path, before[i] is not None)
    except BaseException:
        for i in done:
            if before[i] is None:
                spark.sql(f"DROP TABLE IF EXISTS {names[i]}")
            else:
                spark.sql(f"ALTER TABLE {names[i]} SET LOCATION '{before[i]}'")
                spark.catalog.refreshTable(names[i])
        raise


def _point(spark: SparkSession, name: str, target: Target, path: str, exists: bool) -> None:
    if exists:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in target.schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}'")


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    where, files = _files(spark, path)
    files.delete(where, True)


def forget(spark: SparkSession, targets: Sequence[Target], areas: Mapping[str, str], root: str) -> int:
    """Delete the folders of versions that no table points at; returns how many."""
    removed = 0
    for t in targets:
        current = (_location(spark, f"`{database(areas, t)}`.`{t.name}`") or "").rstrip("/").rsplit("/", 1)[-1]
        where, files = _files(spark, f"{root.rstrip('/')}/{database(areas, t)}/{t.name}")
        for found in files.listStatus(where) if files.exists(where) else []:
            if found.getPath().getName() != current:
                files.delete(found.getPath(), True)
                removed += 1
    return removed


# --- identity marks ---------------------------------------------------------------------------------


def save_marks(spark: SparkSession, root: str, marks: Mapping[str, int]) -> None:
    """Keep the next free ids of tables; a reserved block starts no earlier."""
    for table, first in marks.items():
        _mark(spark, root, table, first)


def _marks(spark: SparkSession, root: str, table: str) -> list[int]:
    where, files = _files(spark, f"{root.rstrip('/')}/_marks/{table}")
    names = [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []
    return sorted(int(n) for n in names if n.isdigit())


def _mark(spark: SparkSession, root: str, table: str, first: int) -> bool:
    """Create the mark `first`; False if another writer already has it."""
    where, files = _files(spark, f"{root.rstrip('/')}/_marks/{table}/{first}")
    try:
        files.create(where, False).close()
    except Exception as error:  # the file system refuses to create what exists
        if files.exists(where):
            return False
        raise error
    return True


def next_id(spark: SparkSession, root: str, table: str) -> int:
    """The first id that no load and no reserved block has used."""
    return max(_marks(spark, root, table), default=1)


def reserve(spark: SparkSession, root: str, table: str, count: int) -> int:
    """Reserve a block of `count` ids; returns the first one.  Two writers never get the same block.

    A mark is an empty file named by the next free id, and a file can be created once.  A writer creates the
    mark behind its block and owns the block if no other mark lies above its first id by then; of two
    writers at the same place the later one sees the other's mark.  Otherwise it tries again behind all
    marks, so ids may be skipped, also by a writer that dies, but none is given twice and no one waits.
    """
    if count < 1:
        raise ValueError("reserve at least one id")
    while True:
        first = next_id(spark, root, table)
        if _mark(spark, root, table, first + count) and _marks(spark, root, table)[-1] == first + count:
            if not [m for m in _marks(spark, root, table) if first < m < first + count]:
                return first
