"""Workbooks as a data source: `spark.read.format("workbooks").load(folder)`.

One task reads one sheet of one file.  Planning opens each file for its directory and list of sheets only; a
task seeks to its sheet and yields rows as they are parsed, so neither a file nor a sheet is held in memory
(the strings that cells share are, as the format asks).  Rows are those of `workbooks.parse_workbooks`.

The path is a file or a folder (searched as a whole for `*.xlsx`) that driver and tasks can open: a mounted one,
or a URI of a file system that pyarrow knows.  Options: `exclude`, comma-separated sheets to leave out.  A folder without
workbooks gives no rows; one that is not there, and a file that is no workbook, are errors.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import ship
from . import workbooks
from .text_tables import select_tables

BATCH = 5_000  # rows of a batch
PLANNERS = 16  # files looked at together


class Sheet(NamedTuple):
    path: str
    name: str
    part: str  # of the archive


class SheetPartition(InputPartition):
    def __init__(self, sheet: Sheet) -> None:
        super().__init__(tuple(sheet))


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def files_below(path: str) -> list[str]:
    """Workbooks below a path, in order of name."""
    system, inner = file_system(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [inner]
    below = system.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted(f.path for f in below if f.type == fs.FileType.File and f.path.endswith(".xlsx"))


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        self.exclude = tuple(x.strip() for x in options.get("exclude", "").split(",") if x.strip())

    def sheets(self, file: str) -> list[Sheet]:
        system, _ = file_system(self.path)
        with system.open_input_file(file) as stream, zipfile.ZipFile(stream) as book:
            parts = dict(workbooks._sheets(book))
        return [Sheet(file, name, parts[name]) for name in select_tables(parts, self.exclude)]

    def partitions(self) -> list[SheetPartition]:
        with ThreadPoolExecutor(PLANNERS) as pool:
            found = [sheet for sheets in pool.map(self.sheets, files_below(self.path)) for sheet in sheets]
        return [SheetPartition(sheet) for sheet in found]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition is None or partition.value is None:  # Spark plans one task where there is nothing to read
            return
        sheet = Sheet(*partition.value)
        system, _ = file_system(self.path)
        kind = pa.schema([("path", pa.string()), ("sheet", pa.string()), ("row", pa.int64()), ("cells", pa.map_(pa.string(), pa.string()))])
        with system.open_input_file(sheet.path) as stream, zipfile.ZipFile(stream) as book:
            rows = workbooks._sheet_rows(book, sheet.part, workbooks._shared_strings(book), workbooks._date_styles(book))
            while part := list(islice(rows, BATCH)):
                columns = [[sheet.path] * len(part), [sheet.name] * len(part), [n for n, _ in part], [list(c.items()) for _, c in part]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], schema=kind)


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbooks"

    def schema(self) -> str:
        return workbooks.SCHEMA

    def reader(self, schema) -> WorkbookReader:
        return WorkbookReader(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and the package to its workers."""
    ship(spark)
    spark.dataSource.register(WorkbookSource)


def read_sheets(spark: SparkSession, path: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """`path, sheet, row, cells` of all selected sheets below a path, one task a sheet."""
    register(spark)
    return spark.read.format("workbooks").option("exclude", ",".join(exclude)).load(path)
