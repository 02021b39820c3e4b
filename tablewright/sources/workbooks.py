"""Many spreadsheet workbooks at once: Spark distributes the files, a task reads one at a time.

Files are fetched by Spark's binary source, so any file system Spark knows works.  Each row
comes out as a map from header to text, which keeps one schema for sheets of any shape.  `workbook_source`
gives the same rows sheet by sheet, without a file in memory.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta
from itertools import islice
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .text_tables import select_tables

# --- fixed values -------------------------------------------------------------------------------
# Cell texts that count as missing.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
DATE_FORMATS = (14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47)  # built-in number formats
EPOCH = datetime(1899, 12, 30)
# ------------------------------------------------------------------------------------------------

SCHEMA = "path string, sheet string, row long, cells map<string,string>"


def _text_of(node) -> str:
    return "".join(t.text or "" for t in node.iter(MAIN + "t"))


def _part(book: zipfile.ZipFile, name: str):
    return ElementTree.fromstring(book.read(name)) if name in book.namelist() else None


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    targets = {r.get("Id"): r.get("Target") for r in _part(book, "xl/_rels/workbook.xml.rels")}
    found = []
    for sheet in _part(book, "xl/workbook.xml").iter(MAIN + "sheet"):
        target = targets[sheet.get(RELATION)]
        found.append((sheet.get("name"), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    return found


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    styles = _part(book, "xl/styles.xml")
    if styles is None:
        return set()
    custom = {
        int(f.get("numFmtId"))
        for f in styles.iter(MAIN + "numFmt")
        if re.search(r"[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", "")), re.IGNORECASE)
    }
    formats = styles.find(MAIN + "cellXfs")
    dates = custom | set(DATE_FORMATS)
    return {i for i, x in enumerate(formats if formats is not None else []) if int(x.get("numFmtId", 0)) in dates}


def _value(cell, shared: list[str], dates: set[int]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        text = _text_of(cell)
    else:
        node = cell.find(MAIN + "v")
        if node is None or node.text is None:
            return None
        text = node.text
        if kind == "s":
            text = shared[int(text)]
        elif kind == "b":
            text = "True" if text == "1" else "False"
        elif kind == "n" and int(cell.get("s", 0)) in dates:
            text = str(EPOCH + timedelta(seconds=round(float(text) * 86400)))
    return None if text in MISSING else text


def _column_index(reference: str) -> int:
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - 64
    return index - 1


def _rows(book: zipfile.ZipFile, part: str, shared: list[str], dates: set[int]) -> Iterator[dict[int, str | None]]:
    """Rows of one sheet, parsed as they stream in."""
    with book.open(part) as stream:
        for _, node in ElementTree.iterparse(stream):
            if node.tag != MAIN + "row":
                continue
            row = {}
            for i, cell in enumerate(node.iter(MAIN + "c")):
                at = _column_index(cell.get("r")) if cell.get("r") else i
                row[at] = _value(cell, shared, dates)
            node.clear()
            yield row


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    """The strings that cells refer to by number, parsed as they stream in."""
    found: list[str] = []
    if "xl/sharedStrings.xml" in book.namelist():
        with book.open("xl/sharedStrings.xml") as stream:
            for _, node in ElementTree.iterparse(stream):
                if node.tag == MAIN + "si":
                    found.append(_text_of(node))
                    node.clear()
    return found


def _column_names(header: dict[int, str | None], width: int, names: list[str]) -> list[str]:
    """Names of the columns up to `width`, going on from those given so far.

    A cell without text makes `Unnamed: i`; a name that was there before gets `.1`, `.2` and so on.
    """
    taken = set(names)
    for i in range(len(names), width):
        base = name = header.get(i) or f"Unnamed: {i}"
        number = 0
        while name in taken:
            number += 1
            name = f"{base}.{number}"
        taken.add(name)
        names.append(name)
    return names


def _sheet_rows(book: zipfile.ZipFile, part: str, shared: list[str], dates: set[int]) -> Iterator[tuple[int, dict]]:
    """(row number, cells by column name) of one sheet; rows 0 name the columns, also those found later."""
    header, names = None, []
    for number, row in enumerate(_rows(book, part, shared, dates)):
        width = max(row, default=-1) + 1
        if header is None:
            header = row
            # row 0 keeps the header, so that sheets without rows keep their columns
            names = _column_names(header, width, names)
            yield 0, dict.fromkeys(names)
            continue
        if width > len(names):  # cells beyond the header are columns too
            names = _column_names(header, width, names)
            yield 0, dict.fromkeys(names)
        yield number, {name: row.get(i) for i, name in enumerate(names)}


def _read_file(path: str, content: bytes, exclude: tuple[str, ...], batch: int) -> Iterator[pd.DataFrame]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = _shared_strings(book)
        dates = _date_styles(book)
        parts = dict(_sheets(book))
        for sheet in select_tables(parts, exclude):
            rows = _sheet_rows(book, parts[sheet], shared, dates)
            while out := [(path, sheet, number, cells) for number, cells in islice(rows, batch)]:
                yield pd.DataFrame(out, columns=["path", "sheet", "row", "cells"])


def parse_workbooks(files: DataFrame, exclude: Iterable[str] = (), batch: int = 10_000) -> DataFrame:
    """(path, sheet, row, cells) of all selected sheets, from a frame of (path, content).

    Rows 0 of a sheet list its columns; data starts at row 1.  A repeated header gets a number (`a`,
    `a.1`), a missing one becomes `Unnamed: i`, also for cells beyond the header.
    """
    unwanted = tuple(exclude)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for file, content in zip(frame["path"], frame["content"]):
                yield from _read_file(file, content, unwanted, batch)

    return files.select("path", "content").mapInPandas(parse, SCHEMA)


def read_workbooks(spark: SparkSession, path: str, exclude: Iterable[str] = ()) -> DataFrame:
    """All selected sheets of all workbooks below a path, as `parse_workbooks` gives them."""
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.xlsx")
    return parse_workbooks(files.load(path), exclude)


def sheet_names(cells: DataFrame) -> list[str]:
    return sorted(r["sheet"] for r in cells.select("sheet").distinct().collect())


def sheet_columns(cells: DataFrame, sheet: str) -> list[str]:
    """Columns of a sheet over all workbooks, in order of name."""
    heads = cells.where((F.col("sheet") == sheet) & (F.col("row") == 0))
    names = heads.select(F.explode(F.map_keys("cells")).alias("name")).distinct()
    return sorted(r["name"] for r in names.collect())


def sheet_table(cells: DataFrame, sheet: str, columns: Iterable[str] | None = None) -> DataFrame:
    """One sheet of all workbooks as a table of text columns, with its row order."""
    names = list(columns) if columns is not None else sheet_columns(cells, sheet)
    rows = cells.where((F.col("sheet") == sheet) & (F.col("row") > 0))
    return rows.select(
        F.struct("path", "row").alias("_ord"), *[F.element_at("cells", c).alias(c) for c in names]
    )


def workbook_tables(cells: DataFrame) -> dict[str, DataFrame]:
    """All sheets as tables.

    The files are parsed once: the rows are written out partitioned by sheet, so that a table reads
    its own sheet only.
    """
    cells = materialize(cells, "sheets", partition_by=("sheet",))
    return {name: sheet_table(cells, name) for name in sheet_names(cells)}
