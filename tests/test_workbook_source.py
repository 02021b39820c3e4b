"""Workbooks through the data source: one task a sheet, the rows of the parser."""

import pytest

from tablewright.sources.workbook_source import WorkbookReader, read_sheets
from tablewright.sources.workbooks import read_workbooks, sheet_table
from workload.storage import workbook_bytes


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("books")
    (at / "deep").mkdir()
    many = [["id", "n", "n", None], *[[str(i), f"v{i}", "N/A", f"w{i}"] for i in range(12_000)]]
    books = {
        "a.xlsx": {"ONE": many, "TWO": [["x"]], "LOG": [["id"], ["1"]], "_hidden": [["y"], ["2"]]},
        "deep/b.xlsx": {"ONE": [["id", "n"], ["7", "é"], ["8", None, "beyond"]], "EMPTY": []},
    }
    for name, sheets in books.items():
        (at / name).write_bytes(workbook_bytes(sheets))
    (at / "notes.txt").write_text("no workbook")
    return str(at)


def test_rows_are_those_of_the_parser(spark, folder):
    def rows(df):
        return sorted((r.path.rsplit("/", 1)[1], r.sheet, r.row, sorted((r.cells or {}).items(), key=str)) for r in df.collect())

    found = read_sheets(spark, folder, exclude=("LOG",))
    assert rows(found) == rows(read_workbooks(spark, folder, exclude=["LOG"])) and found.count() > 12_000
    assert sheet_table(found, "ONE", ["id", "Unnamed: 2"]).where("id = 8").count() == 2
    assert rows(read_sheets(spark, f"file:{folder}/deep/b.xlsx")) == [r for r in rows(found) if r[0] == "b.xlsx"]


def test_a_task_for_every_sheet(spark, folder):
    planned = WorkbookReader({"path": folder, "exclude": "LOG"}).partitions()
    assert [p.value[1] for p in planned] == ["ONE", "TWO", "ONE", "EMPTY"]
    assert read_sheets(spark, folder, exclude=("LOG",)).rdd.getNumPartitions() == 4


def test_no_workbooks(spark, tmp_path):
    assert read_sheets(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="absent"):
        read_sheets(spark, str(tmp_path / "absent")).count()
