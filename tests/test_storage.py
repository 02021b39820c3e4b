"""Readers and writers."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import ConformError
from tablewright.plans import model
from tablewright.session import scratch_path
from tablewright.sources import sinks, tables
from tablewright.sources.sinks import Target
from tablewright.sources.text_tables import extract, read_text_table, select_tables
from tablewright.sources.workbooks import read_workbooks, sheet_columns, sheet_table, workbook_tables


def test_text_folder(spark, text_frame, tmp_path):
    root = tmp_path / "data"
    for name in ("CLIENTES", "LOG", "_tmp"):
        text_frame("id nombre", [("001", "a"), ("2", None)]).coalesce(1).write.csv(str(root / name), header=True)
    (root / "single.csv").write_text("id,x\n1,2.50\n")
    found = extract(spark, str(root), exclude=["LOG"])
    assert sorted(found) == ["CLIENTES", "single"]
    assert {c: k for c, k in found["single"].dtypes if c != "_ord"} == {"id": "string", "x": "string"}
    assert "_ord" not in extract(spark, str(root), ordered=False)["single"].columns
    assert found["single"].first()["x"] == "2.50" and found["CLIENTES"].where("id = '001'").count() == 1
    assert select_tables(["a", " _b", "_c", "d"], ["d"]) == ["a"]


def test_row_order_of_text(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id\n" + "\n".join(str(i) for i in range(2000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        df = read_text_table(spark, str(path), ordered=True)
        assert df.rdd.getNumPartitions() > 1
        assert [int(r["id"]) for r in df.orderBy("_ord").collect()] == list(range(2000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_table_reads(spark):
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, v string").createOrReplaceTempView("some_view")
    assert tables.read_table(spark, "some_view", ["id"], "v = :v", {"v": "a"}, limit=5).count() == 2
    assert tables.read_table(spark, "some_view", limit=1).count() == 1
    assert tables.read_scalar(spark, "SELECT max(id) FROM some_view WHERE id < :n", {"n": 3}) == 2
    assert tables.read_scalar(spark, "SELECT id FROM some_view WHERE id > 9") is None
    assert not tables.table_exists(spark, "default", "no_such_table")


def test_align(spark):
    target = Target(
        "t",
        T.StructType([T.StructField("id", T.LongType()), T.StructField("m", T.DecimalType(5, 2)), T.StructField("ok", T.BooleanType()), T.StructField("note", T.StringType())]),
        required=("id",),
        defaults={"ok": True},
    )
    df = spark.createDataFrame([(1.005, "7", "z"), (12345.0, "8", "z")], "` m ` double, id string, extra string")
    got = sorted(tuple(r) for r in sinks.align(df, target).select("id", F.col("m").cast("string"), "ok", "note").collect())
    assert got == [(7, "1.01", True, None), (8, None, True, None)]
    assert [r["key"] for r in sinks.overflows(df.toDF("m", "id", "extra"), target, "id").collect()] == ["8"]
    with pytest.raises(ConformError, match="missing required"):
        sinks.align(df.drop("id"), target)
    with pytest.raises(ConformError, match="not in the target"):
        sinks.align(df, target, drop_extra=False)


def test_load_modes(spark, text_frame):
    areas = {"core": "t_core", "ingest": "t_ingest", "audit": "t_audit"}
    targets = list(model.TARGETS.values())
    where = scratch_path(spark, "test-warehouse")
    frames = {
        "dim_tipos_egreso": text_frame("id tipo extra", [("1", "a", "x"), ("2", "b", "y")]),
        "core.dim_entity_type": text_frame("id code", [("1", "pedido")]),
        "productos": text_frame("id nombre"),
        "unknown": text_frame("id", [("1",)]),
    }
    result = sinks.load(spark, frames, targets, areas, location=where)
    assert result.rows_by_table == {"core.dim_expense_types": 2, "core.dim_entity_type": 1}
    assert (result.tables_loaded, result.rows_loaded) == (2, 3)
    assert not any("dim_type_assets" in w for w in result.warnings) and any("'pedidos'" in w for w in result.warnings)
    loaded = spark.table("t_core.dim_expense_types")
    assert loaded.where("is_active").count() == 2 and dict(loaded.dtypes)["id"] == "bigint"
    assert any("['extra']" in w for w in result.warnings) and result.lost_values == {}
    again = sinks.load(spark, frames, targets, areas, sinks.TRUNCATE, where)
    assert again.rows_loaded == 3 and spark.table("t_core.dim_expense_types").count() == 2
    sinks.append(spark, frames["dim_tipos_egreso"], "t_core", model.TARGETS["dim_expense_types"])
    assert spark.table("t_core.dim_expense_types").count() == 4
    assert sinks.load(spark, frames, targets, areas, ddl_only=True, location=where).tables_loaded == 0
    assert spark.table("t_core.dim_expense_types").count() == 0
    with pytest.raises(ConformError, match="dim_expense_types"):
        sinks.load(spark, {}, targets, areas, location=where)
    with pytest.raises(ConformError, match="does not exist"):
        sinks.append(spark, frames["unknown"], "t_core", Target("nope", T.StructType([])))
    with pytest.raises(ValueError, match="reset mode"):
        sinks.reset(spark, targets, areas, "other")
    for db in areas.values():
        sinks.drop_database(spark, db)


def test_prepare_hook_and_report(spark):
    target = Target("h", T.StructType([T.StructField("id", T.LongType())]), prepare=lambda d: d.where("id > 1"))
    areas = {"core": "t_hook"}
    sinks.reset(spark, [target], areas, location=scratch_path(spark, "test-hook"))
    assert sinks.append(spark, spark.range(5), "t_hook", target).rows == 3
    report = {r["table"]: r["rows"] for r in sinks.count_report({"a": spark.range(3), "b": spark.range(0)}).collect()}
    assert report == {"a": 3, "b": 0, "total": 3}
    sinks.drop_database(spark, "t_hook")


MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
DOC = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _workbook(path, rows_xml, sheets=("CLIENTES", "_skip", "LOG")):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{DOC}"><sheets>' + "".join(
            f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x">' + "".join(
            f'<Relationship Id="r{i}" Target="{"/xl/" if i else ""}worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}"><si><t>id</t></si><si><r><t>nom</t></r><r><t>bre</t></r></si><si><t>fecha</t></si></sst>')
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{MAIN}"><numFmts><numFmt numFmtId="170" formatCode="dd/mm/yyyy"/></numFmts>'
                   '<cellXfs><xf numFmtId="0"/><xf numFmtId="170"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        for i in range(len(sheets)):
            z.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{MAIN}"><sheetData>{rows_xml}</sheetData></worksheet>')
    path.write_bytes(out.getvalue())


def test_workbooks(spark, tmp_path):
    head = '<row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="D1" t="s"><v>2</v></c></row>'
    body = (
        '<row><c r="A2"><v>1</v></c><c r="B2" t="inlineStr"><is><t>Ana</t></is></c><c r="D2" s="1"><v>45356</v></c></row>'
        '<row><c r="A3"><v>2.5</v></c><c r="B3" t="str"><v>N/A</v></c><c r="D3" s="2"><v>45356.5</v></c></row>'
        '<row><c r="A4" t="b"><v>1</v></c></row>'
    )
    _workbook(tmp_path / "a.xlsx", head + body)
    _workbook(tmp_path / "b.xlsx", head, sheets=("CLIENTES",))
    cells = read_workbooks(spark, str(tmp_path), exclude=["LOG"])
    assert sheet_columns(cells, "CLIENTES") == ["Unnamed: 2", "fecha", "id", "nombre"]
    table = sheet_table(cells, "CLIENTES", ["id", "nombre", "fecha"])
    got = [tuple(r)[1:] for r in table.orderBy("_ord").collect()]
    assert got == [("1", "Ana", "2024-03-05 00:00:00"), ("2.5", None, "2024-03-05 12:00:00"), ("True", None, None)]
    assert list(workbook_tables(cells)) == ["CLIENTES"]
    empty = sheet_table(cells.where(F.col("path").endswith("b.xlsx")), "CLIENTES")
    assert empty.columns == ["_ord", "Unnamed: 2", "fecha", "id", "nombre"] and empty.count() == 0
    assert dt.datetime.fromisoformat(got[0][2]) == dt.datetime(2024, 3, 5)


def test_workbook_columns_are_all_kept(spark, tmp_path):
    cell = lambda at, v: f'<c r="{at}" t="str"><v>{v}</v></c>'
    head = "<row>" + cell("A1", "a") + cell("B1", "a") + cell("C1", "b") + "</row>"
    body = "<row>" + "".join(cell(f"{c}2", i) for i, c in enumerate("ABCD", 1)) + "</row>"
    _workbook(tmp_path / "w.xlsx", head + body, sheets=("S",))
    table = sheet_table(read_workbooks(spark, str(tmp_path)), "S")
    assert table.drop("_ord").first().asDict() == {"Unnamed: 3": "4", "a": "1", "a.1": "2", "b": "3"}


def test_values_that_do_not_fit(spark):
    target = Target("f", T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("kg", T.DecimalType(12, 3))]))
    sinks.reset(spark, [target], {"core": "t_fit"}, location=scratch_path(spark, "test-fit"))
    rows = spark.createDataFrame([(1, 3_000_000_000, 1e15), (2, 5, 2.5), (3, None, None), (3_000_000_000, 7, 1.0)], "id long, n long, kg double")
    result = sinks.load(spark, {"f": rows}, [target], {"core": "t_fit"}, location=scratch_path(spark, "test-fit"))
    assert result.lost_values == {"core.f.n": 1, "core.f.kg": 1} and len(result.warnings) == 2
    assert sorted(r["id"] for r in spark.table("t_fit.f").collect()) == [1, 2, 3, 3_000_000_000]
    with pytest.raises(Exception, match="does not fit"):
        sinks.append(spark, rows, "t_fit", target, strict=True)
    sinks.drop_database(spark, "t_fit")
