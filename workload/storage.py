"""Sources and sinks: text folders, workbooks, databases with reset modes."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.names import rename_tables
from tablewright.operators.project import union_aligned
from tablewright.session import scratch_path
from tablewright.sources import sinks
from tablewright.sources.sinks import Target
from tablewright.sources.text_tables import extract, extract_tables
from tablewright.sources.workbook_source import file_system, read_sheets, register
from tablewright.sources.workbooks import parse_workbooks, sheet_table

from .registry import Tables, query

_CSV = {
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"),
    "documents": ("doc_id", "text", "lang", "source"),
}


def _hashed(columns: tuple[str, ...]) -> str:
    return " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)


@query("string_source", " UNION ALL ".join(f"""SELECT '{n}' AS "table", md5({_hashed(c)}) AS row_hash FROM {n}""" for n, c in _CSV.items()))
def string_source(t: Tables) -> DataFrame:
    """Tables written as delimited text and extracted again, without the hidden and excluded ones; whole rows."""
    folder = scratch_path(t.spark, "text")
    for name, columns in {**_CSV, "region": ("r_regionkey", "r_name")}.items():
        t(name).select([F.col(c).cast("string") for c in columns]).write.csv(f"{folder}/{name}", header=True, escape='"')
    found = extract(t.spark, folder, exclude=["region"], multiLine="true", escape='"')
    return union_aligned(
        [
            df.select(
                F.lit(name).alias("table"),
                F.md5(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in _CSV[name]])).alias("row_hash"),
            )
            for name, df in found.items()
        ]
    )


@query(
    "typed_as_text",
    """SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_nationkey AS VARCHAR) AS parent FROM supplier
       UNION ALL SELECT CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR) FROM nation""",
)
def typed_as_text(t: Tables) -> DataFrame:
    given = {" _hidden": t("region"), "supplier": t("supplier").drop("s_acctbal"), "nation": t("nation"), "log": t("region")}
    found = extract_tables(given, exclude=["log"])
    return union_aligned([found[n].toDF("id", "name", "parent") for n in ("supplier", "nation")])


CUSTOMERS = Target(
    "customers",
    T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("nombre", T.StringType()), T.StructField("is_active", T.BooleanType())]
    ),
    source="clientes",
    defaults={"is_active": True},
)
ORDERS = Target(
    "orders", T.StructType([T.StructField("id", T.LongType()), T.StructField("total", T.DecimalType(14, 2))]), source="pedidos"
)
EVENTS = Target(
    "ingest_events", T.StructType([T.StructField("id", T.LongType()), T.StructField("status", T.StringType())]), area="ingest"
)


@query(
    "reset_and_append",
    """SELECT 'core.customers' AS "table", 2 * count(*) AS rows, CAST(2 * sum(c_custkey) AS BIGINT) AS ids FROM customer
       UNION ALL SELECT 'core.orders', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders
       UNION ALL SELECT 'ingest.ingest_events', count(*), CAST(sum(event_id) AS BIGINT) FROM events""",
)
def reset_and_append(t: Tables) -> DataFrame:
    """drop_create and load, truncate and load, append once more; then what the tables hold."""
    spark = t.spark
    tag = uuid.uuid4().hex[:12]
    areas = {"core": f"tablewright_core_{tag}", "ingest": f"tablewright_ingest_{tag}"}
    targets = [CUSTOMERS, ORDERS, EVENTS]
    location = scratch_path(spark, "warehouse")
    frames = rename_tables(
        {
            "CLIENTES": t("customer").selectExpr("c_custkey AS id", "c_name AS nombre", "c_acctbal AS extra"),
            "PEDIDOS": t("orders").selectExpr("o_orderkey AS id", "o_totalprice AS total"),
        }
    )
    # a frame that only its own name connects to a target
    frames["ingest_events"] = t("events").selectExpr("event_id AS id", "event_type AS status")
    sinks.load(spark, frames, targets, areas, sinks.DROP_CREATE, location)
    sinks.load(spark, frames, targets, areas, sinks.TRUNCATE, location)
    sinks.append(spark, frames["clientes"], areas["core"], CUSTOMERS)
    return union_aligned(
        [
            spark.table(f"`{areas[x.area]}`.`{x.name}`")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("id").alias("ids"))
            .select(F.lit(f"{x.area}.{x.name}").alias("table"), "rows", "ids")
            for x in targets
        ]
    )


_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_DOC = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def workbook_bytes(sheets: dict[str, list[list[str | None]]]) -> bytes:
    """A minimal workbook with text cells, as a spreadsheet program would save it."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        listed, linked = [], []
        for i, (name, rows) in enumerate(sheets.items(), 1):
            listed.append(f'<sheet name="{escape(name)}" sheetId="{i}" r:id="rId{i}"/>')
            linked.append(f'<Relationship Id="rId{i}" Type="{_DOC}/worksheet" Target="worksheets/sheet{i}.xml"/>')
            body = "".join(
                "<row>" + "".join("<c/>" if v is None else f'<c t="inlineStr"><is><t>{escape(v)}</t></is></c>' for v in row) + "</row>"
                for row in rows
            )
            book.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{_MAIN}"><sheetData>{body}</sheetData></worksheet>')
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_DOC}"><sheets>{"".join(listed)}</sheets></workbook>')
        relations = "http://schemas.openxmlformats.org/package/2006/relationships"
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{relations}">{"".join(linked)}</Relationships>')
    return out.getvalue()


def _to_workbooks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One workbook per batch of rows (Arrow batches are of bounded size)."""
    for number, frame in enumerate(batches):
        rows = frame.astype(object).where(frame.notna(), None).values.tolist()
        # a repeated header, a missing one, and a last cell beyond the header
        sheet = [["id", "nombre", "nombre", None], *[[r[0], r[1], f"n{r[0]}", "-", f"x{r[0]}"] for r in rows]]
        content = workbook_bytes({"PROVEEDORES": sheet, "_notas": [["x"]], "LOG": [["id"], ["1"]]})
        yield pd.DataFrame({"path": [f"{number}-{rows[0][0] if rows else 'none'}.xlsx"], "content": [content]})


@query(
    "workbooks",
    """SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_suppkey % 5 <> 0 THEN s_name END AS nombre,
              'n' || s_suppkey AS second_name, '-' AS unnamed, 'x' || s_suppkey AS beyond FROM supplier""",
)
def workbooks(t: Tables) -> DataFrame:
    """Suppliers packed into workbook files and read back; missing-value words come back as NULL."""
    rows = t("supplier").selectExpr(
        "cast(s_suppkey as string) AS id", "CASE s_suppkey % 10 WHEN 0 THEN 'N/A' WHEN 5 THEN NULL ELSE s_name END AS nombre"
    )
    files = rows.mapInPandas(_to_workbooks, "path string, content binary")
    cells = parse_workbooks(files, exclude=["LOG"])
    table = sheet_table(cells, "PROVEEDORES", ["id", "nombre", "nombre.1", "Unnamed: 3", "Unnamed: 4"])
    return table.toDF("_ord", "id", "nombre", "second_name", "unnamed", "beyond").drop("_ord")


def _write_workbooks(folder: str):
    """Workbooks of the rows of a task, as files of a shared folder; a repeated task writes the same names again."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, inner = file_system(folder)
        task = TaskContext.get().partitionId()
        for number, frame in enumerate(batches):
            rows = [[str(k), name] for k, name in frame.itertuples(index=False)]
            sheets = {"CLIENTES": [["id", "nombre"], *rows], "CLAVES": [["id"], *[r[:1] for r in rows]], "LOG": [["id"], ["1"]]}
            name = f"{inner}/{task}-{number}.xlsx"
            with system.open_output_stream(name) as out:
                out.write(workbook_bytes(sheets))
            yield pd.DataFrame({"file": [name]})

    return write


@query(
    "workbook_files",
    """SELECT 'CLIENTES' AS sheet, CAST(c_custkey AS VARCHAR) AS id, c_name AS nombre FROM customer
       UNION ALL SELECT 'CLAVES', CAST(c_custkey AS VARCHAR), NULL FROM customer""",
)
def workbook_files(t: Tables) -> DataFrame:
    """Customers written as workbook files by the tasks, and read through the data source, one task a sheet."""
    folder = scratch_path(t.spark, "workbooks")
    register(t.spark)
    system, inner = file_system(folder)
    system.create_dir(inner, recursive=True)
    t("customer").select("c_custkey", "c_name").mapInPandas(_write_workbooks(folder), "file string").count()
    cells = read_sheets(t.spark, folder, exclude=("LOG",)).where("row > 0")
    return cells.select("sheet", F.element_at("cells", "id").alias("id"), F.try_element_at("cells", F.lit("nombre")).alias("nombre"))
