"""Value-to-id lookups, and whole tables conformed by a plan."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators import lookup
from tablewright.operators.lookup import Dimensions, Lookup
from tablewright.plans.spec import AUDIT, TablePlan, common_clean, conform
from tablewright.sources.text_tables import as_text

from .parsing import DIRTY_AMOUNT, DIRTY_DATE, duck_date, duck_float
from .registry import STAMP, Tables, columns, query, select_list, shifted

# --- shared dirt: labels of nations, regions and suppliers with noise in case and padding ---------
NATION_LABEL = """CASE c_custkey % 4 WHEN 0 THEN ' nation_' || cast(c_nationkey as string)
    WHEN 1 THEN 'Nation_' || cast(c_nationkey as string) || '  ' WHEN 2 THEN NULL
    ELSE 'NATION_' || cast(c_nationkey as string) END"""
CUSTOMER_LABELS = {"c_custkey": "c_custkey", "nation": NATION_LABEL}


@query(
    "lookup_ids",
    f"""SELECT c_custkey, n_nationkey AS nation_id FROM (SELECT {select_list(CUSTOMER_LABELS)} FROM customer)
        LEFT JOIN nation ON lower(trim(nation)) = lower(n_name)""",
)
def lookup_ids(t: Tables) -> DataFrame:
    labels = t("customer").selectExpr(*columns(CUSTOMER_LABELS))
    ask = Lookup("nation", "nation", "n_name", "n_nationkey")
    return lookup.to_ids(labels, [ask], {"nation": t("nation")}, strict=True)


@query(
    "lookup_composite",
    """SELECT c_custkey, c_nationkey, id AS seller_id FROM customer LEFT JOIN (
          SELECT s_nationkey, s_suppkey % 10 AS k, min(s_suppkey) AS id FROM supplier GROUP BY ALL HAVING count(*) = 1)
       ON s_nationkey = c_nationkey AND k = c_custkey % 10""",
)
def lookup_composite(t: Tables) -> DataFrame:
    """Labels that are unique inside a nation only; where even that fails, there is no id."""
    sellers = t("supplier").selectExpr("s_suppkey", "s_nationkey", "'Seller ' || cast(s_suppkey % 10 as string) AS label")
    asked = t("customer").selectExpr("c_custkey", "c_nationkey", "' SELLER ' || cast(c_custkey % 10 as string) AS seller")
    ask = Lookup("seller", "supplier", "label", "s_suppkey", within=(("c_nationkey", "s_nationkey"),))
    return lookup.to_ids(asked, [ask], {"supplier": sellers})


LINE_LABELS = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_partkey": "l_partkey",
    "supplier": """CASE WHEN l_orderkey % 3 = 0 THEN lower(' Supplier#') || lpad(cast(l_suppkey as string), 9, '0')
        ELSE 'Supplier#' || lpad(cast(l_suppkey as string), 9, '0') || ' ' END""",
    "nation": "CASE WHEN l_partkey % 7 <> 0 THEN 'nation_' || cast(l_partkey % 25 as string) END",
    "region": """CASE l_partkey % 5 WHEN 0 THEN 'Africa' WHEN 1 THEN ' america' WHEN 2 THEN 'ASIA '
        WHEN 3 THEN 'europe' ELSE 'Middle East' END""",
}
LINE_LOOKUPS = [
    Lookup("supplier", "supplier", "s_name", "s_suppkey"),
    Lookup("nation", "nation", "n_name", "n_nationkey"),
    Lookup("region", "region", "r_name", "r_regionkey"),
]


@query(
    "lookup_multi",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, s_suppkey AS supplier_id, n_nationkey AS nation_id,
               r_regionkey AS region_id
        FROM (SELECT {select_list(LINE_LABELS)} FROM lineitem)
        LEFT JOIN supplier ON lower(trim(supplier)) = lower(s_name)
        LEFT JOIN nation ON lower(trim(nation)) = lower(n_name)
        LEFT JOIN region ON lower(trim(region)) = lower(r_name)""",
)
def lookup_multi(t: Tables) -> DataFrame:
    labels = t("lineitem").selectExpr(*columns(LINE_LABELS))
    sides = {name: t(name) for name in ("supplier", "nation", "region")}
    return lookup.to_ids(labels, LINE_LOOKUPS, sides)


# every 9th line names a nation that does not exist; supplier labels repeat because of the cut
BROKEN_LABELS = {
    "l_orderkey": "l_orderkey",
    "supplier": "substr('Supplier#' || lpad(cast(l_suppkey as string), 9, '0'), 1, 17)",
    "nation": """CASE WHEN l_partkey % 9 = 0 THEN 'Nation_X' || cast(l_partkey % 40 as string)
        ELSE 'nation_' || cast(l_partkey % 25 as string) END""",
}
_CUT = "substr(s_name, 1, 17)"


def _broken(t: Tables) -> tuple[DataFrame, Dimensions, list[Lookup]]:
    labels = t("lineitem").selectExpr(*columns(BROKEN_LABELS))
    suppliers = t("supplier").selectExpr("s_suppkey AS id", f"{_CUT} AS s_name")
    nations = t("nation").selectExpr("n_nationkey AS id", "n_name")
    dimensions = Dimensions({"supplier": suppliers, "nation": nations})
    return labels, dimensions, [Lookup("supplier", "supplier", "s_name"), Lookup("nation", "nation", "n_name")]


_BROKEN_SQL = f"""WITH lines AS (SELECT {select_list(BROKEN_LABELS)} FROM lineitem),
    cut AS (SELECT lower({_CUT}) AS k, count(*) AS n, min(s_suppkey) AS id FROM supplier GROUP BY 1),
    keyed AS (SELECT lower(trim(supplier)) AS sk, lower(trim(nation)) AS nk,
                     CASE WHEN cut.n = 1 THEN cut.id END AS sid, n_nationkey AS nid
              FROM lines LEFT JOIN cut ON lower(trim(supplier)) = cut.k
              LEFT JOIN nation ON lower(trim(nation)) = lower(n_name))"""


@query(
    "lookup_violations",
    _BROKEN_SQL
    + """
    SELECT 'lineitem' AS "table", 'unmatched' AS rule, 'supplier' AS "column", sk AS key,
           cast(count(*) AS VARCHAR) AS value, 'not in supplier.s_name' AS message
    FROM keyed WHERE sk IS NOT NULL AND sid IS NULL GROUP BY sk
    UNION ALL
    SELECT 'lineitem', 'unmatched', 'nation', nk, cast(count(*) AS VARCHAR), 'not in nation.n_name'
    FROM keyed WHERE nk IS NOT NULL AND nid IS NULL GROUP BY nk
    UNION ALL
    SELECT 'supplier', 'ambiguous', 's_name', k, cast(n AS VARCHAR), 'label repeats after normalization'
    FROM cut WHERE n > 1""",
)
def lookup_violations(t: Tables) -> DataFrame:
    labels, dimensions, asked = _broken(t)
    keyed, applied = lookup.with_keys(labels, asked, dimensions)
    return lookup.violations(keyed, applied, dimensions, "lineitem")


@query(
    "lookup_counts",
    _BROKEN_SQL
    + """
    SELECT 'supplier' AS "column", 'supplier.s_name' AS lookup, count(sid) AS matched,
           count(*) FILTER (sk IS NOT NULL AND sid IS NULL) AS unmatched FROM keyed
    UNION ALL
    SELECT 'nation', 'nation.n_name', count(nid), count(*) FILTER (nk IS NOT NULL AND nid IS NULL) FROM keyed""",
)
def lookup_counts(t: Tables) -> DataFrame:
    labels, dimensions, asked = _broken(t)
    keyed, applied = lookup.with_keys(labels, asked, dimensions)
    return lookup.lookup_report(keyed, applied)


# --- whole tables through a plan -------------------------------------------------------------------
NOW = datetime.datetime(2024, 1, 2, 3, 4, 5)
ORDER_SHEET = {
    "ID": "cast(o_orderkey as string) || CASE WHEN o_orderkey % 4 = 0 THEN '.0' ELSE '' END",
    "`Cliente`": """CASE WHEN o_orderkey % 3 = 0 THEN lower('  Customer#') ELSE 'Customer#' END
        || lpad(cast(o_custkey as string), 9, '0')""",
    "`Estado`": """CASE o_orderstatus WHEN 'F' THEN ' final' WHEN 'O' THEN 'Open ' WHEN 'P' THEN 'PENDING'
        ELSE 'n/a' END""",
    "`Fecha Pedido`": DIRTY_DATE["raw"],
    "`Activo`": "CASE o_orderkey % 3 WHEN 0 THEN 'si' WHEN 1 THEN 'NO' ELSE ' ' END",
}
LINE_SHEET = {
    "`Pedido`": "cast(l_orderkey as string)",
    "`Linea`": "cast(l_linenumber as string)",
    "`Proveedor`": LINE_LABELS["supplier"],
    "`Monto`": DIRTY_AMOUNT["raw"],
}
STATES = "(1, 'Final'), (2, 'Open'), (3, 'Pending')"
ORDER_PLAN = TablePlan(
    lookups=(Lookup("cliente", "clientes", "c_name", "c_custkey"), Lookup("estado", "estados", "estado")),
    ints=("id", "cliente_id", "estado_id"),
    bools=("is_active",),
    dates=("fecha",),
    rename_before={"fecha_pedido": "fecha"},
    stamps=AUDIT,
)
LINE_PLAN = TablePlan(
    lookups=(Lookup("proveedor", "proveedores", "s_name", "s_suppkey"),),
    ints=("pedido", "linea", "proveedor_id"),
    floats=("monto",),
    rename_after={},
)


def _duck_sheet(exprs: dict[str, str], table: str) -> str:
    chosen = ", ".join(f"{e} AS {n.strip('`').lower().replace(' ', '_')}" for n, e in exprs.items())
    return f"SELECT {chosen} FROM {table}"


def _conformed(t: Tables) -> tuple[DataFrame, DataFrame]:
    orders = common_clean(t("orders").selectExpr(*columns(ORDER_SHEET)))
    lines = common_clean(t("lineitem").selectExpr(*columns(LINE_SHEET)))
    tables = {
        "clientes": common_clean(as_text(t("customer"))),
        "proveedores": common_clean(as_text(t("supplier"))),
        "estados": t.spark.sql(f"SELECT cast(id AS string) AS id, estado FROM VALUES {STATES} AS s(id, estado)"),
    }
    dimensions = Dimensions(tables)
    return (
        conform(orders, ORDER_PLAN, tables, NOW, dimensions=dimensions),
        conform(lines, LINE_PLAN, tables, NOW, dimensions=dimensions),
    )


_CONFORMED_SQL = f"""WITH orders_sheet AS ({_duck_sheet(ORDER_SHEET, 'orders')}),
    lines_sheet AS ({_duck_sheet(LINE_SHEET, 'lineitem')}),
    estados AS (SELECT * FROM (VALUES {STATES}) AS s(id, label)),
    pedidos AS (SELECT TRY_CAST(TRY_CAST(orders_sheet.id AS DOUBLE) AS BIGINT) AS id, c_custkey AS cliente_id,
                estados.id AS estado_id, {shifted(duck_date('fecha_pedido'))} AS fecha,
                CASE activo WHEN 'si' THEN true WHEN 'NO' THEN false END AS is_active
                FROM orders_sheet LEFT JOIN customer ON lower(trim(cliente)) = lower(c_name)
                LEFT JOIN estados ON lower(trim(estado)) = lower(label)),
    lineas AS (SELECT CAST(pedido AS BIGINT) AS pedido, s_suppkey AS proveedor_id, {duck_float('monto')} AS monto
               FROM lines_sheet LEFT JOIN supplier ON lower(trim(proveedor)) = lower(s_name))"""


@query(
    "conform_orders",
    _CONFORMED_SQL
    + """
    SELECT id, cliente_id, estado_id, fecha, is_active, '2024-01-02 03:04:05' AS created_at,
           CAST(NULL AS VARCHAR) AS deleted_at, CAST(NULL AS BIGINT) AS ingest_event_id,
           coalesce(n, 0) AS n_lines, CAST(total AS DOUBLE) AS total, suppliers
    FROM pedidos LEFT JOIN (SELECT pedido, count(*) AS n, sum(CAST(monto AS DECIMAL(18,4))) AS total, count(DISTINCT proveedor_id) AS suppliers
                            FROM lineas GROUP BY pedido) ON id = pedido""",
)
def conform_orders(t: Tables) -> DataFrame:
    orders, lines = _conformed(t)
    per_order = lines.groupBy("pedido").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("monto").cast("decimal(18,4)")).alias("total"),
        F.count_distinct("proveedor_id").alias("suppliers"),
    )
    joined = orders.join(per_order, F.col("id") == F.col("pedido"), "left")
    return joined.select(
        "id",
        "cliente_id",
        "estado_id",
        F.date_format("fecha", STAMP).alias("fecha"),
        "is_active",
        F.date_format("created_at", STAMP).alias("created_at"),
        F.date_format("deleted_at", STAMP).alias("deleted_at"),
        "ingest_event_id",
        F.coalesce("n", F.lit(0)).alias("n_lines"),
        F.col("total").cast("double").alias("total"),
        "suppliers",
    )


@query(
    "revenue_by_segment",
    f"""SELECT c_mktsegment AS segment, CAST(sum(CAST(monto AS DECIMAL(18,4))) AS DOUBLE) AS revenue, count(*) AS n_lines
        FROM (SELECT l_orderkey, {duck_float('raw')} AS monto
              FROM (SELECT {select_list(DIRTY_AMOUNT)} FROM lineitem)) AS l
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        GROUP BY c_mktsegment""",
)
def revenue_by_segment(t: Tables) -> DataFrame:
    """All-text lines and orders, cleaned, parsed, looked up and aggregated."""
    lines = t("lineitem").selectExpr(*columns(DIRTY_AMOUNT), "cast(l_orderkey as string) AS pedido")
    lines = conform(common_clean(lines).drop("l_orderkey"), TablePlan(ints=("pedido",), floats=("raw",)), {})
    label = "'CUSTOMER#' || lpad(cast(o_custkey as string), 9, '0') || ' '"
    orders = common_clean(t("orders").selectExpr("cast(o_orderkey as string) AS id", f"{label} AS cliente"))
    plan = TablePlan(lookups=(Lookup("cliente", "clientes", "c_name", "c_mktsegment"),), ints=("id",))
    orders = conform(orders, plan, {"clientes": t("customer")})
    return (
        lines.join(orders, F.col("pedido") == F.col("id"))
        .groupBy(F.col("cliente_id").alias("segment"))
        .agg(F.sum(F.col("raw").cast("decimal(18,4)")).cast("double").alias("revenue"), F.count(F.lit(1)).alias("n_lines"))
    )
