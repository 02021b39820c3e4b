"""Projections, profiles and table-level operators."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.operators import project
from tablewright.operators.assets import split_assets
from tablewright.sources.sinks import Target, align, count_report, overflows
from tablewright.sources.tables import read_scalar, read_sql, read_table, table_exists

from .registry import STAMP, Tables, query, shifted

LINE_TARGET = Target(
    "line_items",
    T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("kg", T.DecimalType(12, 3)),
            T.StructField("precio_total", T.DecimalType(14, 2)),
            T.StructField("tasa", T.DecimalType(14, 6)),
            T.StructField("fecha", T.DateType()),
            T.StructField("linea", T.IntegerType()),
            T.StructField("is_active", T.BooleanType()),
            T.StructField("observaciones", T.StringType()),
        ]
    ),
    required=("id",),
    defaults={"is_active": True},
)


@query(
    "rename_align",
    """SELECT l_orderkey AS id, CASE WHEN l_partkey % 7 <> 0 THEN CAST(CAST(l_quantity AS DECIMAL(12,3)) AS VARCHAR) END AS kg,
              CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR) AS precio_total,
              CAST(CAST(l_tax AS DECIMAL(14,6)) AS VARCHAR) AS tasa, strftime(l_shipdate, '%Y-%m-%d') AS fecha,
              CASE WHEN l_partkey % 5 <> 0 THEN l_linenumber END AS linea, true AS is_active,
              CAST(NULL AS VARCHAR) AS observaciones FROM lineitem""",
)
def rename_align(t: Tables) -> DataFrame:
    lines = t("lineitem").select(
        "l_orderkey",
        F.expr("CASE WHEN l_partkey % 7 = 0 THEN double('NaN') ELSE l_quantity END").alias("l_quantity"),
        F.col("l_tax").alias(" tasa "),
        "l_extendedprice",
        "l_shipdate",
        # text that is no number does not fit the target's type
        F.expr("CASE WHEN l_partkey % 5 <> 0 THEN cast(l_linenumber as string) ELSE 'x' END").alias("linea"),
        F.lit("unused").alias("extra"),
    )
    names = {"l_orderkey": "id", "l_quantity": "kg", "l_extendedprice": "precio_total", "l_shipdate": "fecha", "absent": "x"}
    aligned = align(project.nan_to_null(project.rename(lines, names)), LINE_TARGET)
    return aligned.withColumns({c: F.col(c).cast("string") for c in ("kg", "precio_total", "tasa", "fecha")})


@query(
    "sink_overflow",
    """SELECT 'line_items' AS "table", 'fits_linea' AS rule, 'linea' AS "column", CAST(l_orderkey AS VARCHAR) AS key,
              CAST(3000000000 + l_linenumber AS VARCHAR) AS value FROM lineitem WHERE l_partkey % 5 = 0
       UNION ALL
       SELECT 'line_items', 'fits_kg', 'kg', CAST(l_orderkey AS VARCHAR), CAST(1000000000000000 + l_linenumber AS VARCHAR)
       FROM lineitem WHERE l_partkey % 7 = 0""",
)
def sink_overflow(t: Tables) -> DataFrame:
    """Values too large for their target column: ids above 2**31 in an int, amounts beyond the decimal."""
    lines = t("lineitem").selectExpr(
        "l_orderkey AS id",
        "CASE WHEN l_partkey % 5 = 0 THEN 3000000000 + l_linenumber ELSE l_linenumber END AS linea",
        "CASE WHEN l_partkey % 7 = 0 THEN 1000000000000000 + l_linenumber ELSE cast(l_quantity AS bigint) END AS kg",
    )
    return overflows(lines, LINE_TARGET, "id").drop("message")


@query("drop_empty", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def drop_empty(t: Tables) -> DataFrame:
    padded = t("supplier").select(
        "s_suppkey",
        F.lit(None).cast("string").alias("nothing"),
        "s_name",
        F.expr("CASE WHEN s_suppkey % 2 = 0 THEN '  ' END").alias("blanks"),
        F.col("s_name").alias("Unnamed: 3"),
        "s_acctbal",
        F.lit(None).cast("long").alias("none"),
    )
    return project.drop_empty_columns(padded)


FIXED = datetime.datetime(2024, 1, 2, 3, 4, 5)


@query(
    "audit_columns",
    f"""SELECT o_orderkey, '2024-01-02 03:04:05' AS created_at, {shifted('o_orderdate')} AS updated_at,
              CAST(NULL AS VARCHAR) AS deleted_at, o_custkey AS deleted_by_user_id, CAST(7 AS BIGINT) AS ingest_event_id
       FROM orders""",
)
def audit_columns(t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("updated_at"))
    values = {
        "created_at": FIXED, "updated_at": FIXED, "deleted_at": None, "deleted_by_user_id": F.col("o_custkey"), "ingest_event_id": 7,
    }
    done = project.audited(orders, values).drop("o_custkey")
    return done.withColumns({c: F.date_format(c, STAMP) for c in ("created_at", "updated_at", "deleted_at")})


@query(
    "alive_rows",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 7 <> 0",
)
def alive_rows(t: Tables) -> DataFrame:
    marked = t("orders").withColumn("deleted_at", F.expr("CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate END"))
    return project.alive(marked).select("o_orderkey", "o_totalprice")


@query(
    "asset_split",
    """SELECT p_partkey AS id, p_name AS alias, CAST(1 AS BIGINT) AS tipo_activo_id, true AS is_active,
              CAST(NULL AS VARCHAR) AS tipo, CAST(NULL AS VARCHAR) AS marca, CAST(NULL AS BIGINT) AS anio FROM part
       UNION ALL
       SELECT p_partkey, CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS BOOLEAN), p_type, p_brand, 1980 + p_size FROM part""",
)
def asset_split(t: Tables) -> DataFrame:
    vehicles = t("part").selectExpr(
        "p_partkey AS id", "p_name AS alias", "p_type AS tipo_vehiculo", "p_brand AS marca", "1980 + p_size AS anio"
    )
    parts = split_assets(vehicles)
    details = parts["assets_vehicles"].withColumnRenamed("activo_id", "id")
    both = project.union_aligned([parts["assets"], details])
    return both.select("id", "alias", "tipo_activo_id", "is_active", "tipo", "marca", "anio")


def _profile_sql() -> str:
    types = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}
    one = """SELECT '{0}' AS "column", '{1}' AS dtype, count(x) AS non_null, count(*) - count(x) AS nulls
        FROM (SELECT CASE WHEN event_id % {2} = 0 THEN NULL ELSE {0} END AS x FROM events)"""
    return " UNION ALL ".join(one.format(c, k, 3 + i) for i, (c, k) in enumerate(types.items()))


@query("profile", _profile_sql())
def profile(t: Tables) -> DataFrame:
    events = t("events")
    gaps = [
        F.when(F.col("event_id") % (3 + i) != 0, F.col(c)).alias(c) for i, c in enumerate(events.columns)
    ]
    return project.profile(events.select(*gaps))


@query(
    "load_report",
    """SELECT 'orders' AS "table", count(*) AS rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
       UNION ALL SELECT 'customer', count(*) FROM customer
       UNION ALL SELECT 'total', (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem) + (SELECT count(*) FROM customer)""",
)
def load_report(t: Tables) -> DataFrame:
    return count_report({name: t(name) for name in ("orders", "lineitem", "customer")})


@query(
    "table_read",
    """SELECT o_orderkey, o_totalprice, (SELECT max(o_totalprice) FROM orders) AS top, true AS found
       FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 300000.0 ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
)
def table_read(t: Tables) -> DataFrame:
    """The hundred dearest final orders below a price, by parameterized reads of a view."""
    t("orders").createOrReplaceTempView("tablewright_orders")
    spark = t.spark
    top = read_scalar(spark, "SELECT max(o_totalprice) FROM tablewright_orders")
    assert not table_exists(spark, "default", "tablewright_absent")
    rows = read_table(
        spark, "tablewright_orders", ["o_orderkey", "o_totalprice"], "o_orderstatus = :s AND o_totalprice < :p", {"s": "F", "p": 300000.0}
    )
    ordered = rows.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(100)
    return ordered.withColumns({"top": F.lit(top), "found": F.lit(True)})


@query(
    "sql_read",
    "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice >= 1000.0 GROUP BY o_orderpriority",
)
def sql_read(t: Tables) -> DataFrame:
    t("orders").createOrReplaceTempView("tablewright_orders")
    text = "SELECT o_orderpriority, count(*) AS n FROM tablewright_orders WHERE o_totalprice >= :p GROUP BY o_orderpriority"
    return read_sql(t.spark, text, {"p": 1000.0})
