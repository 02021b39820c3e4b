"""Loads that happen whole or not at all, identity marks, and deletes over cycles of references."""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import ConformError
from tablewright.operators.deletes import CASCADE, ForeignKey, propagate
from tablewright.operators.key_rules import PRIMARY, Key, key_violations
from tablewright.operators.project import union_aligned
from tablewright.session import scratch_path
from tablewright.sources.sinks import Target
from tablewright.sources.staged import load_whole, next_id, reserve, save_marks

from .registry import Tables, query


def _schema(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


CLIENTS = Target("clients", _schema(id=T.LongType(), nombre=T.StringType(), saldo=T.DecimalType(14, 2)), source="clientes", required=("id",))
ORDERS = Target("orders", _schema(id=T.LongType(), cliente_id=T.LongType(), total=T.DecimalType(14, 2)), source="pedidos", must_load=True)
LOG = Target("ingest_events", _schema(id=T.LongType(), status=T.StringType()), area="ingest")
TARGETS = [CLIENTS, ORDERS, LOG]


def _frames(t: Tables, factor: str, bad: str = "false") -> dict[str, DataFrame]:
    return {
        "clientes": t("customer").selectExpr("c_custkey AS id", "c_name AS nombre", f"c_acctbal * {factor} AS saldo"),
        "pedidos": t("orders").selectExpr(
            "o_orderkey AS id", "o_custkey AS cliente_id", f"CASE WHEN {bad} THEN 'x' ELSE cast(o_totalprice * {factor} AS string) END AS total"
        ),
        # a frame that only its own name connects to a target
        "ingest.ingest_events": t("events").selectExpr("event_id AS id", "event_type AS status"),
    }


def _areas() -> dict[str, str]:
    tag = uuid.uuid4().hex[:12]
    return {"core": f"tablewright_core_{tag}", "ingest": f"tablewright_ingest_{tag}"}


_SUMS = """SELECT '{0}' AS step, 'core.clients' AS "table", c_custkey AS id, c_name AS label, CAST(CAST(c_acctbal * {1} AS DECIMAL(14,2)) AS VARCHAR) AS amount FROM customer
  UNION ALL SELECT '{0}', 'core.orders', o_orderkey, CAST(o_custkey AS VARCHAR), CAST(CAST(o_totalprice * {1} AS DECIMAL(14,2)) AS VARCHAR) FROM orders
  UNION ALL SELECT '{0}', 'ingest.ingest_events', event_id, event_type, NULL FROM events"""


@query("load_whole", " UNION ALL ".join([_SUMS.format("loaded", 1), _SUMS.format("text refused", 1), _SUMS.format("rule refused", 1), _SUMS.format("replaced", 2)]))
def loads(t: Tables) -> DataFrame:
    """Four loads; after each all rows of all tables.  One is refused for a text in a money column,
    one for repeated ids that only the validation of the written tables sees; both leave the rows of the first."""
    spark, areas = t.spark, _areas()
    root = scratch_path(spark, "whole")

    def validate(tables):
        return key_violations(tables["clients"], "clients", [Key(("id",), PRIMARY)])

    # the last load's folders stay, and so do those of the first: a plan that reads them stays valid
    def rows(step: str) -> DataFrame:
        found = []
        for x in TARGETS:
            # the files that the table points at now
            location = spark.sql(f"DESCRIBE TABLE EXTENDED `{areas[x.area]}`.`{x.name}`").where("col_name = 'Location'").first()["data_type"]
            df = spark.read.schema(x.schema).parquet(location)
            label, amount = {"clients": ("nombre", "saldo"), "orders": ("cliente_id", "total"), "ingest_events": ("status", None)}[x.name]
            shown = F.col(amount).cast("string") if amount else F.lit(None).cast("string")
            found.append(df.select(F.lit(step).alias("step"), F.lit(f"{x.area}.{x.name}").alias("table"), "id", F.col(label).cast("string").alias("label"), shown.alias("amount")))
        return union_aligned(found)

    load_whole(spark, _frames(t, "1"), TARGETS, areas, root, validate=validate)
    out = [rows("loaded")]
    try:
        load_whole(spark, _frames(t, "3", bad="o_orderkey % 1000 = 7"), TARGETS, areas, root, validate=validate, strict=True)
    except PySparkException:
        out.append(rows("text refused"))
    twice = _frames(t, "5")
    twice["clientes"] = twice["clientes"].union(twice["clientes"].where("id % 100 = 3"))
    try:
        load_whole(spark, twice, TARGETS, areas, root, validate=validate)
    except ConformError:
        out.append(rows("rule refused"))
    load_whole(spark, _frames(t, "2"), TARGETS, areas, root, validate=validate)
    return union_aligned([*out, rows("replaced")])


@query(
    "ids_after_load",
    """SELECT 'core.clients' AS "table", max(c_custkey) + 1 AS next_id, max(c_custkey) + 1 AS block, max(c_custkey) + 101 AS after FROM customer
       UNION ALL SELECT 'core.orders', max(o_orderkey) + 1, max(o_orderkey) + 1, max(o_orderkey) + 101 FROM orders
       UNION ALL SELECT 'ingest.ingest_events', max(event_id) + 1, max(event_id) + 1, max(event_id) + 101 FROM events""",
)
def ids_after_load(t: Tables) -> DataFrame:
    """The next free ids that a load leaves, a reserved block of 100, and the next id behind it."""
    spark = t.spark
    root = scratch_path(spark, "marks")
    done = load_whole(spark, _frames(t, "1"), TARGETS, _areas(), root)
    save_marks(spark, root, done.next_ids)
    rows = [(name, first, reserve(spark, root, name, 100), next_id(spark, root, name)) for name, first in done.next_ids.items()]
    return spark.createDataFrame(rows, "`table` string, next_id long, block long, after long")


@query(
    "must_load",
    """SELECT 'no frame for [''orders''], which other tables depend on' AS message, count(*) AS orders FROM orders""",
)
def must_load(t: Tables) -> DataFrame:
    """A load without a frame that others depend on is refused; one with it runs the table's own preparation."""
    spark, areas = t.spark, _areas()
    root = scratch_path(spark, "must")
    frames = _frames(t, "1")
    message = ""
    try:
        load_whole(spark, {k: v for k, v in frames.items() if k != "pedidos"}, TARGETS, areas, root)
    except ConformError as error:
        message = str(error)
    prepared = Target("orders", ORDERS.schema, source="pedidos", must_load=True, prepare=lambda df: df.withColumnRenamed("number", "id"))
    frames["pedidos"] = frames["pedidos"].withColumnRenamed("id", "number")
    load_whole(spark, frames, [CLIENTS, prepared, LOG], areas, root)
    return spark.table(f"`{areas['core']}`.orders").agg(F.count("id").alias("orders")).select(F.lit(message).alias("message"), "orders")


# Orders belong to customers and some are paid by another one; some customers were won by an order: cycles of cascades.
CYCLE = [
    ForeignKey("orders", "o_custkey", "customer", "c_custkey", CASCADE),
    ForeignKey("orders", "paid_by", "customer", "c_custkey", CASCADE),
    ForeignKey("customer", "won_by", "orders", "o_orderkey", CASCADE),
    ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey", CASCADE),
]
_WON_BY = "CASE WHEN c_custkey % 3 = 0 THEN c_custkey * 10 END"
_PAID_BY = "CASE WHEN o_orderkey % 20 = 3 THEN o_custkey + 1 END"


@query(
    "delete_cycle",
    f"""WITH RECURSIVE c AS (SELECT c_custkey, {_WON_BY} AS won_by FROM customer),
      o AS (SELECT o_orderkey, o_custkey, {_PAID_BY} AS paid_by FROM orders),
      dead AS (
        SELECT 'c' AS kind, c_custkey AS id FROM c WHERE c_custkey % 100 = 7
        UNION
        (SELECT n.kind, n.id FROM dead d JOIN (
           SELECT 'o' AS kind, o_orderkey AS id, 'c' AS by_kind, o_custkey AS by_id FROM o
           UNION ALL SELECT 'o', o_orderkey, 'c', paid_by FROM o
           UNION ALL SELECT 'c', c_custkey, 'o', won_by FROM c
         ) n ON n.by_kind = d.kind AND n.by_id = d.id)
      )
    SELECT 'customer' AS "table", c_custkey AS id, won_by AS refers FROM c WHERE c_custkey NOT IN (SELECT id FROM dead WHERE kind = 'c')
    UNION ALL SELECT 'orders', o_orderkey, paid_by FROM o WHERE o_orderkey NOT IN (SELECT id FROM dead WHERE kind = 'o')
    UNION ALL SELECT 'lineitem', l_partkey, l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT id FROM dead WHERE kind = 'o')""",
)
def delete_cycle(t: Tables) -> DataFrame:
    tables = {
        "customer": t("customer").selectExpr("c_custkey", f"{_WON_BY} AS won_by"),
        "orders": t("orders").selectExpr("o_orderkey", "o_custkey", f"{_PAID_BY} AS paid_by"),
        "lineitem": t("lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS id", "l_orderkey", "l_partkey"),
    }
    ids = {"customer": "c_custkey", "orders": "o_orderkey"}
    left, _ = propagate(tables, CYCLE, {"customer": tables["customer"].where("c_custkey % 100 = 7").select("c_custkey")}, ids)
    shown = {"customer": ("c_custkey", "won_by"), "orders": ("o_orderkey", "paid_by"), "lineitem": ("l_partkey", "l_orderkey")}
    return union_aligned(
        [left[n].select(F.lit(n).alias("table"), F.col(i).cast("long").alias("id"), F.col(r).cast("long").alias("refers")) for n, (i, r) in shown.items()]
    )
