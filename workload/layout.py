"""Written layouts: months, upserts in place, latest rows."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import scratch_path
from tablewright.sources.months import latest_per, read_months, upsert_months, write_months

from .registry import STAMP, Tables, query, shifted

NOW = datetime.datetime(2024, 1, 2, 3, 4, 5)
SINCE = datetime.date(1998, 6, 15)

_UPDATED = "month(o_orderdate) % 4 = 1"
_ORDERS_SQL = f"""
  target AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, o_orderdate AS updated_at FROM orders),
  updates AS (
    SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice,
      CASE WHEN o_orderkey % 35 = 0 THEN o_orderdate + INTERVAL 40 DAY ELSE o_orderdate END AS o_orderdate
    FROM orders WHERE {_UPDATED} AND o_orderkey % 5 = 0
    UNION ALL SELECT o_orderkey + 10000000000, o_totalprice, o_orderdate FROM orders WHERE {_UPDATED} AND o_orderkey % 50 = 0
  )"""


def _written_orders(t: Tables, path: str) -> DataFrame:
    orders = t("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    write_months(orders.withColumn("updated_at", F.col("o_orderdate")), path, "o_orderdate", ["o_orderkey"])
    return orders


@query(
    "upsert_written",
    f"""WITH {_ORDERS_SQL}
      SELECT o_orderkey, t.o_custkey, t.o_orderstatus, t.o_orderpriority,
             CASE WHEN u.k IS NOT NULL THEN u.p ELSE t.o_totalprice END AS o_totalprice,
             {shifted('CASE WHEN u.k IS NOT NULL THEN u.d ELSE t.o_orderdate END')} AS o_orderdate,
             CASE WHEN t.o_totalprice IS NULL THEN NULL
                  WHEN u.k IS NOT NULL AND (u.p <> t.o_totalprice OR u.d <> t.o_orderdate) THEN '2024-01-02 03:04:05'
                  ELSE {shifted('t.updated_at')} END AS updated_at
      FROM target t FULL JOIN (SELECT o_orderkey, o_orderkey AS k, o_totalprice AS p, o_orderdate AS d FROM updates) u USING (o_orderkey)""",
)
def upsert_written(t: Tables) -> DataFrame:
    """Orders written by month, updates (some move to another month) written in place, and the table read back."""
    path = scratch_path(t.spark, "orders")
    hit = _written_orders(t, path).where(_UPDATED)
    changed = hit.where("o_orderkey % 5 = 0").selectExpr(
        "o_orderkey",
        "CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice",
        "CASE WHEN o_orderkey % 35 = 0 THEN o_orderdate + INTERVAL 40 DAYS ELSE o_orderdate END AS o_orderdate",
    )
    fresh = hit.where("o_orderkey % 50 = 0").selectExpr("o_orderkey + 10000000000 AS o_orderkey", "o_totalprice", "o_orderdate")
    upsert_months(t.spark, path, changed.unionByName(fresh), ["o_orderkey"], "o_orderdate", NOW, ["o_orderkey"], moved=True)
    return read_months(t.spark, path, "o_orderdate").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
        F.date_format("o_orderdate", STAMP).alias("o_orderdate"), F.date_format("updated_at", STAMP).alias("updated_at"),
    )


@query(
    "latest_per_entity",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {shifted('o_orderdate')} AS o_orderdate, o_orderpriority
        FROM orders WHERE o_orderdate >= TIMESTAMP '{SINCE} 00:00:00'
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def latest_per_entity(t: Tables) -> DataFrame:
    """Orders written by month, and the latest one of each customer since a date."""
    path = scratch_path(t.spark, "orders")
    _written_orders(t, path)
    found = latest_per(read_months(t.spark, path, "o_orderdate", since=SINCE), ["o_custkey"], "o_orderdate", "o_orderkey")
    return found.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.date_format("o_orderdate", STAMP).alias("o_orderdate"), "o_orderpriority"
    )
