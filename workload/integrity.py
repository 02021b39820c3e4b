"""Integrity rules, deletes and upserts."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators import quality
from tablewright.operators.deletes import CASCADE, RESTRICT, SET_NULL, ForeignKey, propagate
from tablewright.operators.key_rules import PRIMARY, Key, key_violations
from tablewright.operators.keys import next_ids
from tablewright.operators.project import more_than_one, union_aligned
from tablewright.operators.upsert import insert_if_absent, seed, upsert

from .registry import STAMP, Tables, columns, query, select_list, shifted

# --- shared dirt ----------------------------------------------------------------------------------
BROKEN_LINES = {
    "id": "l_orderkey * 10 + l_linenumber",
    "l_orderkey": "CASE WHEN l_partkey % 97 = 0 THEN l_orderkey + 1000000000 WHEN l_partkey % 89 = 0 THEN NULL ELSE l_orderkey END",
    "quantity": "CASE WHEN l_partkey % 50 = 0 THEN -l_quantity WHEN l_partkey % 51 = 0 THEN NULL ELSE l_quantity END",
    "price": "CASE WHEN l_partkey % 60 = 0 THEN 0.0 ELSE l_extendedprice END",
    "flag": "CASE WHEN l_partkey % 70 = 0 THEN 'X' WHEN l_partkey % 71 = 0 THEN NULL ELSE l_returnflag END",
}
_LINES_SQL = f"WITH lines AS (SELECT {select_list(BROKEN_LINES)} FROM lineitem)"
SHAPE_SQL = '{0} AS "table", {1} AS rule, {2} AS "column", {3} AS key, {4} AS value, {5} AS message'


def _lines(t: Tables) -> DataFrame:
    return t("lineitem").selectExpr(*columns(BROKEN_LINES))


def _number(c: str) -> str:
    """A double as the same text in both engines: all values here have at most two decimals."""
    return f"printf('%.2f', {c})"


@query(
    "dq_checks",
    _LINES_SQL
    + f"""
    SELECT 'lineitem' AS "table", 'quantity_amount' AS rule, 'quantity' AS "column", CAST(id AS VARCHAR) AS key,
           {_number('quantity')} AS value, 'check quantity_amount fails' AS message FROM lines WHERE NOT (quantity >= 0)
    UNION ALL
    SELECT 'lineitem', 'price_amount', 'price', CAST(id AS VARCHAR), {_number('price')}, 'check price_amount fails'
    FROM lines WHERE NOT (price > 0)
    UNION ALL
    SELECT 'lineitem', 'flag_domain', 'flag', CAST(id AS VARCHAR), flag, 'check flag_domain fails'
    FROM lines WHERE NOT (flag IN ('A', 'N', 'R'))""",
)
def dq_checks(t: Tables) -> DataFrame:
    rules = {
        "quantity_amount": ("quantity", "quantity >= 0"),
        "price_amount": ("price", "price > 0"),
        "flag_domain": ("flag", F.col("flag").isin("A", "N", "R")),
    }
    found = quality.check(_lines(t), "lineitem", rules, "id")
    numeric = F.col("column") != "flag"
    shown = F.when(numeric, F.format_string("%.2f", F.col("value").try_cast("double"))).otherwise(F.col("value"))
    return found.withColumn("value", shown)


@query(
    "dq_unique",
    """SELECT 'events' AS "table", 'unique' AS rule, 'user_id,event_type,minute' AS "column",
              user_id || '|' || event_type || '|' || minute AS key, CAST(count(*) AS VARCHAR) AS value,
              'key occurs more than once' AS message
       FROM (SELECT CASE WHEN event_id % 10 <> 0 THEN user_id END AS user_id, event_type,
                    strftime(ts, '%Y-%m-%d %H:%M') AS minute FROM events)
       WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND minute IS NOT NULL
       GROUP BY user_id, event_type, minute HAVING count(*) > 1
       UNION ALL
       SELECT 'customer', 'unique', 'label', label, CAST(count(*) AS VARCHAR), 'key occurs more than once'
       FROM (SELECT CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment ELSE c_name END AS label FROM customer)
       GROUP BY label HAVING count(*) > 1""",
)
def dq_unique(t: Tables) -> DataFrame:
    events = t("events").select(
        F.expr("CASE WHEN event_id % 10 <> 0 THEN user_id END").alias("user_id"),
        "event_type",
        F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute"),
    )
    labels = t("customer").selectExpr("CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment ELSE c_name END AS label")
    return quality.union_violations(
        [
            key_violations(events, "events", [Key(("user_id", "event_type", "minute"))]),
            key_violations(labels, "customer", [Key(("label",))]),
        ]
    )


@query(
    "dq_pk",
    """SELECT 'lineitem' AS "table", 'primary_key' AS rule, 'l_orderkey,l_linenumber' AS "column",
              l_orderkey || '|' || l_linenumber AS key, CAST(count(*) AS VARCHAR) AS value,
              'key occurs more than once' AS message
       FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
       UNION ALL
       SELECT 'orders', 'primary_key', 'id', NULL, CAST(count(*) AS VARCHAR), 'key is null'
       FROM orders WHERE o_orderkey % 100 = 7 HAVING count(*) > 0
       UNION ALL
       SELECT 'orders', 'unique', 'o_custkey,day', o_custkey || '|' || day, CAST(count(*) AS VARCHAR), 'key occurs more than once'
       FROM (SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders) GROUP BY o_custkey, day HAVING count(*) > 1""",
)
def dq_pk(t: Tables) -> DataFrame:
    orders = t("orders").select(
        F.expr("CASE WHEN o_orderkey % 100 <> 7 THEN o_orderkey END").alias("id"), "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    )
    return quality.union_violations(
        [
            key_violations(t("lineitem"), "lineitem", [Key(("l_orderkey", "l_linenumber"), PRIMARY)]),
            # both keys of a table in one scan and one shuffle
            key_violations(orders, "orders", [Key(("id",), PRIMARY), Key(("o_custkey", "day"))]),
        ]
    )


@query(
    "dq_fk",
    _LINES_SQL
    + """
    SELECT 'lineitem' AS "table", 'foreign_key' AS rule, 'l_orderkey' AS "column", CAST(l_orderkey AS VARCHAR) AS key,
           CAST(count(*) AS VARCHAR) AS value, 'not in orders.o_orderkey' AS message
    FROM lines WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
    GROUP BY l_orderkey
    UNION ALL
    SELECT 'orders', 'foreign_key', 'o_custkey', CAST(o_custkey AS VARCHAR), CAST(count(*) AS VARCHAR), 'not in customer.c_custkey'
    FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END AS o_custkey FROM orders)
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey) GROUP BY o_custkey
    UNION ALL
    SELECT 'lineitem', 'foreign_key', 'part', CAST(l_partkey AS VARCHAR), CAST(count(*) AS VARCHAR), 'not in part.p_partkey'
    FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 3 <> 0) GROUP BY l_partkey
    UNION ALL
    SELECT 'lineitem', 'foreign_key', 'supplier', 'S-' || CAST(l_suppkey AS VARCHAR), CAST(count(*) AS VARCHAR), 'not in supplier.s_suppkey'
    FROM lineitem WHERE l_suppkey % 4 = 1 GROUP BY l_suppkey""",
)
def dq_fk(t: Tables) -> DataFrame:
    """Orphans, one of them a single value that a third of all orders hold."""
    orders = t("orders")
    skewed = orders.selectExpr("CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END AS o_custkey")
    return quality.union_violations(
        [
            quality.foreign_key(_lines(t), "lineitem", "l_orderkey", orders, "orders", "o_orderkey"),
            quality.foreign_key(skewed, "orders", "o_custkey", t("customer"), "customer", "c_custkey"),
            # two keys of one child in one scan, the second one text that is not always a number
            quality.foreign_keys(
                t("lineitem").selectExpr(
                    "l_partkey AS part", "if(l_suppkey % 4 = 1, 'S-', '') || cast(l_suppkey as string) AS supplier"
                ),
                "lineitem",
                {
                    "part": (t("part").where("p_partkey % 3 <> 0"), "part", "p_partkey"),
                    "supplier": (t("supplier"), "supplier", "s_suppkey"),
                },
            ),
        ]
    )


# Deleting some customers and suppliers: orders and their lines go along, notes lose their
# customer, and lines that still name a deleted supplier block the delete.
DELETE_KEYS = [
    ForeignKey("orders", "o_custkey", "customer", "c_custkey", CASCADE),
    ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey", CASCADE),
    ForeignKey("lineitem", "l_suppkey", "supplier", "s_suppkey", RESTRICT),
    ForeignKey("events", "user_id", "customer", "c_custkey", SET_NULL),
]


@query(
    "delete_propagation",
    """WITH c AS (SELECT c_custkey FROM customer WHERE c_custkey % 10 = 0),
      o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)),
      l AS (SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM o)),
      s AS (SELECT s_suppkey FROM supplier WHERE s_suppkey % 20 = 3)
    SELECT 'customer' AS what, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS total FROM customer WHERE c_custkey % 10 <> 0
    UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o)
    UNION ALL SELECT 'lineitem', count(*), CAST(sum(l_partkey) AS BIGINT) FROM l
    UNION ALL SELECT 'supplier', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM supplier WHERE s_suppkey % 20 <> 3
    UNION ALL SELECT 'events', count(*), CAST(sum(CASE WHEN user_id IN (SELECT c_custkey FROM c) THEN NULL ELSE user_id END) AS BIGINT) FROM events
    UNION ALL SELECT 'blocked supplier ' || l_suppkey, count(*), l_suppkey FROM l WHERE l_suppkey IN (SELECT s_suppkey FROM s) GROUP BY l_suppkey""",
)
def delete_propagation(t: Tables) -> DataFrame:
    tables = {
        "customer": t("customer").select("c_custkey"),
        "supplier": t("supplier").select("s_suppkey"),
        "orders": t("orders").select("o_orderkey", "o_custkey"),
        "lineitem": t("lineitem").selectExpr("l_orderkey * 10 + l_linenumber AS id", "l_orderkey", "l_suppkey", "l_partkey"),
        "events": t("events").select("event_id", "user_id"),
    }
    ids = {"customer": "c_custkey", "supplier": "s_suppkey", "orders": "o_orderkey", "events": "event_id"}
    deleted = {
        "customer": tables["customer"].where("c_custkey % 10 = 0").select("c_custkey"),
        "supplier": tables["supplier"].where("s_suppkey % 20 = 3").select("s_suppkey"),
    }
    left, blocked = propagate(tables, DELETE_KEYS, deleted, ids)
    measured = {"customer": "c_custkey", "supplier": "s_suppkey", "orders": "o_orderkey", "lineitem": "l_partkey", "events": "user_id"}
    counts = [
        left[name].agg(F.count(F.lit(1)).alias("n"), F.sum(column).alias("total")).select(F.lit(name).alias("what"), "n", "total")
        for name, column in measured.items()
    ]
    held = blocked.select(
        F.concat(F.lit("blocked supplier "), "key").alias("what"),
        F.col("value").cast("long").alias("n"),
        F.col("key").cast("long").alias("total"),
    )
    return union_aligned([*counts, held])


NOW = datetime.datetime(2024, 1, 2, 3, 4, 5)


@query(
    "upsert_touch",
    f"""WITH target AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate AS updated_at FROM orders),
      updates AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice
                  FROM orders WHERE o_orderkey % 5 = 0
                  UNION ALL SELECT o_orderkey + 10000000000, o_totalprice FROM orders WHERE o_orderkey % 50 = 0)
      SELECT o_orderkey, target.o_custkey, CASE WHEN u.k IS NOT NULL THEN u.p ELSE target.o_totalprice END AS o_totalprice,
             CASE WHEN target.o_totalprice IS NULL THEN NULL
                  WHEN u.k IS NOT NULL AND u.p IS DISTINCT FROM target.o_totalprice THEN '2024-01-02 03:04:05'
                  ELSE {shifted('target.updated_at')} END AS updated_at
      FROM target FULL JOIN (SELECT o_orderkey, o_orderkey AS k, o_totalprice AS p FROM updates) u USING (o_orderkey)""",
)
def upsert_touch(t: Tables) -> DataFrame:
    orders = t("orders")
    target = orders.select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("timestamp").alias("updated_at"))
    changed = orders.where("o_orderkey % 5 = 0").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 10 = 0 THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice"
    )
    fresh = orders.where("o_orderkey % 50 = 0").selectExpr("o_orderkey + 10000000000 AS o_orderkey", "o_totalprice")
    out = upsert(target, changed.unionByName(fresh), ["o_orderkey"], NOW)
    return out.withColumn("updated_at", F.date_format("updated_at", STAMP))


@query(
    "insert_if_absent",
    """WITH e AS (SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN user_id END AS user_id, event_type,
                         strftime(ts, '%Y-%m-%d %H') AS hour FROM events),
      first AS (SELECT * FROM e WHERE event_id % 2 = 1 AND user_id IS NOT NULL
                QUALIFY row_number() OVER (PARTITION BY user_id, event_type, hour ORDER BY event_id) = 1)
      SELECT * FROM first WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.event_id % 2 = 0 AND e.user_id = first.user_id
             AND e.event_type = first.event_type AND e.hour = first.hour)
      UNION ALL SELECT * FROM e WHERE event_id % 2 = 1 AND user_id IS NULL""",
)
def insert_absent(t: Tables) -> DataFrame:
    events = t("events").select(
        "event_id",
        F.expr("CASE WHEN event_id % 97 <> 0 THEN user_id END").alias("user_id"),
        "event_type",
        F.date_format("ts", "yyyy-MM-dd HH").alias("hour"),
    )
    old, batch = events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1")
    return insert_if_absent(old, batch, ["user_id", "event_type", "hour"], ["event_id"])


@query(
    "seed_rows",
    """SELECT s_suppkey AS id, s_name AS label, true AS is_active FROM supplier WHERE s_suppkey % 3 <> 0
       UNION ALL SELECT p_partkey, p_name, false FROM part
       WHERE p_partkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0)""",
)
def seed_rows(t: Tables) -> DataFrame:
    target = t("supplier").where("s_suppkey % 3 <> 0").selectExpr("s_suppkey AS id", "s_name AS label", "true AS is_active")
    return seed(target, t("part").selectExpr("p_partkey AS id", "p_name AS label", "false AS is_active"))


@query(
    "next_ids",
    """SELECT p_partkey + 1 AS id, p_name AS label FROM part
       UNION ALL SELECT (SELECT max(p_partkey) + 1 FROM part) + row_number() OVER (ORDER BY c_name), c_name FROM customer""",
)
def append_ids(t: Tables) -> DataFrame:
    existing = t("part").selectExpr("p_partkey + 1 AS id", "p_name AS label")
    fresh = t("customer").selectExpr("c_name AS label")
    return existing.unionByName(next_ids(existing, fresh, ["label"]))


@query(
    "predicates",
    """SELECT l_orderkey, l_linenumber, l_returnflag IN ('A', 'R') AS in_set,
              regexp_matches(l_shipmode, '^[0-9]{4}-0[1-6]') AS in_half, contains(l_shipmode, '-12-') AS december,
              length(l_shipmode) - length(replace(l_shipmode, '1', '')) AS ones,
              (CASE WHEN q IS NULL THEN 0 ELSE 1 END + CASE WHEN d IS NULL THEN 0 ELSE 1 END) > 1 AS several
       FROM (SELECT l_orderkey, l_linenumber, l_returnflag, strftime(l_shipdate, '%Y-%m-%d') AS l_shipmode,
                    CASE WHEN l_partkey % 3 <> 0 THEN l_quantity END AS q,
                    CASE WHEN l_partkey % 5 <> 0 THEN l_discount END AS d FROM lineitem)
       WHERE q IS NOT NULL OR d IS NOT NULL""",
)
def predicates(t: Tables) -> DataFrame:
    lines = t("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
        F.expr("CASE WHEN l_partkey % 3 <> 0 THEN l_quantity END").alias("q"),
        F.expr("CASE WHEN l_partkey % 5 <> 0 THEN l_discount END").alias("d"),
    )
    return lines.dropna(subset=["q", "d"], how="all").select(
        "l_orderkey",
        "l_linenumber",
        F.lower("l_returnflag").isin("a", "r").alias("in_set"),
        F.col("shipped").rlike("^[0-9]{4}-0[1-6]").alias("in_half"),
        F.contains("shipped", F.lit("-12-")).alias("december"),
        F.regexp_count("shipped", F.lit("1")).cast("long").alias("ones"),
        more_than_one(["q", "d"]).alias("several"),
    )
