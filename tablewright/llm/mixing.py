"""Mixing sources to target weights by weighted fair queueing.

Every source has a weight and a queue: its documents in a shuffled but repeatable order (by md5 of the
id), the whole queue again when it has run out, at most `EPOCHS` times.  A document's virtual finish
time is the words its source has handed out up to its end, divided by the source's target, so at
virtual time 1 every source has had exactly its target and the mix its total budget.  The mix is the
documents of all sources range-sorted by virtual finish time; a document being served at time 1 is cut
there, later ones are not taken.

Targets are water-filled: the budget is shared by weight, a source that would need more than `EPOCHS`
times its words stops there, and what is over goes to the others by weight.

Only DataFrame functions are used.  The sums along a queue need no task per source: rows are
range-partitioned by (source, shuffled order), summed inside each partition, and offset by what the
partitions before it hold.  A hot source is therefore spread over as many partitions as it fills.

Null texts count 0 words and take nothing; a null source is a source of its own, the last.  Equal ids
are ordered by size; rows equal in both are interchangeable and each is served on its own.  An empty
table, or one without words, gives targets of 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BUDGET_PERCENT = 150
EPOCHS = 2
BROADCAST_ROWS = 50_000  # of targets: beyond, the join shuffles


def word_count(text: str):
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, budget_percent: int = BUDGET_PERCENT, epochs: int = EPOCHS
) -> DataFrame:
    """`source, source_size, target` from rows of `source, size`; one row per source.

    The windows order one row per source, not documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * epochs)
    # sources by the level at which they are full; before each, all earlier ones are
    level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    per = (
        per.withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("budget", F.sum("source_size").over(every) * budget_percent / 100)
        .withColumn("level", (F.col("budget") - F.col("full")) / F.col("open"))
    )
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    share = F.max(fits).over(every) * F.col("weight")
    target = F.least(F.col("cap").cast("double"), F.coalesce(share, F.col("cap").cast("double")))
    return per.select("source", "source_size", target.alias("target"))


def served(
    docs: DataFrame, key: str = "doc_id", epochs: int = EPOCHS,
    weights: Sequence[int] = WEIGHTS, budget_percent: int = BUDGET_PERCENT,
) -> DataFrame:
    """Rows of `docs` (with `source` and `size`) and their service: `source_size`, `target`, the words
    handed out before it in its queue (`before`), `virtual_finish` of its first turn, and `taken`.
    Input columns with the names of these, or of `turn` and `words`, are replaced."""
    docs = docs.drop("source_size", "target", "before", "virtual_finish", "taken", "turn", "words", "__turn", "__part", "__inside", "__offset", "__p", "__s")
    goal = materialize(targets(docs.select("source", "size"), weights, budget_percent, epochs), "targets")
    if goal.count() <= BROADCAST_ROWS:
        goal = F.broadcast(goal)
    turn = F.md5(F.col(f"`{key}`").cast("string"))
    order = [F.col("source").asc_nulls_last(), F.col("__turn"), F.col(f"`{key}`"), F.col("size")]
    dealt = docs.withColumn("__turn", turn).repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    dealt = materialize(dealt, "queues")  # where a row is must be the same in its sum and in its use
    parts = dealt.groupBy("__part", "source").agg(F.sum("size").alias("__n"))
    earlier = Window.partitionBy("source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        F.col("__part").alias("__p"), F.col("source").alias("__s"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__offset")
    )
    inside = Window.partitionBy("__part", "source").orderBy("__turn", f"`{key}`", "size").rowsBetween(Window.unboundedPreceding, -1)
    queue = dealt.withColumn("__inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    queue = queue.join(offsets, (F.col("__part") == F.col("__p")) & F.col("source").eqNullSafe(F.col("__s"))).drop("__p", "__s")
    queue = queue.withColumn("before", F.col("__offset") + F.col("__inside"))
    goal = goal.withColumnRenamed("source", "__s")
    queue = queue.join(goal, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    taken = sum((_part(F.lit(e)) for e in range(epochs)), F.lit(0))
    finish = F.when(F.col("target") > 0, (F.col("before") + F.col("size")) / F.col("target"))
    return queue.select(
        *[F.col(f"`{c}`") for c in docs.columns], "source_size", "target", "before",
        finish.alias("virtual_finish"), taken.cast("long").alias("taken"),
    )


def _part(turn):
    """Words of a row's turn that lie before virtual time 1."""
    left = F.floor(F.col("target")) - F.col("source_size") * turn - F.col("before")
    return F.greatest(F.lit(0), F.least(F.col("size"), left))


def mix(served_rows: DataFrame, epochs: int = EPOCHS, sort: bool = True) -> DataFrame:
    """The mix itself: a row per turn with the words it gives (`words`), in the order of service.

    Without `sort` the caller orders by `virtual_finish`, say after adding texts.
    """
    turns = served_rows.withColumn("turn", F.explode(F.array(*map(F.lit, range(epochs)))))
    turns = turns.withColumn("words", _part(F.col("turn")).cast("long")).where("words > 0")
    finish = (F.col("before") + F.col("size") + F.col("source_size") * F.col("turn")) / F.col("target")
    turns = turns.withColumn("virtual_finish", F.least(finish, F.lit(1.0)))
    if not sort:
        return turns
    return turns.orderBy("virtual_finish", F.col("source").asc_nulls_last(), "turn", "before")


def first_words(text: str, words: str):
    """The text up to its `words`-th word; used for the one document per source that is cut."""
    kept = F.slice(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(WORD), F.lit(0)), F.lit(1), F.col(words).cast("int"))
    return F.array_join(kept, " ")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         2 * source_size AS cap FROM per
), levels AS (
  SELECT *, coalesce(sum(cap) OVER w, 0) AS filled,
         sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS open_weight,
         (sum(source_size) OVER ())::DOUBLE * 150 / 100 AS budget
  FROM weighted
  WINDOW w AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shares AS (
  SELECT *, (budget - filled::DOUBLE) / open_weight::DOUBLE AS level FROM levels
), goal AS (
  SELECT source, source_size,
         least(cap::DOUBLE, (SELECT max(level) FROM shares WHERE level <= cap::DOUBLE / weight) * weight) AS target
  FROM shares
), queued AS (
  SELECT d.doc_id, d.size, g.source_size, g.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(d.doc_id::VARCHAR), d.doc_id, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, before,
       CASE WHEN target > 0 THEN (before + size)::DOUBLE / target END AS virtual_finish,
       (greatest(0, least(size, floor(target)::BIGINT - before))
        + greatest(0, least(size, floor(target)::BIGINT - source_size - before)))::BIGINT AS taken
FROM queued
"""
