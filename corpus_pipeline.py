"""From raw documents to packed training sequences: five stages, each a Parquet table for the next.

`STAGES` lists (name, function); a function takes (spark, docs, folder of the tables) and returns a
frame.  All stages but the last return the columns of `documents`; further columns of the input are left
behind.  Nulls, empty texts, repeated rows and empty tables are treated as each operator says.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import jaccard, mixing, packing, pii, quality
from tablewright.session import materialize, ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    ship(spark)
    return quality.keep_good(docs.select(*COLUMNS))


def distinct(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document, the one with the least id, of each group of near duplicates; all that have none."""
    ship(spark)
    return jaccard.keep_one(docs.select(*COLUMNS))


def private(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts with personal data and secrets replaced by their kind; `n_chars` follows."""
    ship(spark)
    return pii.masked(docs.select(*COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix takes them, in its order; a last turn that is cut keeps its first words."""
    ship(spark)
    # rows are named by 128 bits of all their columns, null told from absent
    parts = [p for c in COLUMNS for p in (F.col(c).isNull(), F.col(c))]
    rows = docs.select(*COLUMNS, F.xxhash64(*parts).alias("one"), F.xxhash64(F.lit(10), *parts).alias("two"))
    # queues are made of narrow rows; texts meet them once, at the end
    sized = rows.select("doc_id", "one", "two", "source", mixing.word_count("text").alias("size"))
    turns = mixing.mix(mixing.served(materialize(sized, "sizes")), sort=False)
    turns = turns.select("one", "two", "size", "words", "virtual_finish", "turn")
    # a repeated row has turns of its own, and one text serves them all
    texts = rows.dropDuplicates(["one", "two"])
    served = turns.join(texts, ["one", "two"])
    cut = F.col("words") < F.col("size")
    text = F.when(cut, mixing.first_words("text", "words")).otherwise(F.col("text"))
    length = F.when(cut, F.length(text)).otherwise(F.col("n_chars")).cast("long")
    ordered = served.orderBy("virtual_finish", F.col("source").asc_nulls_last(), "turn", "doc_id", "one", "two")
    return ordered.select("doc_id", text.alias("text"), "lang", "source", length.alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of all pieces with their sequences and offsets."""
    ship(spark)
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.pieces(docs.select(*COLUMNS), tokenizer, keep_ids=True))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", good),
    ("jaccard_join", distinct),
    ("pii", private),
    ("mix_sources", mixed),
    ("pack", packed),
]

# Component search and a tokenizer are not SQL; tests hold each stage and the whole run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the last stage, over `documents`."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder), name)
    return STAGES[-1][1](spark, docs, folder)
