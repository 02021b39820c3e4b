"""The registered queries of the operators, with the SQL that checks them where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, ship
from . import collocations, dialogues, html_text, jaccard, language, mixing, neighbors, packing, pii, quality
from . import sentencepieces, substrings, toxicity
from .oracles import ORACLES

__all__ = ["QUERIES", "ORACLES"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str, table: str = "documents"):
    """Register a function of the query's main table, read whole."""

    def register(fn: Callable[..., DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return fn(spark.read.parquet(f"{folder}/{table}.parquet"), folder)

        QUERIES[name] = run
        return fn

    return register


TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
HELD_OUT = "pmod(crc32(cast(doc_id as string)), 3) = 1"


@query("op1_language_id")
def _op1(docs: DataFrame, folder: str) -> DataFrame:
    models = language.train(language.labelled_windows(docs))
    found = language.identify(docs, models)
    return found.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "lang_pred", "score", "bits")


@query("op9_toxicity")
def _op9(docs: DataFrame, folder: str) -> DataFrame:
    labels = docs.sparkSession.read.parquet(f"{folder}/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    predicted = (F.col("score") >= 0.7).cast("int")
    return scored.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "score", predicted.alias("predicted"))


@query("op2_pack")
def _op2(docs: DataFrame, folder: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, TOKENIZER))


@query("op3_pii")
def _op3(docs: DataFrame, folder: str) -> DataFrame:
    return pii.report(docs)


@query("op4_near_vectors", "embeddings")
def _op4(vectors: DataFrame, folder: str) -> DataFrame:
    found = neighbors.near_duplicates(vectors)
    kept = (F.col("id") == F.col("component")).alias("kept")
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), kept)


@query("op5_page_text", "pages")
def _op5(pages: DataFrame, folder: str) -> DataFrame:
    return html_text.extract(pages)


@query("op6_quality_rules")
def _op6(docs: DataFrame, folder: str) -> DataFrame:
    return quality.judged(docs)


@query("op7_jaccard_join")
def _op7(docs: DataFrame, folder: str) -> DataFrame:
    found = jaccard.similar_groups(docs)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


@query("op8_substring_dedup")
def _op8(docs: DataFrame, folder: str) -> DataFrame:
    left = substrings.without_repeats(docs)
    return left.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op10_mix_sources")
def _op10(docs: DataFrame, folder: str) -> DataFrame:
    sized = docs.select("doc_id", "source", mixing.word_count("text").alias("size"))
    queue = mixing.served(materialize(sized, "sizes"))
    return queue.drop("source").orderBy("virtual_finish", "doc_id")


@query("op11_collocations")
def _op11(docs: DataFrame, folder: str) -> DataFrame:
    return collocations.collocations(docs)


@query("op12_repair", "conversations")
def _op12(rows: DataFrame, folder: str) -> DataFrame:
    return dialogues.repaired(dialogues.damaged(rows))


@query("op13_sentencepiece")
def _op13(docs: DataFrame, folder: str) -> DataFrame:
    found = sentencepieces.encode(docs, PIECES)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
