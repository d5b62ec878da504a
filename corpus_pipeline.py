"""Documents to packed training sequences: five stages, each one operator over all that the stage before it kept.

Toxic documents and those without a recognised language go, one document of each group of near-duplicates stays, passages
that still occur more than once go, and what is left is packed. Every stage is written as Parquet in the cluster's shared
folder and read again, so that a lost executor never costs more than the stage at hand.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.llm import bpe, jaccard_join, language_id, packing, substring_dedup, toxicity
from curbside.llm.storage import held_out, ship_package, stage, table, whole_rows

TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity under TOXIC_FROM; empty and null texts are among them."""
    index = toxicity.fit(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    return toxicity.score_texts(whole_rows(docs), index, "row", "row.text").where(F.col("score") < TOXIC_FROM).select("row.*")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages. Null texts and those without a letter have none, and go."""
    model = language_id.fit(docs, ~held_out(F.col("doc_id")))
    return language_id.predict(whole_rows(docs), model, "row").where(F.col("lang_pred") != "und").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group that links of a similarity of 0.8 or more hold together."""
    return jaccard_join.keep_one_each(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of repeated windows; ``n_chars`` follows. A text may become empty."""
    found = substring_dedup.remove_repeats(whole_rows(docs, "text", "n_chars"), id_column="row")
    rows = found.select("row.*", F.col("kept_text").alias("text"), F.length("kept_text").cast("long").alias("n_chars"))
    return rows.select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 4096 tokens."""
    return packing.pack_documents(docs, bpe.read_definition(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_known_languages),
    ("jaccard_join", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("best_fit_packing", pack_sequences),
]

#: No stage is plain SQL: the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
