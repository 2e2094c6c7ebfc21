"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again for the next.

Every stage takes all rows its predecessor kept, and each handles nulls in any column, empty and very long texts,
repeated rows, empty tables and further columns as its operator's docstring says. All but the last return the columns
they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstar.llm import bpe, langid, mixing, secret_scan, simhash
from snapstar.llm.common import materialize, prepare, table, word_count
from snapstar.llm.queries import VOCABULARY, held_out


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised, or all with letters if no labelled one teaches any; ``lang`` stays as it was."""
    prepare(spark)
    model = langid.fit(docs.filter(~held_out()), "text", "lang")
    return docs.filter(~langid.predict_column(F.col("text"), model)["rejected"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the least doc_id."""
    prepare(spark)
    return simhash.keep_one(docs, "doc_id", "text")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with secrets replaced in its text and ``n_chars`` counted anew where that changed it."""
    prepare(spark)
    both = docs.withColumn("text", F.struct(F.col("text").alias("old"), secret_scan.redact_column(F.col("text")).alias("new")))
    changed = F.col("n_chars").isNotNull() & (F.col("text.new") != F.col("text.old"))
    counted = F.length("text.new").cast(docs.schema["n_chars"].dataType)
    return both.withColumn("n_chars", F.when(changed, counted).otherwise(F.col("n_chars"))).withColumn("text", F.col("text.new"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come near their targets."""
    prepare(spark)
    # Texts ride along in one column, so no name of the table can meet a name of the plan.
    packed = docs.select(F.col("doc_id").alias("id"), F.col("source").alias("src"), word_count(F.col("text")).alias("words"),
                         F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("document"))
    return mixing.emit(mixing.plan_mix(packed, "words", "src", "id")).select("document.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document."""
    prepare(spark)
    coded = docs.select("doc_id", "lang", "source", bpe.encode_column(F.col("text"), public_tokenizers.path(VOCABULARY)).alias("b"))
    return coded.select("doc_id", "lang", "source", F.size("b.ids").cast("long").alias("n_tokens"), F.col("b.ids").alias("ids"), "b.decoded")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mix", mix), ("tokens", tokens)]
# Language models, fingerprints and token merges have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = before = materialize(docs, f"pipeline-{name}", instead_of=before)
    return docs
