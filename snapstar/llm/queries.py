"""The queries of this subpackage: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, clustering, langid, licenses, minhash, mixing, neighbours, passages, prefix_trie, quality, secret_scan, sharding, simhash
from .common import materialize, prepare, table, word_count

Query = Callable[[SparkSession, str], DataFrame]
SHARDS = 24
VOCABULARY = "word_bpe_49k.json"
HELD_OUT = 5


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 24 equal shards by key, and where one more shard would put them."""
    docs = table(prepare(spark), sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    sharded = sharding.shard_table(docs, "doc_id", [1.0] * SHARDS, [1.0], ["size", "text_crc32"])
    return sharded.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th one."""
    vectors = table(prepare(spark), sf_dir, "embeddings")
    found = neighbours.search(vectors, "vec_id", "embedding", lambda i: i % 20 == 0, k=20)
    return found.select("query_id", "rank", "vec_id", "score")


def held_out(doc_id: str = "doc_id"):
    """Documents kept from learning."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the documents that aren't held out."""
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = langid.fit(docs.filter(~F.col("held_out")), "text", "lang")
    told = docs.select("doc_id", "held_out", langid.predict_column(F.col("text"), model).alias("p"))
    return told.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.cross_entropy", "p.rejected")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    docs = table(prepare(spark), sf_dir, "documents")
    found = docs.select("doc_id", secret_scan.scan_column(F.col("text")).alias("s"))
    return found.select("doc_id", "s.n_assign", "s.n_access", "s.n_hex", "s.base_sha256", "s.spans", "s.n_named")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    docs = table(prepare(spark), sf_dir, "documents")
    coded = docs.select("doc_id", bpe.digest_column(F.col("text"), public_tokenizers.path(VOCABULARY)).alias("b"))
    return coded.select("doc_id", "b.n_tokens", "b.ids_sha256", "b.decoded_sha256")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document the mix takes."""
    # Stored without the texts, so that words are counted once for sums and rows.
    docs = materialize(table(prepare(spark), sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    plan = mixing.plan_mix(docs, "size", "source", "doc_id")
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 50 words and more that an earlier one holds."""
    left = passages.remove_repeats(table(prepare(spark), sf_dir, "documents"), "doc_id", "text")
    return left.select(F.col("key").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and near-duplicate group of every document."""
    groups = simhash.near_duplicates(table(prepare(spark), sf_dir, "documents"), "doc_id", "text")
    return groups.select(F.col("doc_key").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licence texts and notices of every document: one row for each licence found, with where and how often."""
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan(docs, "doc_id", "text", licenses.known_digests(spark))
    return found.groupBy("doc_id", "license").agg(
        F.max(F.col("scope") == "text").alias("whole_text"), F.count(F.when(F.col("scope") == "line", 1)).alias("n_lines"),
        F.min("line_no").alias("first_line"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures of every document and the verdict of thresholds by language and source."""
    docs = table(prepare(spark), sf_dir, "documents")
    return quality.apply_rules(docs, "text", "lang", "source", ["doc_id"])


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document by similarity 0.8 of word pairs."""
    groups = minhash.near_duplicates(table(prepare(spark), sf_dir, "documents"), "doc_id", "text")
    return groups.select(F.col("doc_key").alias("doc_id"), "n_shingles", "component_id",
                         F.col("doc_key").eqNullSafe(F.col("component_id")).alias("kept"))


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster after ten rounds over eight centroids."""
    found = clustering.cluster(table(prepare(spark), sf_dir, "embeddings"), "vec_id", "embedding")
    return found.withColumnRenamed("id", "vec_id")


def op13_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each with the opening of the first of its hundred."""
    coded = prefix_trie.code_turns(table(prepare(spark), sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    opening = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    shared = prefix_trie.share_openings(coded, opening, F.col("conv_id") - F.col("conv_id") % 100, 6)
    return prefix_trie.prefix_trie(shared)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` over the documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_sharding, op2_neighbours, op3_language, op4_secrets, op5_bpe, op6_mixing, op7_passages, op8_simhash, op9_licenses,
    op10_quality, op11_minhash, op12_clusters, op13_prefixes, pipeline)}
