"""The registered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import (
    classlm, decontaminate, divergence, golay, mixing, neardup, quality, secrets, sql, strassen,
    substrings, topk, toxicity, wrappers,
)
from pitchlake.llm.common import crc_mod, table


def op1_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page, by the wrapper of its host; NULL pages give an empty text."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return wrappers.digest(wrappers.extract(pages))


def op2_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share 80 per cent of their two-word shingles, over links."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document, from labels outside of the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(
        docs, table(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 5) != 0)
    score = F.col("__toxicity")
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside 13-word windows of benchmark items, and whose they are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(
        decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base spans of every document, and windows of high entropy beside them."""
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document outside of 20-word windows that also start earlier."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.digest(substrings.remove_repeats(docs))


def op7_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and class-model log probability of every document; a fifth of them is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classlm.score(
        docs.withColumn("held", F.coalesce(crc_mod(F.col("doc_id"), 5) == 1, F.lit(False))), "held")


def op8_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place in the mix for every document, sources by the square root of their sizes."""
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten rows with the largest inner product for every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.exact_top_k(vectors, vectors.where("vec_id % 100 = 0"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document, from labels outside of the held-out quarter."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), crc_mod(F.col("doc_id"), 4) != 2)
    score = F.col("__quality")
    return quality.score(docs, model).select(
        "doc_id", F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        score.alias("score"), (score >= 0.7).cast("int").alias("predicted"))


def op11_cube_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source of a language against its other sources, and the terms that set it apart."""
    return divergence.audit(
        table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


def op12_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and the groups that four bits or less join."""
    return golay.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_strassen_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, after the labels of every seventh moved by one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", label.alias("label"))
    return strassen.hard_negatives(vectors, vectors.where("vec_id % 50 = 0"))


QUERIES = {
    "op1_html_wrappers": op1_html_wrappers,
    "op2_odd_sketches": op2_odd_sketches,
    "op3_toxicity": op3_toxicity,
    "op4_decontaminate": op4_decontaminate,
    "op5_secrets": op5_secrets,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_class_lm": op7_class_lm,
    "op8_pfair_mix": op8_pfair_mix,
    "op9_topk": op9_topk,
    "op10_quality": op10_quality,
    "op11_cube_divergence": op11_cube_divergence,
    "op12_golay_simhash": op12_golay_simhash,
    "op13_strassen_negatives": op13_strassen_negatives,
}
SQL = sql.SQL
