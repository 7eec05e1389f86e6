"""Queries on the documents: packing, leaked test passages, abusive language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxoloom.llm import abuse, leakage, packing
from taxoloom.session import load


def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    sizes = packing.token_counts(load(spark, d, "documents"), "doc_id", "text")
    return packing.pack(sizes, load(spark, d, "pack_sizes").select("size_id", "capacity_tokens"), "doc_id")


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers and share of their space in use, per capacity."""
    boxes = load(spark, d, "pack_sizes")
    used = p8_packed(spark, d).groupBy("size_id").agg(F.sum("n_tokens").alias("tokens"), F.countDistinct("shard", "container").alias("containers"))
    return used.join(boxes, "size_id").select("size_id", "purpose", "containers", "tokens", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 4).alias("fill"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(load(spark, d, "documents"), load(spark, d, "eval_items")).select("doc_id", "item_id")


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """Leaked documents and longest run per test item."""
    rows = leakage.leaks(load(spark, d, "documents"), load(spark, d, "eval_items"))
    return rows.groupBy("item_id").agg(F.countDistinct("doc_id").alias("docs"), F.max("run_words").alias("longest_run"))


ABUSIVE_FROM = 0.5


def _scored(spark: SparkSession, d: str) -> DataFrame:
    documents = load(spark, d, "documents").select("doc_id", "text", "source")
    model = abuse.train(documents, load(spark, d, "doc_labels"), "doc_id", "text", "abusive", "annotator")
    return abuse.score(documents, model, "text").select("doc_id", "source", "score")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).where(F.col("score") >= ABUSIVE_FROM).select("doc_id")


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("doc_id", F.round("score", 4).alias("score"))


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    """Documents, abusive documents and their share per source."""
    abusive = F.count_if(F.col("score") >= ABUSIVE_FROM)
    return _scored(spark, d).groupBy("source").agg(F.count("*").alias("docs"), abusive.alias("abusive"), F.round(abusive / F.count("*"), 4).alias("rate"))


QUERIES = {f.__name__: f for f in (p8_packed, p8_fill, p9_found, p9_items, p10_found, p10_scores, p10_rates)}
SQL: dict[str, str] = {}
