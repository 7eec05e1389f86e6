"""Demand: how often roles ask for skills, from weights, postings, tokens and texts.

Every variant is one or two combinable aggregates.  Where several postings' tokens stand for one skill it matters what
is made distinct before counting, and whether a floor is set before or after tokens are resolved; both are parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoloom.functions.text import whole_at_least_one


def weighted(rows: DataFrame, role: str, skill: str, positions: str) -> DataFrame:
    """(role, skill, weight): positions summed, each at least one."""
    return rows.groupBy(role, skill).agg(F.sum(whole_at_least_one(F.col(positions).cast("string"))).alias("weight"))


def per_posting(rows: DataFrame, posting: str, role: str, skill: str, floor: int = 1) -> DataFrame:
    """(role, skill, weight): postings that name the skill, each once."""
    return rows.select(posting, role, skill).distinct().groupBy(role, skill).agg(F.count("*").alias("weight")).where(F.col("weight") >= floor)


def per_token(rows: DataFrame, posting: str, role: str, token: str, index: DataFrame, floor: int = 1) -> DataFrame:
    """(role, entity, weight): distinct tokens of postings, so two tokens of one skill count twice."""
    unique = rows.select(posting, role, F.col(token).alias("key")).distinct()
    return unique.join(index, "key").groupBy(role, "entity").agg(F.count("*").alias("weight")).where(F.col("weight") >= floor)


def resolved_counts(rows: DataFrame, posting: str, role: str, token: str, index: DataFrame, before: int = 1, after: int = 1) -> DataFrame:
    """(role, entity, weight): counts per token, floored, resolved, summed, floored."""
    counts = rows.select(posting, role, F.col(token).alias("key")).distinct().groupBy(role, "key").agg(F.count("*").alias("n")).where(F.col("n") >= before)
    return counts.join(index, "key").groupBy(role, "entity").agg(F.sum("n").alias("weight")).where(F.col("weight") >= after)


def frequent_absent(tokens: DataFrame, doc: str, token: str, index: DataFrame, floor: int, key: Column | None = None) -> DataFrame:
    """(token, docs): tokens in at least ``floor`` documents that the index lacks."""
    counts = tokens.select(doc, F.col(token).alias("token")).distinct().groupBy("token").agg(F.count("*").alias("docs")).where(F.col("docs") >= floor)
    return counts.withColumn("key", F.col("token") if key is None else key).join(index.select("key"), "key", "left_anti").select("token", "docs")


def modal(rows: DataFrame, owner: str, value: str, first_seen: str) -> DataFrame:
    """(owner, value, n): the most frequent value, of equal ones the first seen."""
    counts = rows.groupBy(owner, value).agg(F.count("*").alias("n"), F.min(first_seen).alias("seen"))
    return counts.groupBy(owner).agg(F.min_by(F.struct(value, "n"), F.struct(-F.col("n"), "seen", value)).alias("x")).select(owner, f"x.{value}", "x.n")
