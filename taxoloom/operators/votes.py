"""Values chosen by vote, with ties decided by rule.

A vote is a count per value and a minimum over an ordering struct: two combinable aggregates, whatever the group's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoloom.functions.text import normalize_label


def _vote(counts: DataFrame, keys: list[str], out: str, order: Column) -> DataFrame:
    return counts.groupBy(*keys).agg(F.min_by("_v", order).alias(out))


def majority(rows: DataFrame, keys: list[str], value: str, longest: bool = False) -> DataFrame:
    """The most frequent non-blank value; of equal ones the shortest (or longest), then the smallest."""
    given = rows.select(*keys, F.trim(F.coalesce(F.col(value), F.lit(""))).alias("_v")).where("_v <> ''")
    counts = given.groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
    size = F.length("_v") * (-1 if longest else 1)
    return _vote(counts, keys, value, F.struct(-F.col("_n"), size, F.col("_v")))


def consensus_label(rows: DataFrame, keys: list[str], label: str, fallback: str | None = None) -> DataFrame:
    """The folded label with most votes (of equal ones the smallest), in its shortest, then smallest spelling.

    Groups without such a label take it from ``fallback``.
    """

    def one(column: str) -> DataFrame:
        given = rows.select(*keys, F.trim(F.coalesce(F.col(column), F.lit(""))).alias("_v")).withColumn("_f", normalize_label("_v")).where("_f <> ''")
        forms = given.groupBy(*keys, "_f").agg(F.count("*").alias("_n"), F.min(F.struct(F.length("_v").alias("l"), F.col("_v").alias("v"))).alias("_s"))
        return forms.groupBy(*keys).agg(F.min_by("_s.v", F.struct(-F.col("_n"), F.col("_f"))).alias("_label"))

    best = one(label)
    if fallback is None:
        return best.withColumnRenamed("_label", label)
    second = one(fallback).withColumnRenamed("_label", "_second")
    return best.join(second, keys, "full").select(*keys, F.coalesce("_label", "_second").alias(label))


def other_labels(rows: DataFrame, keys: list[str], labels: str, order: str, primary: DataFrame, sep: str = " | ") -> DataFrame:
    """All distinct labels of a group in order of appearance, the primary one aside, as one text."""
    long = rows.select(*keys, F.col(order).alias("_o"), F.posexplode(labels).alias("_p", "_v")).withColumn("_v", F.trim("_v")).where("_v <> ''")
    unique = long.groupBy(*keys, "_v").agg(F.min(F.struct("_o", "_p")).alias("_at"))
    kept = unique.join(primary.withColumnRenamed("primary", "_primary"), keys, "left").where("_primary is null or _v <> _primary")
    return kept.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_v"))), lambda x: x["_v"]), sep).alias("labels"))


def sorted_list(rows: DataFrame, keys: list[str], value: str, out: str, sep: str = " | ") -> DataFrame:
    """Distinct values, sorted, as one text."""
    return rows.where(F.col(value).isNotNull()).select(*keys, value).distinct().groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(F.col(value).cast("string"))), sep).alias(out))


def component_ids(members: DataFrame, group: str, member: str, prefix: str) -> DataFrame:
    """(group, unified_id): prefix and 12 hex digits of the SHA-1 of the sorted members joined by bars."""
    return sorted_list(members, [group], member, "members", "|").select(group, F.concat(F.lit(prefix), F.substring(F.sha1("members"), 1, 12)).alias("unified_id"))
