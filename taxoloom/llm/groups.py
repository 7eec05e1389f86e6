"""Consolidating pairwise matches into groups by seed-tree pruning.

Each round has two steps.  Selection: every vertex tells its neighbours and itself the smallest id around it, so a vertex
gets the set of minima of its neighbourhood.  Pruning: these minima are linked with the smallest of them and go into the
next round; a vertex that is nobody's minimum drops out and hangs under its smallest one in the propagation forest.
The graph shrinks fast, the last vertices are the seeds, each the smallest id of its group.  The seeds' ids then flow
down the forest, from the round in which a vertex dropped out last to the first.

Hot vertices: the minimum is a combinable aggregate, and the other steps are joins of edges with one row per vertex, so
a hub's edges may be split among tasks.  A list of members is a star around its smallest, never all pairs.

Blank or null ends, self-pairs and repeated pairs add nothing; only ids in a group of two or more come out.  An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxoloom.session import Scratch, bare


def merge_pairs(rows: DataFrame, a: str, b: str, flag: str, accepted: tuple[str, ...] = ("label", "semantic")) -> DataFrame:
    """(u, v) of the rows whose flag, case and blanks aside, is an accepted one and whose ends are both given."""
    return rows.where(F.lower(bare(flag)).isin(*accepted)).select(bare(a).alias("u"), bare(b).alias("v")).where("u <> '' and v <> ''")


def members(column: str, sep: str = "\\|") -> F.Column:
    """The distinct, non-blank entries of a list in a string."""
    parts = F.transform(F.split(F.coalesce(F.col(column), F.lit("")), sep), lambda x: bare(x))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def list_pairs(rows: DataFrame, column: str, sep: str = "\\|") -> DataFrame:
    """(u, v): a star around the smallest entry of every list."""
    entries = rows.select(members(column, sep).alias("all")).where("size(all) > 1")
    return entries.select(F.array_min("all").alias("u"), F.explode("all").alias("v")).where("u <> v")


def groups(pairs: DataFrame) -> DataFrame:
    """(entity_id, group_id) of every id linked with another, directly or through others; the id of a group is its smallest."""
    scratch = Scratch(pairs.sparkSession, "groups")
    sound = pairs.where("u <> v").select("u", "v")
    edges = scratch.cut(sound.unionByName(sound.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    trees: list[DataFrame] = []
    while True:
        near = edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        told = edges.join(near, "u").select("v", "low")
        heard = scratch.cut(told.unionByName(near.select(F.col("u").alias("v"), "low")).distinct())
        least = heard.groupBy("v").agg(F.min("low").alias("root"), F.max(F.col("low") == F.col("v")).alias("stays"))
        trees.append(scratch.cut(least.where("not stays").select("v", F.col("root").alias("up"))))
        kept = heard.join(least, "v").where("low <> root").select(F.col("low").alias("u"), F.col("root").alias("v"))
        new = scratch.cut(kept.unionByName(kept.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
        scratch.drop(edges)
        scratch.drop(heard)
        edges = new
        if edges.isEmpty():
            break
    named = None
    for tree in reversed(trees):
        if named is None:
            part = tree.select("v", F.col("up").alias("group_id"))
        else:
            above = named.select(F.col("v").alias("up"), "group_id")
            part = tree.join(above, "up", "left").select("v", F.coalesce("group_id", "up").alias("group_id"))
        part = scratch.cut(part)
        named = part if named is None else named.unionByName(part)
    seeds = named.select(F.col("group_id").alias("v"), "group_id").distinct()
    return named.unionByName(seeds).select(F.col("v").alias("entity_id"), "group_id")
