"""Counts, coverage and the invariants a knowledge base is certified by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoloom.functions.rules import CATEGORY_DOMAINS, hard_soft_of
from taxoloom.functions.text import normalize_label
from taxoloom.operators import forest, graph
from taxoloom.session import Scratch, bare


def given(column: str) -> Column:
    return bare(column) != ""


def filled_counts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row: all rows, and for each column how many are not blank."""
    return rows.agg(F.count("*").alias("rows"), *[F.count_if(given(c)).alias(c) for c in columns])


def repeats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n): keys that occur more than once."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def multiplicity(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row: distinct keys, and rows beyond the first of each."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.count("*").alias("distinct_rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"))


def unique_mentions(rows: DataFrame, text: str, order: str) -> DataFrame:
    """(norm, surface, n): mentions by folded form, with the first spelling and the frequency."""
    folded = rows.withColumn("norm", normalize_label(text)).where("norm <> ''")
    return folded.groupBy("norm").agg(F.min_by(text, order).alias("surface"), F.count("*").alias("n"))


def coverage(rows: DataFrame, slices: list[str], exact: str, near: str) -> DataFrame:
    """Counts and percentages of exact, near and either, for each slice and for all."""
    agg = rows.rollup(*slices) if len(slices) == 1 else rows.groupingSets([tuple(F.col(s) for s in slices), ()], *slices)
    out = agg.agg(F.count("*").alias("n"), F.count_if(F.col(exact)).alias("exact"), F.count_if(F.col(near)).alias("near"), F.count_if(F.col(exact) | F.col(near)).alias("either"))
    return out.select(*[F.coalesce(F.col(s), F.lit("ALL")).alias(s) for s in slices], "n", "exact", "near", "either", *[F.round(100 * F.col(c) / F.col("n"), 1).alias(f"{c}_pct") for c in ("exact", "near", "either")])


def collapse(rows: DataFrame, cluster: str, node: str) -> DataFrame:
    """(cluster, resolved, nodes, collapsed): clusters with two resolved phrases; collapsed if they are one node."""
    known = rows.where(F.col(node).isNotNull()).groupBy(cluster).agg(F.count("*").alias("resolved"), F.countDistinct(node).alias("nodes"))
    return known.where("resolved >= 2").withColumn("collapsed", F.col("nodes") == 1)


def invariants(t: dict[str, DataFrame], in_scope: str = "^(25|35|133)") -> DataFrame:
    """(name, ok, n_violations) of the thirteen checks.

    Tables: occupations, skills, hierarchy, occupation_skill_relations, unified_skills and, if there, unified_occupations.
    Rows count as told, so a repeated link is two parents.  A loop counts once, however many nodes are on it.
    """
    occ, skl, rel = t["occupations"], t["skills"], t["occupation_skill_relations"]
    scratch = Scratch(occ.sparkSession, "invariants")
    edges = scratch.cut(t["hierarchy"].select(bare("parent_entity_id").alias("u"), bare("child_entity_id").alias("v"), F.lower(bare("relation_type")).alias("type"), F.lower(bare("entity_kind")).alias("kind")))
    ids = occ.select(F.col("entity_id").alias("node")).unionByName(skl.select(F.col("entity_id").alias("node")))
    nodes = ids.distinct()
    real_occ = occ.where("coalesce(occupation_type, '') <> 'isco_group'").select(F.col("entity_id").alias("node")).distinct()
    real_skl = skl.where(~F.coalesce("esco_skill_type", F.lit("")).isin("skill_type", "skill_domain", "skill_category")).select(F.col("entity_id").alias("node")).distinct()
    lacking = lambda rows, column, known: rows.join(known.withColumnRenamed("node", column), column, "left_anti").select(F.lit(1).alias("x"))
    parents = lambda kind, relation: edges.where((F.col("kind") == kind) & (F.col("type") == relation)).groupBy(F.col("v").alias("node")).agg(F.count("*").alias("n"))
    not_one = lambda universe, counts: universe.join(counts, "node", "left").where(F.coalesce("n", F.lit(0)) != 1).select(F.lit(1).alias("x"))
    back = edges.where("kind = 'occupation' and type = 'broader_than'")
    placed = scratch.cut(forest.resolve(back.where("u <> '' and v <> ''").groupBy(F.col("v").alias("node")).agg(F.min("u").alias("parent"))))
    roots = back.select("u").distinct().join(back.select(F.col("v").alias("u")).distinct(), "u", "left_anti")
    unified = t["unified_skills"].select("unified_id", "member_entity_ids")
    if "unified_occupations" in t:
        unified = unified.unionByName(t["unified_occupations"].select("unified_id", "member_entity_ids"))
    parts = unified.select("unified_id", F.filter(F.transform(F.split(F.coalesce("member_entity_ids", F.lit("")), "\\|"), lambda x: bare(x)), lambda x: x != "").alias("all"))
    members = parts.select("unified_id", F.explode("all").alias("node"))
    sub, hs = F.coalesce("it_subtype", F.lit("")), F.coalesce("hard_soft", F.lit(""))
    checks = {
        "edges_resolve": edges.join(nodes.select(F.col("node").alias("v"), F.lit(1).alias("has_v")), "v", "left").join(nodes.select(F.col("node").alias("u"), F.lit(1).alias("has_u")), "u", "left").where("has_u is null or has_v is null"),
        "no_self_loop": edges.where("u = v"),
        "acyclic": graph.cycle_members(edges.where("u <> '' and v <> ''")).limit(1),
        "one_category_per_skill": not_one(real_skl, parents("skill", "broader_than")),
        "one_backbone_and_domain_per_occupation": not_one(real_occ, parents("occupation", "broader_than")).unionByName(not_one(real_occ, parents("occupation", "in_domain"))),
        "occupations_reach_root": lacking(real_occ, "node", placed.where("cycle_state = 'none'").select(F.col("entity_id").alias("node"))),
        "groups_in_scope": occ.where("occupation_type = 'isco_group' and coalesce(isco_code, '') <> ''").where(~F.col("isco_code").rlike(in_scope)),
        "no_skill_over_skill": edges.join(real_skl.withColumnRenamed("node", "u"), "u", "left_semi").join(real_skl.withColumnRenamed("node", "v"), "v", "left_semi"),
        "hard_soft_matches": t["unified_skills"].where((hs == "") | (sub == "") | (hs != F.coalesce(hard_soft_of(sub), hs))),
        "relations_typed": lacking(rel, "occupation_entity_id", real_occ).unionByName(lacking(rel, "skill_entity_id", real_skl)),
        "members_valid": parts.where("size(all) = 0").select(F.lit(1).alias("x")).unionByName(lacking(members, "node", nodes)).unionByName(members.distinct().groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select(F.lit(1).alias("x"))),
        "ids_unique": repeats(ids, ["node"]).select(F.lit(1).alias("x")).unionByName(repeats(unified, ["unified_id"]).select(F.lit(1).alias("x"))),
        "relations_unique": repeats(rel, ["occupation_entity_id", "skill_entity_id", "relation_type", "source", "weight"]).select(F.explode(F.sequence(F.lit(2).cast("long"), F.col("n"))).alias("x")),
    }
    out = None
    for name, bad in checks.items():
        n = bad.agg(F.count("*").alias("n_violations"))
        if name == "occupations_reach_root":  # and there is one root
            n = n.crossJoin(roots.agg(F.count("*").alias("roots"))).select((F.col("n_violations") + F.abs(F.col("roots") - 1)).alias("n_violations"))
        row = n.select(F.lit(name).alias("name"), (F.col("n_violations") == 0).alias("ok"), "n_violations")
        out = row if out is None else out.unionByName(row)
    return out
