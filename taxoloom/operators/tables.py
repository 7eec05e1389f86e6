"""Keeping tables: replacing a source's rows, inserting what is absent, last writes, pruning, quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoloom.operators.lookup import first_by
from taxoloom.operators.similarity import top_per


def project(rows: DataFrame, fields: list[str]) -> DataFrame:
    """The listed fields, absent ones and nulls as ''."""
    return rows.select(*[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f) if f in rows.columns else F.lit("").alias(f) for f in fields])


def replace_source(old: DataFrame, new: DataFrame, source: str, name: str) -> DataFrame:
    """The table with one source's rows replaced by new ones, of which repeated rows are one."""
    return old.where(~F.col(source).eqNullSafe(name)).unionByName(new.dropDuplicates(), allowMissingColumns=True)


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The table with new rows of keys it lacks; of equal new ones any one."""
    return old.unionByName(new.dropDuplicates(keys).join(old.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def replace_pairs(old: DataFrame, new: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Pairs with a source on either side replaced."""
    return old.where(~F.col(a).eqNullSafe(name) & ~F.col(b).eqNullSafe(name)).unionByName(new, allowMissingColumns=True)


def replace_children(old: DataFrame, new: DataFrame, child: str, mine: Column | None = None) -> DataFrame:
    """Edges of the children at hand replaced, all others kept; or, where ``mine`` tells which rows are of this kind, all of that kind."""
    if mine is not None:
        return old.where(~F.coalesce(mine, F.lit(False))).unionByName(new)
    return old.join(new.select(child).distinct(), child, "left_anti").select(*old.columns).unionByName(new)


def last_write(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key: a combinable aggregate."""
    value = F.struct(*[F.col(c) for c in rows.columns])
    return rows.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias("_last")).select("_last.*")


def first_write(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return first_by(rows, keys, order)


def without_source(tables: dict[str, DataFrame], name: str) -> dict[str, DataFrame]:
    """Entity, relation and pair tables without a source and without what referred to its entities."""
    out = dict(tables)
    gone = None
    for t in ("occupations", "skills"):
        ids = tables[t].where(F.col("source") == name).select("entity_id")
        gone = ids if gone is None else gone.unionByName(ids)
        out[t] = tables[t].where(F.coalesce(F.col("source"), F.lit("")) != name)
    kept = out["occupations"].select("entity_id").unionByName(out["skills"].select("entity_id")).distinct()
    only_gone = gone.distinct().join(kept, "entity_id", "left_anti")
    for t, ends in (("occupation_skill_relations", ("occupation_entity_id", "skill_entity_id")), ("hierarchy", ("parent_entity_id", "child_entity_id")), ("concept_alignments", ("entity_id_a", "entity_id_b"))):
        rows = tables[t]
        if "source" in rows.columns:
            rows = rows.where(F.coalesce(F.col("source"), F.lit("")) != name)
        else:
            rows = rows.where((F.coalesce(F.col("source_a"), F.lit("")) != name) & (F.coalesce(F.col("source_b"), F.lit("")) != name))
        for end in ends:
            rows = rows.join(only_gone.withColumnRenamed("entity_id", end), end, "left_anti")
        out[t] = rows.select(*tables[t].columns)
    return out


def pending(targets: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Targets that no kept result covers."""
    return targets.join(done.select(*keys).distinct(), keys, "left_anti")


def quota(rows: DataFrame, branch: str, order: list[Column], per_branch: int, total: int) -> DataFrame:
    """The first rows of each branch up to a quota, and of these the first in all; for lists the quota itself bounds."""
    return top_per(rows, [branch], order, per_branch).orderBy(*order).limit(total)


def enriched(rows: DataFrame, key: str, field: str, sources: list[tuple[str, DataFrame]], native: str = "source") -> DataFrame:
    """A field filled, only where blank, from the first of several tables that has it; ``<field>_source`` tells which."""
    given = F.nullif(F.trim(F.coalesce(F.col(field), F.lit(""))), F.lit(""))
    out = rows.withColumn("_0", given)
    value, origin = F.col("_0"), F.when(F.col("_0").isNotNull(), native)
    for n, (name, table) in enumerate(sources, 1):
        one = table.where(F.trim(F.coalesce(F.col(field), F.lit(""))) != "").groupBy(key).agg(F.min(F.trim(field)).alias(f"_{n}"))
        out = out.join(one, key, "left")
        value, origin = F.coalesce(value, F.col(f"_{n}")), origin.when(F.col(f"_{n}").isNotNull(), name)
    out = out.withColumn(field, F.coalesce(value, F.lit(""))).withColumn(f"{field}_source", F.coalesce(origin, F.lit("")))
    return out.drop(*[f"_{n}" for n in range(len(sources) + 1)])
