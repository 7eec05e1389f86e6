"""Queries on references and hierarchies of the knowledge base."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxoloom.operators import forest, orphans
from taxoloom.session import Scratch, load


def _changes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    fields = {"occupation_entity_id": "occupations", "skill_entity_id": "skills"}
    relations = load(spark, d, "occupation_skill_relations").select("rel_id", "retrieved_at", *fields)
    audits = load(spark, d, "link_audit").select("audit_id", "audited_at", *fields)
    references = orphans.reference_rows(relations, "occupation_skill_relations", "rel_id", "retrieved_at", fields).unionByName(
        orphans.reference_rows(audits, "link_audit", "audit_id", "audited_at", fields)
    )
    existence = None
    for table in ("occupations", "skills"):
        part = orphans.existence_deltas(load(spark, d, table), table, "entity_id", "retrieved_at", "deleted_at")
        existence = part if existence is None else existence.unionByName(part)
    return references, existence


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    rows = orphans.orphan_rows(*_changes(spark, d))
    return rows.dropDuplicates(["table_name", "row_id", "field_name"]).select("table_name", "row_id", "field_name", "reason")


def p1_monthly(spark: SparkSession, d: str) -> DataFrame:
    """Orphans per table, month and reason."""
    rows = orphans.orphan_rows(*_changes(spark, d)).dropDuplicates(["table_name", "row_id", "field_name"])
    return rows.groupBy("table_name", F.date_format("at", "yyyy-MM").alias("month"), "reason").agg(F.count("*").alias("orphans"))


def p1_current(spark: SparkSession, d: str) -> DataFrame:
    """Keys with references and, all deltas counted, no existence."""
    references, existence = _changes(spark, d)
    unique = references.dropDuplicates(["table_name", "row_id", "field_name"])
    return orphans.orphan_keys(orphans.merge_state(existence, unique))


def p1_batches(spark: SparkSession, d: str) -> DataFrame:
    """As ``p1_current``, with the changes of audits and of relations folded into the kept state one after the other."""
    references, existence = _changes(spark, d)
    unique = references.dropDuplicates(["table_name", "row_id", "field_name"])
    scratch = Scratch(spark, "state")
    first = scratch.cut(orphans.merge_state(existence.where("domain = 'skills'"), unique.where("table_name = 'link_audit'")))
    return orphans.orphan_keys(orphans.merge_state(existence.where("domain = 'occupations'"), unique.where("table_name <> 'link_audit'"), first))


def _links(spark: SparkSession, d: str) -> DataFrame:
    return forest.directed_links(load(spark, d, "hierarchy"), "parent_entity_id", "child_entity_id", "relation_type")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return forest.resolve_all(load(spark, d, "hierarchy"), "parent_entity_id", "child_entity_id", "relation_type")


def p6_paths(spark: SparkSession, d: str) -> DataFrame:
    rows = forest.paths(_links(spark, d))
    return rows.select("entity_id", "root_entity_id", "depth", F.array_join("path", " > ").alias("path"))


def p6_descendants(spark: SparkSession, d: str) -> DataFrame:
    return forest.descendants(forest.paths(_links(spark, d)))


QUERIES = {f.__name__: f for f in (p1_found, p1_monthly, p1_current, p1_batches, p6_found, p6_paths, p6_descendants)}

_REFS = """
refs as (
  select 'occupation_skill_relations' as table_name, rel_id as row_id, 'occupation_entity_id' as field_name, 'occupations' as domain, upper(trim(occupation_entity_id)) as key, retrieved_at as at from occupation_skill_relations
  union select 'occupation_skill_relations', rel_id, 'skill_entity_id', 'skills', upper(trim(skill_entity_id)), retrieved_at from occupation_skill_relations
  union select 'link_audit', audit_id, 'occupation_entity_id', 'occupations', upper(trim(occupation_entity_id)), audited_at from link_audit
  union select 'link_audit', audit_id, 'skill_entity_id', 'skills', upper(trim(skill_entity_id)), audited_at from link_audit),
recs as (
  select 'occupations' as domain, upper(trim(entity_id)) as key, min(retrieved_at) as born, min(deleted_at) as gone from occupations group by 1, 2
  union all select 'skills', upper(trim(entity_id)), min(retrieved_at), min(deleted_at) from skills group by 1, 2),
judged as (
  select r.*, case when c.key is null then 'missing' when c.gone <= r.at then 'deleted' when c.born > r.at then 'late' end as reason
  from refs r left join recs c on r.domain = c.domain and r.key = c.key where coalesce(r.key, '') <> '')
"""
_LINKS = """
raw as (
  select lower(trim(relation_type)) as kind, trim(parent_entity_id) as a, trim(child_entity_id) as b from hierarchy),
links as (
  select case when kind = 'broader_than' then b else a end as node, min(case when kind = 'broader_than' then a else b end) as parent
  from raw where kind in ('broader_than', 'narrower_than') and coalesce(a, '') <> '' and coalesce(b, '') <> '' group by 1),
down as (
  select parent as node, parent as root, 0 as depth, parent as path from links where parent not in (select node from links)
  union select l.node, d.root, d.depth + 1, d.path || ' > ' || l.node from links l join down d on l.parent = d.node)
"""
SQL = {
    "p1_found": f"with {_REFS} select table_name, row_id, field_name, reason from judged where reason is not null",
    "p1_monthly": f"with {_REFS} select table_name, strftime(judged.at, '%Y-%m') as month, reason, count(*) as orphans from judged where reason is not null group by 1, 2, 3",
    "p1_current": f"""with {_REFS} select r.domain, r.key, count(*) as refs, cast(coalesce(max(case when c.key is null then 0 when c.gone is null then 1 else 0 end), 0) as bigint) as exists
      from refs r left join recs c on r.domain = c.domain and r.key = c.key where coalesce(r.key, '') <> '' group by 1, 2 having exists <= 0""",
    "p6_found": f"""with recursive {_LINKS},
      up as (select node as start, parent as here, 1 as n from links where node not in (select node from down)
        union all select u.start, l.parent, n + 1 from up u join links l on u.here = l.node where n < 200)
      select node as entity_id, root as root_entity_id, cast(depth as int) as depth, 'none' as cycle_state from down
      union all select start, '', cast(-1 as int), case when bool_or(here = start) then 'on' else 'below' end from up group by start""",
    "p6_paths": f"with recursive {_LINKS} select node as entity_id, root as root_entity_id, cast(depth as int) as depth, path from down",
    "p6_descendants": f"""with recursive {_LINKS},
      pairs as (select parent as entity_id, node as descendant_id, 1 as distance from links where node in (select node from down)
        union all select l.parent, p.descendant_id, p.distance + 1 from pairs p join links l on p.entity_id = l.node)
      select entity_id, descendant_id, cast(distance as int) as distance from pairs""",
}
SQL["p1_batches"] = SQL["p1_current"]
