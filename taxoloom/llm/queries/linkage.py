"""Queries on groups of duplicates, their survivors and labels that print alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxoloom.llm import entities, entries, groups, lookalike, survivor
from taxoloom.session import Scratch, load

FIELDS = ("primary_label_en", "hard_soft", "it_subtype", "sources")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    told = groups.merge_pairs(load(spark, d, "concept_alignments"), "entity_id_a", "entity_id_b", "merge_flag")
    return told.unionByName(groups.list_pairs(load(spark, d, "unified_skills"), "member_entity_ids"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return groups.groups(_pairs(spark, d))


def p2_sizes(spark: SparkSession, d: str) -> DataFrame:
    """How many groups there are of each size."""
    sizes = groups.groups(_pairs(spark, d)).groupBy("group_id").agg(F.count("*").alias("members"))
    return sizes.groupBy("members").agg(F.count("*").alias("groups"))


def _votes(spark: SparkSession, d: str) -> DataFrame:
    rows = load(spark, d, "unified_skills").select("unified_id", "member_entity_ids", "built_at", *FIELDS)
    # all members of a list are in one group, so its smallest finds it
    keyed = rows.withColumn("entity_id", F.array_min(groups.members("member_entity_ids"))).drop("member_entity_ids")
    placed = Scratch(spark, "placed").cut(keyed.join(groups.groups(_pairs(spark, d)), "entity_id"))
    several = placed.groupBy("group_id").agg(F.min("unified_id").alias("low"), F.max("unified_id").alias("high")).where("low <> high").select("group_id")
    return survivor.long_votes(placed.join(several, "group_id", "left_semi"), load(spark, d, "source_trust"), FIELDS, "unified_id", "sources", "built_at")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    won = survivor.best_row(_votes(spark, d), by_breadth=("sources",))
    return won.select("group_id", "field_name", F.col("row_id").alias("unified_id"))


def p3_golden(spark: SparkSession, d: str) -> DataFrame:
    """The surviving record of each group."""
    return survivor.wide(survivor.best_row(_votes(spark, d), by_breadth=("sources",)), FIELDS)


def p3_consensus(spark: SparkSession, d: str) -> DataFrame:
    """The value of each field with the most trust in total."""
    return survivor.consensus(_votes(spark, d)).select("group_id", "field_name", "value", F.round("votes", 4).alias("votes"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    parts = (("skills", "pref_label_fr"), ("occupations", "pref_label_en"))
    found = [
        lookalike.alike_pairs(load(spark, d, t), "entity_id", c).select(F.lit(t).alias("table_name"), "entity_id_a", "entity_id_b") for t, c in parts
    ]
    return found[0].unionByName(found[1])


def p4_labels(spark: SparkSession, d: str) -> DataFrame:
    """Every label in its one form."""
    skills = load(spark, d, "skills").select(F.lit("skills").alias("table_name"), "entity_id", lookalike.canonical_text("pref_label_fr").alias("label"))
    jobs = load(spark, d, "occupations").select(F.lit("occupations").alias("table_name"), "entity_id", lookalike.canonical_text("pref_label_en").alias("label"))
    return skills.unionByName(jobs).where("label is not null").distinct()


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every record whose label is spelled in several ways, with its class and its number of links."""
    parts = (("skills", "pref_label_fr"), ("occupations", "pref_label_en"))
    a, b = [lookalike.alike_classes(load(spark, d, t), "entity_id", c).withColumn("table_name", F.lit(t)) for t, c in parts]
    return a.unionByName(b)


QUERIES = {f.__name__: f for f in (p2_found, p2_sizes, p3_found, p3_golden, p3_consensus, p4_found, p4_labels, p4_classes)}

_GROUPS = """
m as (select distinct unified_id, trim(e) as e from (select unified_id, unnest(string_split(member_entity_ids, '|')) as e from unified_skills) where trim(e) <> ''),
e0 as (
  select trim(entity_id_a) as a, trim(entity_id_b) as b from concept_alignments
  where lower(trim(merge_flag)) in ('label', 'semantic') and coalesce(trim(entity_id_a), '') <> '' and coalesce(trim(entity_id_b), '') <> ''
  union select x.e, y.e from m x join m y on x.unified_id = y.unified_id),
ed as (select a, b from e0 where a <> b union select b, a from e0 where a <> b),
reach as (select a, b from ed union select r.a, e.b from reach r join ed e on r.b = e.a),
grp as (select a as entity_id, least(a, min(b)) as group_id from reach group by a)
"""
_WON = """
tell as (select v, lower(trim(replace(v, chr(160), ' '))) as t from (select distinct v from (
    select unnest([primary_label_en, hard_soft, it_subtype, sources]) as v from unified_skills union all
    select trim(unnest(regexp_split_to_array(sources, '[|,;]'))) from unified_skills))
  where regexp_matches(v, '[A-Za-z0-9]') and not regexp_matches(upper(v), '^(U?(OCC|SKL)|SKT|SKD|SKC)_[0-9A-F]{12}$')
    and lower(trim(replace(v, chr(160), ' '))) not in ('n/a', '#n/a', 'none', 'null', 'unknown', '(empty)', 'tbd', 'to be defined', 'sans objet')),
rows_ as (select distinct u.unified_id, g.group_id, u.built_at, u.primary_label_en, u.hard_soft, u.it_subtype, u.sources
  from unified_skills u join m using (unified_id) join grp g on g.entity_id = m.e),
big as (select group_id from rows_ group by 1 having count(distinct unified_id) > 1),
named as (select distinct unified_id, upper(trim(s)) as source from (select unified_id, unnest(regexp_split_to_array(sources, '[|,;]')) as s from unified_skills) where trim(s) in (select v from tell)),
best as (select n.unified_id, min(t.trust_rank) as rank, count(distinct n.source) as breadth from named n left join source_trust t on n.source = upper(t.source) group by 1),
long as (select group_id, unified_id, built_at, unnest(['primary_label_en', 'hard_soft', 'it_subtype', 'sources']) as field_name, unnest([primary_label_en, hard_soft, it_subtype, sources]) as value
  from rows_ where group_id in (select group_id from big)),
ranked as (select l.*, row_number() over (partition by l.group_id, field_name order by case when field_name = 'sources' then -b.breadth else coalesce(b.rank, 999) end, built_at desc, l.unified_id) as n
  from long l left join best b using (unified_id) where value in (select v from tell))
"""
SQL = {
    "p2_found": f"with recursive {_GROUPS} select entity_id, group_id from grp",
    "p2_sizes": f"with recursive {_GROUPS} select members, count(*) as groups from (select group_id, count(*) as members from grp group by 1) group by 1",
    "p3_found": f"with recursive {_GROUPS}, {_WON} select group_id, field_name, unified_id from ranked where n = 1",
    "p3_golden": f"""with recursive {_GROUPS}, {_WON} select group_id, max(value) filter (field_name = 'primary_label_en') as primary_label_en, max(value) filter (field_name = 'hard_soft') as hard_soft,
      max(value) filter (field_name = 'it_subtype') as it_subtype, max(value) filter (field_name = 'sources') as sources from ranked where n = 1 group by 1""",
    "p3_consensus": f"""with recursive {_GROUPS}, {_WON},
      cast_ as (select l.*, lower(regexp_replace(trim(replace(value, chr(160), ' ')), '\\s+', ' ', 'g')) as norm, coalesce(pow(4.0, -b.rank), 0.0) as trust,
        1 / (1 + pow(2.0, -(epoch(l.built_at) / 86400.0) / 365.0)) as decay from long l left join best b using (unified_id) where value in (select v from tell)),
      sums as (select group_id, field_name, norm, round(sum(trust * decay), 9) as votes from cast_ group by 1, 2, 3),
      picks as (select group_id, field_name, norm, unified_id, value, row_number() over (partition by group_id, field_name, norm order by trust desc, built_at desc, unified_id) as n from cast_),
      won as (select s.*, p.value, row_number() over (partition by s.group_id, s.field_name order by votes desc, p.unified_id) as n from sums s join picks p using (group_id, field_name, norm) where p.n = 1)
      select group_id, field_name, value, round(votes, 4) as votes from won where n = 1""",
}


def _titles(spark: SparkSession, d: str) -> DataFrame:
    return entries.match(load(spark, d, "hellowork").select("url", "title"), "title", load(spark, d, "role_titles"), "title_id", "title_fr", "title_en")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _titles(spark, d).where("url is not null and title_id is not null").select("url", "title_id").distinct()


def p5_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """Values that name no entry, with their number of postings."""
    return _titles(spark, d).where("title_id is null").groupBy(F.trim(F.coalesce("title", F.lit(""))).alias("title")).agg(F.countDistinct("url").alias("postings"))


QUERIES |= {f.__name__: f for f in (p5_found, p5_unmatched)}


def _linked(spark: SparkSession, d: str) -> list[tuple[str, DataFrame]]:
    occupations = load(spark, d, "occupations").where("coalesce(occupation_type, '') <> 'isco_group'")
    skills = load(spark, d, "skills").where("coalesce(source, '') <> 'TAXONOMY'")
    found = []
    for kind, rows, code in (("occupation", occupations, F.col("isco_code")), ("skill", skills, F.lit(None).cast("string"))):
        records = rows.select(
            F.col("entity_id").alias("id"), "source", F.col("pref_label_en").alias("label"), F.col("description_en").alias("described"),
            F.concat_ws(" | ", "description_en", "alt_labels_en").alias("other"), code.alias("code"),
        )
        found.append((kind, entities.link(records)))
    return found


def _same_things(spark: SparkSession, d: str) -> DataFrame:
    (a, jobs), (b, skills) = [(kind, entities.matched_pairs(linked)) for kind, linked in _linked(spark, d)]
    columns = ["entity_kind", "entity_id_a", "entity_id_b", "confidence"]
    return jobs.withColumn("entity_kind", F.lit(a)).select(*columns).unionByName(skills.withColumn("entity_kind", F.lit(b)).select(*columns))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _same_things(spark, d).select("entity_kind", "entity_id_a", "entity_id_b").distinct()


def p7_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Matched pairs with their confidence."""
    return _same_things(spark, d)


def p7_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every record with the class it belongs to and its number of links."""
    (a, jobs), (b, skills) = [(kind, entities.classes_of(linked)) for kind, linked in _linked(spark, d)]
    return jobs.withColumn("entity_kind", F.lit(a)).unionByName(skills.withColumn("entity_kind", F.lit(b)))


QUERIES |= {f.__name__: f for f in (p7_found, p7_confidence, p7_classes)}
