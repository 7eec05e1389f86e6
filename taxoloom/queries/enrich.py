"""Queries on enrichment: what is missing, what may fill it, what is fit to."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxoloom.functions import text
from taxoloom.operators import demand, lookup
from taxoloom.plans import pipeline
from taxoloom.queries import sqltext as S
from taxoloom.queries.links import ROLE_PATTERNS
from taxoloom.session import load


def descriptions_by_source(spark, d):
    return load(spark, d, "unified_skills").where("trim(coalesce(description, '')) <> ''").groupBy("description_source").agg(F.count("*").alias("n"))


def translated_labels(spark, d):
    """English labels of occupations, from translated French ones where they are missing."""
    table = load(spark, d, "occupations").where("pref_label_en is not null and pref_label_fr is not null").withColumn("key", text.normalize_label("pref_label_fr"))
    known = table.groupBy("key").agg(F.min("pref_label_en").alias("translated"))
    rows = load(spark, d, "occupations").where("pref_label_en is null and pref_label_fr is not null").select("entity_id", text.normalize_label("pref_label_fr").alias("key")).distinct()
    return rows.join(known, "key", "left").select("entity_id", F.coalesce("translated", F.lit("")).alias("label"))


def description_validity(spark, d):
    n = F.length(F.trim("description_en"))
    reason = F.when(n < 20, "short").when(n > 120, "long").when(text.normalize_label("description_en") == text.normalize_label("pref_label_en"), "echo").otherwise("")
    return load(spark, d, "skills").where("description_en is not null").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def translation_targets(spark, d):
    """Distinct English labels without a French one, technical names aside."""
    rows = load(spark, d, "skills").where("trim(coalesce(pref_label_fr, '')) = '' and trim(coalesce(pref_label_en, '')) <> ''")
    return rows.select(F.trim("pref_label_en").alias("label")).distinct().where(~text.fully_protected("label")).select("label", text.short_hash("label", 16).alias("hash"))


def scraped_demand(spark, d):
    """Roles of postings by title with the two-word phrases of their texts."""
    rows = load(spark, d, "hellowork").where("url is not null").select("url", lookup.pattern_or_key(F.coalesce("title", F.lit("")), ROLE_PATTERNS, F.lit(None).cast("string")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).where("role is not null")
    grams = rows.select("url", "role", F.explode(text.ngrams(text.tech_tokens("text"), 2)).alias("phrase"))
    return demand.per_posting(grams, "url", "role", "phrase", 3)


def sparse_roles(spark, d):
    return pipeline.sparse_roles(load(spark, d, "occupations"), load(spark, d, "occupation_skill_relations"))


def demand_profiles(spark, d):
    rows = load(spark, d, "occupation_skill_relations").where("occupation_entity_id is not null and skill_entity_id is not null and relation_type = 'demand'")
    return rows.groupBy("occupation_entity_id").agg(F.countDistinct("skill_entity_id").alias("skills"))


def grounding_context(spark, d):
    rows = load(spark, d, "skills").where("source = 'ESCO'").groupBy("entity_id").agg(*[F.min(c).alias(c) for c in ("pref_label_en", "it_subtype", "description_en", "alt_labels_en")])
    return pipeline.grounding(rows, "pref_label_en", "it_subtype", "description_en", "alt_labels_en").select("entity_id", "context")


QUERIES = {f.__name__: f for f in (descriptions_by_source, translated_labels, description_validity, translation_targets, scraped_demand, sparse_roles, demand_profiles, grounding_context)}
_CORE = "regexp_replace(w, '^[ ,.;:()\\[\\]{}\"''/’]+|[ ,.;:()\\[\\]{}\"''/’]+$', '', 'g')"
_KEPT = f"({_CORE} <> '' and ((regexp_matches({_CORE}, '^[^a-zà-öø-ÿ]{{2,}}$') and regexp_matches({_CORE}, '[A-ZÀ-ÖØ-Þ]')) or regexp_matches({_CORE}, '[a-z][A-Z]') or regexp_matches({_CORE}, '[0-9+#]') or regexp_matches({_CORE}, '\\.[^.]')))"
_RAW = "list_filter(list_transform(regexp_split_to_array(coalesce(al, ''), '[\\n\\r|]'), lambda x: trim(x)), lambda x: x <> '')"
_PARTS = f"list_filter({_RAW}, lambda x, i: list_position({_RAW}, x) = i)"
SQL = {
    "descriptions_by_source": "select description_source, count(*) as n from unified_skills where trim(coalesce(description, '')) <> '' group by 1",
    "translated_labels": f"""with k as (select {S.norm('pref_label_fr')} as key, min(pref_label_en) as t from occupations where pref_label_en is not null and pref_label_fr is not null group by 1)
      select entity_id, coalesce(t, '') as label from (select distinct entity_id, {S.norm('pref_label_fr')} as key from occupations where pref_label_en is null and pref_label_fr is not null) r left join k on r.key = k.key""",
    "description_validity": f"select case when length(trim(description_en)) < 20 then 'short' when length(trim(description_en)) > 120 then 'long' when {S.norm('description_en')} = {S.norm('pref_label_en')} then 'echo' else '' end as reason, count(*) as n from skills where description_en is not null group by 1",
    "translation_targets": f"""with l as (select distinct trim(pref_label_en) as label from skills where trim(coalesce(pref_label_fr, '')) = '' and trim(coalesce(pref_label_en, '')) <> ''),
      w as (select label, unnest(regexp_split_to_array(label, '\\s+')) as w from l), p as (select label, bool_and({_KEPT}) as kept from w where regexp_matches(w, '[\\p{{L}}\\p{{N}}]') group by 1)
      select l.label, substr(sha1(l.label), 1, 16) as hash from l left join p on l.label = p.label where length(l.label) > 2 and not coalesce(kept, false)""",
    "scraped_demand": f"""with r as (select url, {S.rule_case("coalesce(title, '')", tuple((n, '(?i)' + p) for n, p in ROLE_PATTERNS), 'null')} as role, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9+.#]+') as ts from hellowork where url is not null),
      g as (select distinct url, role, ts[i] || ' ' || ts[i + 1] as phrase from (select url, role, ts, unnest(range(1, len(ts))) as i from r where role is not null))
      select role, phrase, count(*) as weight from g group by 1, 2 having count(*) >= 3""",
    "sparse_roles": "select o.entity_id, count(r.occupation_entity_id) as n from (select distinct entity_id from occupations) o left join occupation_skill_relations r on r.occupation_entity_id = o.entity_id group by 1 having count(r.occupation_entity_id) <= 6 order by n, o.entity_id limit 40",
    "demand_profiles": "select occupation_entity_id, count(distinct skill_entity_id) as skills from occupation_skill_relations where occupation_entity_id is not null and skill_entity_id is not null and relation_type = 'demand' group by 1",
    "grounding_context": f"""with r as (select entity_id, min(pref_label_en) as a, min(it_subtype) as b, min(description_en) as c, min(alt_labels_en) as al from skills where source = 'ESCO' group by 1)
      select entity_id, array_to_string(list_filter([a, b, c, case when len({_PARTS}) > 0 then 'also: ' || array_to_string({_PARTS}[1:3], ', ') end], lambda x: trim(coalesce(x, '')) <> ''), '. ') as context from r""",
}
