"""Queries on look-ups, demand and votes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxoloom.functions import text
from taxoloom.operators import demand, lookup, votes
from taxoloom.queries import sqltext as S
from taxoloom.queries.texts import STOP_WORDS, clean_title_sql
from taxoloom.session import load

# Patterns that tell a role before its title is looked up.
ROLE_PATTERNS = (("role_data", "(data|donn[ée]es|bdd|database)"), ("role_security", "(cyber|s[ée]curit)"), ("role_cloud", "cloud"), ("role_web", "(\\bweb\\b|mobile)"))
FLOOR_SHARE = 0.0001


def _postings(spark: SparkSession, d: str) -> DataFrame:
    """Orders as postings: (posting, role, skill, category, line)."""
    lines = load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    parts = load(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("skill"), F.col("p_type").alias("category"))
    orders = load(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    roles = load(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("role"))
    return lines.join(parts, "l_partkey").join(orders, "l_orderkey").join(roles, "o_custkey").select(F.col("l_orderkey").alias("posting"), "role", "skill", "category", "l_partkey", "l_quantity", "l_linenumber")


def demand_edges_distinct(spark, d):
    return demand.per_posting(_postings(spark, d), "posting", "role", "skill", 2)


def demand_edges_weighted(spark, d):
    return demand.weighted(_postings(spark, d), "role", "skill", "l_quantity")


def _part_index(spark, d):
    return load(spark, d, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("entity"))


def demand_token_level(spark, d):
    return demand.per_token(_postings(spark, d), "posting", "role", "l_partkey", _part_index(spark, d), 15)


def demand_floor_after(spark, d):
    return demand.resolved_counts(_postings(spark, d), "posting", "role", "l_partkey", _part_index(spark, d), after=50)


def demand_floor_before(spark, d):
    return demand.resolved_counts(_postings(spark, d), "posting", "role", "l_partkey", _part_index(spark, d), before=3)


def relation_demand(spark, d):
    rows = load(spark, d, "occupation_skill_relations").where("occupation_entity_id is not null and skill_entity_id is not null").dropDuplicates(["rel_id"])
    return demand.weighted(rows, "occupation_entity_id", "skill_entity_id", "weight").where("weight > 1")


def modal_category(spark, d):
    return demand.modal(load(spark, d, "events"), "user_id", "event_type", "ts")


def _skill_index(spark, d):
    rows = load(spark, d, "skills").where("coalesce(source, '') <> 'TAXONOMY'")
    fields = [F.array("pref_label_en"), F.array("pref_label_fr"), text.split_multi("alt_labels_en"), text.split_multi("alt_labels_fr")]
    return lookup.label_index(rows, "entity_id", "entity_id", fields)


def label_index(spark, d):
    return _skill_index(spark, d)


def unified_to_skill(spark, d):
    """Unified records whose primary label is a listed skill."""
    rows = load(spark, d, "unified_skills").select("unified_id", "primary_label_en").distinct()
    return lookup.key_join(rows, "primary_label_en", _skill_index(spark, d)).select("unified_id", "entity")


def variant_lookup(spark, d):
    """Variants of the labels of all sources but one's own."""
    rows = load(spark, d, "skills").where("coalesce(source, '') not in ('TAXONOMY', 'DATAJOBS')")
    return lookup.variant_index(rows, "entity_id", "entity_id", "pref_label_en", ("monitor", "audit"), ("automation", "auditing"))


def first_probe(spark, d):
    probes = F.array(F.col("primary_label_en"), F.get(text.split_multi("alt_labels_en"), F.lit(0)), F.col("primary_label_fr"))
    rows = load(spark, d, "unified_skills").groupBy("unified_id").agg(F.min("primary_label_en").alias("primary_label_en"), F.min("alt_labels_en").alias("alt_labels_en"), F.min("primary_label_fr").alias("primary_label_fr"))
    return lookup.first_probe(rows.select("unified_id", F.filter(probes, lambda x: x.isNotNull()).alias("p")), "unified_id", "p", _skill_index(spark, d))


def regex_priority_role(spark, d):
    titles = load(spark, d, "hellowork").select("url", "title").distinct()
    listed = load(spark, d, "role_titles").select(text.match_key("title_fr").alias("key"), F.concat(F.lit("title_"), F.col("title_id")).alias("listed"))
    found = titles.withColumn("key", text.match_key(text.clean_title("title", STOP_WORDS))).join(listed, "key", "left")
    return found.select("url", lookup.pattern_or_key(F.coalesce("title", F.lit("")), ROLE_PATTERNS, F.col("listed")).alias("role")).where("role is not null").distinct()


def _phrases(spark, d, most=4):
    """Runs of one to four words in skill labels, as a dictionary."""
    grams = load(spark, d, "skills").where("source <> 'TAXONOMY'").select(F.explode(text.ngrams_to(text.tech_tokens(text.normalize_label("pref_label_en")), most)).alias("key"))
    return grams.groupBy("key").agg(F.count("*").alias("n")).where("n >= 3").select("key", F.col("key").alias("entity"))


def ngram_dictionary_match(spark, d):
    hits = lookup.dictionary_hits(load(spark, d, "documents"), "doc_id", "text", _phrases(spark, d), 4)
    return hits.groupBy("entity").agg(F.count("*").alias("docs"))


def longest_match(spark, d):
    """Documents by the phrases of three, two and one words that cover their text."""
    return lookup.longest_hits(load(spark, d, "documents"), "doc_id", "text", _phrases(spark, d, 3), 3).groupBy("entity").agg(F.count("*").alias("docs"))


def frequent_absent(spark, d):
    tokens = load(spark, d, "documents").select("doc_id", F.explode(text.tech_tokens("text")).alias("token"))
    index = load(spark, d, "skills").select(F.explode(text.tech_tokens("pref_label_en")).alias("key")).distinct()
    return demand.frequent_absent(tokens, "doc_id", "token", index, 20)


def star_edges(spark, d):
    rows = load(spark, d, "skills").where("source <> 'TAXONOMY'").select("entity_id", text.match_key("pref_label_en").alias("key"), F.coalesce("hard_soft_provisional", F.lit("")).alias("kind")).distinct().where("key <> ''")
    return lookup.star_edges(rows, "entity_id", ["key", "kind"], "entity_id")


def transversal_attach(spark, d):
    core = load(spark, d, "skills").where("esco_skill_type = 'skill_domain'").select(F.col("entity_id").alias("skill_entity_id")).distinct()
    jobs = load(spark, d, "occupations").where("coalesce(occupation_type, '') <> 'isco_group'").select(F.col("entity_id").alias("occupation_entity_id")).distinct()
    return lookup.attach_all(core, jobs)


def _refs(spark, d):
    return {"occupation_entity_id": (load(spark, d, "occupations"), "entity_id"), "skill_entity_id": (load(spark, d, "skills"), "entity_id")}


def prune_missing(spark, d):
    rows = load(spark, d, "link_audit").select("audit_id", "occupation_entity_id", "skill_entity_id").distinct()
    return lookup.keep_referring(rows, _refs(spark, d)).select("audit_id")


def dangling_refs(spark, d):
    rows = load(spark, d, "link_audit").select("audit_id", "occupation_entity_id", "skill_entity_id").distinct()
    return lookup.dangling(rows, _refs(spark, d)).select("audit_id", "missing")


def refill_codes(spark, d):
    """Codes of occupations filled from other rows of the same source code."""
    rows = load(spark, d, "occupations").select("entity_id", "source_code", "isco_code").distinct().where("source_code is not null")
    return lookup.refill(rows, "source_code", "isco_code", rows).select("entity_id", "isco_code").distinct()


def not_covered(spark, d):
    rows = load(spark, d, "unified_skills").select("unified_id", "primary_label_en").distinct()
    return lookup.not_covered(rows, "primary_label_en", _skill_index(spark, d)).select("unified_id")


def resolve_or_harvest(spark, d):
    tokens = load(spark, d, "documents").select(F.explode(text.tech_tokens("text")).alias("token")).distinct()
    index = load(spark, d, "part").groupBy(text.match_key("p_name").alias("key")).agg(F.min("p_partkey").cast("string").alias("entity"))
    fresh = tokens.where(F.length("token") > 9).select("token", text.mint_id("SKL_", F.lit("HARVEST"), "token").alias("entity"))
    return lookup.resolve_or_harvest(tokens, "token", index, fresh).where("entity is not null").select("token", "entity")


def label_rows(spark, d):
    rows = load(spark, d, "occupations").where("source is not null").groupBy("entity_id", "source").agg(*[F.min(c).alias(c) for c in ("pref_label_en", "alt_labels_en", "pref_label_fr")])
    fields = {("preferred", "en"): text.split_multi("pref_label_en"), ("alt", "en"): text.split_multi("alt_labels_en"), ("preferred", "fr"): text.split_multi("pref_label_fr")}
    return lookup.label_rows(rows, "entity_id", "source", fields)


def majority_vote(spark, d):
    return votes.majority(load(spark, d, "skills"), ["source"], "it_subtype")


def consensus_label(spark, d):
    return votes.consensus_label(load(spark, d, "unified_skills"), ["it_subtype"], "primary_label_en", "alt_labels_en").where("it_subtype is not null")


def consensus_description(spark, d):
    return votes.majority(load(spark, d, "skills"), ["it_subtype"], "description_en", longest=True).where("it_subtype is not null")


def merged_alts(spark, d):
    rows = load(spark, d, "unified_skills").select("unified_id", text.split_multi("alt_labels_en").alias("labels"), F.lit(0).alias("ord")).distinct()
    primary = load(spark, d, "unified_skills").groupBy("unified_id").agg(F.min("primary_label_en").alias("primary"))
    return votes.other_labels(rows, ["unified_id"], "labels", "ord", primary)


def sources_of_codes(spark, d):
    return votes.sorted_list(load(spark, d, "occupations").where("isco_code is not null"), ["isco_code"], "source", "sources")


def component_ids(spark, d):
    rows = load(spark, d, "skills").where("it_subtype is not null")
    return votes.component_ids(rows, "it_subtype", "entity_id", "USKL_")


QUERIES = {
    f.__name__: f
    for f in (
        demand_edges_distinct, demand_edges_weighted, demand_token_level, demand_floor_after, demand_floor_before, relation_demand, modal_category, label_index, unified_to_skill, variant_lookup,
        first_probe, regex_priority_role, ngram_dictionary_match, longest_match, frequent_absent, star_edges, transversal_attach, prune_missing, dangling_refs, refill_codes, not_covered,
        resolve_or_harvest, label_rows, majority_vote, consensus_label, consensus_description, merged_alts, sources_of_codes, component_ids,
    )
}

_POST = """post as (select l_orderkey as posting, c_mktsegment as role, p_name as skill, l_partkey, l_quantity from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey)"""
_SPLIT = "list_filter(list_transform(regexp_split_to_array(coalesce({c}, ''), '[\\n\\r|]'), lambda x: trim(x)), lambda x: x <> '')"
_INDEX = f"""lab as (select entity_id, 0 as f, pref_label_en as label from skills where coalesce(source, '') <> 'TAXONOMY' union all select entity_id, 1, pref_label_fr from skills where coalesce(source, '') <> 'TAXONOMY'
    union all select entity_id, 2, unnest({_SPLIT.format(c='alt_labels_en')}) from skills where coalesce(source, '') <> 'TAXONOMY' union all select entity_id, 3, unnest({_SPLIT.format(c='alt_labels_fr')}) from skills where coalesce(source, '') <> 'TAXONOMY'),
  keyed as (select entity_id, f, {S.match_key('label')} as key from lab),
  idx as (select key, min(entity_id) as entity from keyed where key <> '' group by key)"""
_TOK = "regexp_extract_all({x}, '[a-z0-9+.#]+')"
_NGRAMS = " union all ".join(f"select {{id}}, {' || chr(32) || '.join(f'ts[i + {k}]' for k in range(n))} as key from (select {{id}}, ts, unnest(range(1, len(ts) - {n - 2})) as i from {{t}})" for n in (1, 2, 3, 4))
_GRAMS = f"""words as (select entity_id, {_TOK.format(x=S.norm('pref_label_en'))} as ts from skills where source <> 'TAXONOMY'),
  dict as (select key from ({_NGRAMS.format(id='entity_id', t='words')}) group by 1 having count(*) >= 3)"""
_ANTI = "coalesce({c}, '~') not in (select entity_id from {t})"
SQL = {
    "demand_edges_distinct": f"with {_POST} select role, skill, count(distinct posting) as weight from post group by 1, 2 having count(distinct posting) >= 2",
    "demand_edges_weighted": f"with {_POST} select role, skill, cast(sum(greatest(cast(trunc(l_quantity) as bigint), 1)) as bigint) as weight from post group by 1, 2",
    "demand_token_level": f"with {_POST} select role, skill as entity, count(*) as weight from (select distinct posting, role, l_partkey, skill from post) group by 1, 2 having count(*) >= 15",
    "demand_floor_after": f"with {_POST} select role, skill as entity, cast(sum(n) as bigint) as weight from (select role, l_partkey, skill, count(distinct posting) as n from post group by 1, 2, 3) group by 1, 2 having sum(n) >= 50",
    "demand_floor_before": f"with {_POST} select role, skill as entity, cast(sum(n) as bigint) as weight from (select role, l_partkey, skill, count(distinct posting) as n from post group by 1, 2, 3 having count(distinct posting) >= 3) group by 1, 2",
    "relation_demand": "select occupation_entity_id, skill_entity_id, cast(sum(greatest(coalesce(cast(trunc(try_cast(weight as double)) as bigint), 1), 1)) as bigint) as weight from (select distinct * from occupation_skill_relations) where occupation_entity_id is not null and skill_entity_id is not null group by 1, 2 having sum(greatest(coalesce(cast(trunc(try_cast(weight as double)) as bigint), 1), 1)) > 1",
    "modal_category": "select user_id, event_type, n from (select *, row_number() over (partition by user_id order by n desc, seen, event_type) as r from (select user_id, event_type, count(*) as n, min(ts) as seen from events group by 1, 2)) where r = 1",
    "label_index": f"with {_INDEX} select key, entity from idx",
    "unified_to_skill": f"with {_INDEX} select u.unified_id, idx.entity from (select distinct unified_id, {S.match_key('primary_label_en')} as key from unified_skills) u join idx on u.key = idx.key",
    "not_covered": f"with {_INDEX} select unified_id from (select distinct unified_id, primary_label_en from unified_skills) where {S.match_key('primary_label_en')} not in (select key from idx)",
    "first_probe": f"""with {_INDEX}, u as (select unified_id, min(primary_label_en) as a, {_SPLIT.format(c='min(alt_labels_en)')}[1] as b, min(primary_label_fr) as c from unified_skills group by 1),
      p as (select unified_id, 0 as n, a as probe from u where a is not null union all select unified_id, 1, b from u where b is not null union all select unified_id, 2, c from u where c is not null),
      h as (select p.unified_id, p.n, p.probe, idx.entity from p join idx on {S.match_key('p.probe')} = idx.key)
      select unified_id as owner, arg_min(probe, n) as probe, arg_min(entity, n) as entity from h group by 1""",
    "ngram_dictionary_match": f"""with {_GRAMS}, d as (select doc_id, {_TOK.format(x="lower(coalesce(text, ''))")} as ts from documents),
      g as (select distinct doc_id, key from ({_NGRAMS.format(id='doc_id', t='d')}))
      select key as entity, count(*) as docs from g where key in (select key from dict) group by 1""",
    "frequent_absent": f"""with d as (select distinct doc_id, unnest({_TOK.format(x="lower(coalesce(text, ''))")}) as token from documents),
      i as (select distinct unnest({_TOK.format(x="lower(coalesce(pref_label_en, ''))")}) as key from skills)
      select token, count(*) as docs from d where token not in (select key from i) group by 1 having count(*) >= 20""",
    "star_edges": f"""with r as (select distinct entity_id, {S.match_key('pref_label_en')} as key, coalesce(hard_soft_provisional, '') as kind from skills where source <> 'TAXONOMY'),
      a as (select key, kind, min(entity_id) as a from r where key <> '' group by 1, 2 having count(*) > 1)
      select a.a, r.entity_id as b, r.key, r.kind from r join a on r.key = a.key and r.kind = a.kind where r.entity_id <> a.a""",
    "transversal_attach": "select o.entity_id as occupation_entity_id, s.entity_id as skill_entity_id from (select distinct entity_id from occupations where coalesce(occupation_type, '') <> 'isco_group') o cross join (select distinct entity_id from skills where esco_skill_type = 'skill_domain') s",
    "prune_missing": "select distinct audit_id from link_audit where occupation_entity_id in (select entity_id from occupations) and skill_entity_id in (select entity_id from skills)",
    "dangling_refs": f"select distinct audit_id, 'occupation_entity_id' as missing from link_audit where {_ANTI.format(c='occupation_entity_id', t='occupations')} union all select distinct audit_id, 'skill_entity_id' from link_audit where {_ANTI.format(c='skill_entity_id', t='skills')}",
    "refill_codes": f"""with r as (select distinct entity_id, source_code, isco_code from occupations where source_code is not null), o as (select source_code, min(isco_code) as old from r where {S.blank_null('isco_code')} is not null group by 1)
      select distinct entity_id, coalesce({S.blank_null('isco_code')}, old) as isco_code from r left join o using (source_code)""",
    "resolve_or_harvest": f"""with t as (select distinct unnest({_TOK.format(x="lower(coalesce(text, ''))")}) as token from documents), i as (select {S.match_key('p_name')} as key, cast(min(p_partkey) as varchar) as entity from part group by 1)
      select token, coalesce(i.entity, case when length(token) > 9 then {S.mint('SKL_', "'HARVEST'", 'token')} end) as entity from t left join i on {S.match_key('token')} = i.key where coalesce(i.entity, case when length(token) > 9 then 'x' end) is not null""",
    "label_rows": f"""with r as (select entity_id, source, min(pref_label_en) as a, min(alt_labels_en) as b, min(pref_label_fr) as c from occupations where source is not null group by 1, 2),
      l as (select entity_id, source, 0 as f, 'preferred' as label_type, 'en' as language, {_SPLIT.format(c='a')} as ls from r union all select entity_id, source, 1, 'alt', 'en', {_SPLIT.format(c='b')} from r union all select entity_id, source, 2, 'preferred', 'fr', {_SPLIT.format(c='c')} from r),
      x as (select entity_id, source, label_type, language, unnest(range(1, len(ls) + 1)) as i, ls from l),
      y as (select entity_id, source, label_type, language, i, ls[i] as label, {S.norm('ls[i]')} as label_norm from x)
      select entity_id, source, arg_min(label, i) as label, label_type, language, label_norm from y where label_norm <> '' group by entity_id, source, label_type, language, label_norm""",
    "majority_vote": f"select source, it_subtype from (select source, v as it_subtype, row_number() over (partition by source order by n desc, length(v), v) as r from (select source, trim(it_subtype) as v, count(*) as n from skills where {S.blank_null('it_subtype')} is not null group by 1, 2)) where r = 1",
    "consensus_description": f"select it_subtype, description_en from (select it_subtype, v as description_en, row_number() over (partition by it_subtype order by n desc, length(v) desc, v) as r from (select it_subtype, trim(description_en) as v, count(*) as n from skills where {S.blank_null('description_en')} is not null and it_subtype is not null group by 1, 2)) where r = 1",
    "consensus_label": f"""with v as (select it_subtype, trim(primary_label_en) as v, {S.norm('primary_label_en')} as f from unified_skills where {S.norm('primary_label_en')} <> '' and it_subtype is not null),
      w as (select it_subtype, f, count(*) as n from v group by 1, 2), b as (select it_subtype, f from (select *, row_number() over (partition by it_subtype order by n desc, f) as r from w) where r = 1),
      s as (select it_subtype, v from (select v.it_subtype, v.v, row_number() over (partition by v.it_subtype order by length(v.v), v.v) as r from v join b on v.it_subtype = b.it_subtype and v.f = b.f) where r = 1),
      v2 as (select it_subtype, trim(alt_labels_en) as v, {S.norm('alt_labels_en')} as f from unified_skills where {S.norm('alt_labels_en')} <> '' and it_subtype is not null),
      w2 as (select it_subtype, f, count(*) as n from v2 group by 1, 2), b2 as (select it_subtype, f from (select *, row_number() over (partition by it_subtype order by n desc, f) as r from w2) where r = 1),
      s2 as (select it_subtype, v from (select v2.it_subtype, v2.v, row_number() over (partition by v2.it_subtype order by length(v2.v), v2.v) as r from v2 join b2 on v2.it_subtype = b2.it_subtype and v2.f = b2.f) where r = 1)
      select coalesce(s.it_subtype, s2.it_subtype) as it_subtype, coalesce(s.v, s2.v) as primary_label_en from s full join s2 on s.it_subtype = s2.it_subtype""",
    "sources_of_codes": "select isco_code, string_agg(source, ' | ' order by source) as sources from (select distinct isco_code, source from occupations where isco_code is not null and source is not null) group by 1",
    "component_ids": "select it_subtype, 'USKL_' || substr(sha1(string_agg(entity_id, '|' order by entity_id)), 1, 12) as unified_id from (select distinct it_subtype, entity_id from skills where it_subtype is not null) group by 1",
}
_BASE = S.match_key("pref_label_en")
_ROLE_CASE = " ".join(f"when regexp_matches(coalesce(title, ''), {S.q('(?i)' + p)}) then '{n}'" for n, p in ROLE_PATTERNS)
SQL |= {
    "variant_lookup": f"""with r as (select entity_id, pref_label_en, {_BASE} as base from skills where coalesce(source, '') not in ('TAXONOMY', 'DATAJOBS')),
      k as (select entity_id, base as key from r union select entity_id, regexp_replace(base, '^((monitor|audit)\\s+)+', '') from r union select entity_id, regexp_replace(base, '(\\s+(automation|auditing))+$', '') from r
        union select entity_id, {S.match_key('x')} from (select entity_id, unnest(regexp_extract_all(coalesce(pref_label_en, ''), '\\(([^)]*)\\)', 1)) as x from r))
      select key, min(entity_id) as entity from k where key <> '' group by 1""",
    "regex_priority_role": f"""with t as (select distinct url, title, {clean_title_sql('title')} as clean from hellowork), l as (select {S.match_key('title_fr')} as key, 'title_' || title_id as listed from role_titles),
      j as (select url, case {_ROLE_CASE} else listed end as role from (select *, {S.match_key('clean')} as key from t) left join l using (key)) select distinct url, role from j where role is not null""",
    "merged_alts": f"""with r as (select distinct unified_id, {_SPLIT.format(c='alt_labels_en')} as ls from unified_skills), n as (select row_number() over () as id, unified_id, ls from r),
      x as (select id, unified_id, unnest(ls) as v, generate_subscripts(ls, 1) as i from n), f as (select id, unified_id, v, min(i) as i from x group by 1, 2, 3),
      p as (select unified_id, v, row_number() over (partition by id order by i) as p from f), u as (select unified_id, v, min(p) as p from p group by 1, 2),
      m as (select unified_id, min(primary_label_en) as primary_label from unified_skills group by 1)
      select unified_id, string_agg(v, ' | ' order by p, v) as labels from u join m using (unified_id) where primary_label is null or v <> primary_label group by 1""",
}
