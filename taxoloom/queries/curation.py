"""Queries on curation: predicates, the ontology, hand-made lists, outside records, logs and self-checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from taxoloom.functions import text
from taxoloom.functions.rules import CATEGORY_DOMAINS
from taxoloom.operators import curation, lookup, quality, similarity
from taxoloom.queries import sqltext as S
from taxoloom.session import load


def _unified(spark, d):
    """One row for each unified id, every field the smallest given."""
    rows = load(spark, d, "unified_skills")
    return rows.groupBy("unified_id").agg(*[F.min(c).alias(c) for c in rows.columns if c != "unified_id"])


def excluded_labels(spark, d):
    """Unified records whose label isn't one a given source uses."""
    names = load(spark, d, "skills").where("source = 'ESCO'").select(F.col("pref_label_en").alias("name"))
    return curation.excluded(_unified(spark, d).select("unified_id", "primary_label_en"), "primary_label_en", names).select("unified_id")


def spoken_postings(spark, d):
    rows = load(spark, d, "hellowork").where(curation.spoken("lang", ("fr", "")))
    return rows.groupBy("site").agg(F.count("*").alias("postings"))


def homonyms(spark, d):
    return load(spark, d, "documents").groupBy("source").agg(F.count_if(curation.homonym("text")).alias("homonyms"))


def short_labels(spark, d):
    kinds = tuple(CATEGORY_DOMAINS)
    return _unified(spark, d).where(curation.short_label("primary_label_en", "it_subtype", kinds)).select("unified_id")


def hinted_titles(spark, d):
    return load(spark, d, "documents").where(curation.hinted("title")).select("doc_id")


def profile_texts(spark, d):
    return load(spark, d, "skills").select("entity_id", curation.profile_text("pref_label_en", "alt_labels_en", "description_en").alias("profile")).distinct()


def attach_inputs(spark, d):
    """What groups of roles are compared by, and the sources whose roles are attached to them."""
    groups = load(spark, d, "occupations").where("occupation_type = 'isco_group'")
    return groups.select("entity_id", curation.profile_text("pref_label_en", "alt_labels_en", "description_en", 400).alias("profile")).distinct()


def shared_sources(spark, d):
    return load(spark, d, "occupations").select("source").intersect(load(spark, d, "skills").select("source"))


def shared_labels(spark, d):
    """Labels a record has in both languages."""
    rows = _unified(spark, d).select("unified_id", F.explode(curation.overlap(text.split_multi("alt_labels_en"), text.split_multi("alt_labels_fr"))).alias("label"))
    return rows


def label_pair_tests(spark, d):
    skills = load(spark, d, "skills").groupBy(F.col("entity_id").alias("id")).agg(*[F.min(c).alias(c) for c in ("pref_label_en", "alt_labels_en")])
    keys = lambda labels: F.filter(F.transform(labels, lambda x: text.verify_key(x)), lambda k: k != "")
    labels = skills.select("id", keys(F.array("pref_label_en")).alias("pref"), keys(F.concat(F.array("pref_label_en"), text.split_multi("alt_labels_en"))).alias("every"))
    pairs = load(spark, d, "concept_alignments").select(F.col("entity_id_a").alias("a"), F.col("entity_id_b").alias("b")).where("a is not null and b is not null").distinct()
    return curation.label_tests(pairs, labels)


def skos_relations(spark, d):
    """The relation of every aligned pair of skills by their labels."""
    tested = label_pair_tests(spark, d)
    relation, confidence, flag = similarity.merge_decision(F.col("pref"), F.col("any"), F.lit(0.75), F.lit(None).cast("double"), F.lit(False), F.lit(False))
    return tested.select("a", "b", relation.alias("relation"), confidence.alias("confidence"), flag.alias("flag"))


def taxonomy_nodes(spark, d):
    return curation.taxonomy(spark)[0]


def taxonomy_edges(spark, d):
    return curation.taxonomy(spark)[1].select("parent_entity_id", "child_entity_id")


def placed_skills(spark, d):
    skills = load(spark, d, "skills")
    return curation.placed_skills(skills, skills.where("source = 'TAXONOMY'")).select("parent_entity_id", "child_entity_id")


def transversal_overlay(spark, d):
    skills = load(spark, d, "skills")
    collection = skills.where("source = 'ECF' or (source = 'ESCO' and hard_soft_provisional = 'soft')").select("source_id", "pref_label_en")
    return curation.overlay(skills, collection, "ESCO").groupBy("source", "hard_soft_provisional", "hard_soft_method").agg(F.count("*").alias("n"))


def subtype_overrides(spark, d):
    rows = _unified(spark, d).select("unified_id", "primary_label_en", "it_subtype")
    return curation.overridden(rows, "primary_label_en", "it_subtype").select("unified_id", "it_subtype")


def triggered_roles(spark, d):
    titles = load(spark, d, "hellowork").select("url", "title").distinct()
    triggers = load(spark, d, "role_titles").select(F.col("title_fr").alias("token"), F.col("title_id").alias("entity"))
    return curation.triggered(titles, "title", triggers).groupBy("entity").agg(F.countDistinct("url").alias("postings"))


def posting_endpoints(spark, d):
    """Postings by the listed title or by a title made up for at least two postings."""
    rows = load(spark, d, "hellowork").select("url", text.match_key("title").alias("key")).where("key <> ''").distinct()
    index = load(spark, d, "role_titles").groupBy(text.match_key("title_fr").alias("key")).agg(F.min("title_id").cast("string").alias("entity"))
    minted = rows.groupBy("key").agg(F.count("*").alias("n")).where("n >= 2").select("key", text.mint_id("OCC_", F.lit("SCRAPED"), "key").alias("entity"))
    return curation.endpoint(rows, "key", index, minted).select("url", "entity")


def other_sources_index(spark, d):
    """The label index without one's own source, with the category of each skill."""
    rows = load(spark, d, "skills").where("coalesce(source, '') not in ('TAXONOMY', 'ESCO')")
    index = lookup.label_index(rows, "entity_id", "entity_id", [F.array("pref_label_en")])
    kinds = rows.groupBy(F.col("entity_id").alias("entity")).agg(F.min("it_subtype").alias("it_subtype"))
    return index.join(kinds, "entity")


def either_spelling(spark, d):
    rows = load(spark, d, "skills")
    return rows.select("entity_id", curation.either(rows, ("skill_name", "pref_label_en", "pref_label_fr")).alias("label")).distinct()


PROBES = {"dom_security": ("Cybersecurity", "Security"), "dom_networks": ("Networks", "Networks & Telecommunications"), "dom_data_ai": ("Data", "Data, Analytics & AI")}


def _found(spark, d):
    """Outside records as the unified skills tell them."""
    rows = _unified(spark, d).select(text.normalize_label("primary_label_en").alias("norm"), F.col("wikidata_qid").alias("qid"), F.col("wikidata_description").alias("description")).where("norm <> ''")
    one = rows.groupBy("norm").agg(F.min("qid").alias("qid"), F.min("description").alias("description"))
    return one.select("norm", F.lit("occupation").alias("kind"), "qid", "description", F.lit("exact_label").alias("match_method"))


def anchor_targets(spark, d):
    return curation.anchor_targets(_unified(spark, d), load(spark, d, "skills").where("source = 'TAXONOMY'").distinct(), PROBES).distinct()


def anchors(spark, d):
    return curation.anchors(anchor_targets(spark, d), _found(spark, d)).select("id", "qid", "relation")


def woven(spark, d):
    """Identifiers and descriptions from outside; records without one are blanked."""
    rows = _unified(spark, d)
    links = rows.where(F.trim(F.coalesce("wikidata_qid", F.lit(""))) != "").select("unified_id", F.col("wikidata_qid").alias("qid"), "wikidata_url", F.col("wikidata_description").alias("wd_description"), F.col("alt_labels_en").alias("wd_aliases_en"), F.col("alt_labels_fr").alias("wd_aliases_fr"))
    return curation.woven(rows, links).select("unified_id", "wikidata_qid", "wikidata_url", "wikidata_description")


def _vectors(spark, d):
    unit = F.transform("embedding", lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda t, x: t + x * x))
    return load(spark, d, "embeddings").select(F.col("vec_id").alias("item"), F.col("label").cast("long").alias("owner"), unit.alias("_v")).select("item", "owner", F.transform("_v", lambda x: x / norm).alias("vec"))


def corroborated_links(spark, d):
    """How near each vector is to the nearest other one of its label."""
    rows = _vectors(spark, d)
    return curation.corroborated(rows.select("owner", "item"), rows.select("owner", "item"), rows.select("item", "vec"))


def accepted_links(spark, d):
    rows = _vectors(spark, d)
    raw = load(spark, d, "embeddings").select(F.col("label").cast("long").alias("grp"), F.col("embedding").alias("vec"))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda t, x: t + x * x))
    owners = similarity.centroids(raw).select(F.col("id").alias("owner"), F.transform("vec", lambda x: x / norm).alias("vec"))
    return curation.accepted_links(rows.select("owner", "item"), rows.select("item", "vec"), owners)


def description_targets(spark, d):
    rows = _unified(spark, d)
    done = load(spark, d, "unified_skills").where("trim(coalesce(description, '')) <> ''").select("unified_id")
    return curation.description_targets(rows, "primary_label_en", "description", F.col("it_subtype").isNotNull(), done, "unified_id").select("unified_id")


def audit_rejects(spark, d):
    rows = load(spark, d, "link_audit").select("audit_id", F.lower(F.trim("nli_pass")).alias("nli_pass")).distinct()
    return curation.rejects(rows, "nli_pass", ["audit_id"])


def first_aliases(spark, d):
    return _unified(spark, d).select("unified_id", curation.first_alias("alt_labels_fr").alias("alias"))


def stage_log(spark, d):
    old = spark.createDataFrame([("global", 1, "old"), ("other", 2, "kept"), (None, 3, "kept")], "source string, rows long, details string")
    return curation.logged(old, "global", {t: load(spark, d, t) for t in ("occupations", "skills", "hierarchy")})


def ontology_axioms(spark, d):
    jobs = load(spark, d, "occupations").select(F.col("entity_id").alias("id"), F.when(F.col("occupation_type") == "isco_group", "isco_group").otherwise("occupation").alias("kind"))
    skills = load(spark, d, "skills").select(F.col("entity_id").alias("id"), F.when(F.col("source") == "TAXONOMY", F.col("esco_skill_type")).otherwise("skill").alias("kind"))
    needs = load(spark, d, "occupation_skill_relations").select(F.col("occupation_entity_id").alias("s"), F.col("skill_entity_id").alias("t"), F.lit("requires").alias("type"))
    facets = load(spark, d, "hierarchy").where("lower(trim(relation_type)) = 'in_domain'").select(F.col("child_entity_id").alias("s"), F.col("parent_entity_id").alias("t"), F.lit("in_domain").alias("type"))
    return curation.axioms(jobs.unionByName(skills), needs.unionByName(facets).distinct())


_TABLES = ("occupations", "skills", "hierarchy", "occupation_skill_relations", "unified_skills", "concept_alignments")


def _kb(spark, d):
    return {t: load(spark, d, t) for t in _TABLES}


def whole_graph_nodes(spark, d):
    return curation.concept_graph(_kb(spark, d))[0].groupBy("kind").agg(F.count("*").alias("nodes"), F.count_distinct("label").alias("labels"))


def whole_graph_edges(spark, d):
    """All edges of the concept graph but those that roles require, and these counted by kind."""
    return curation.concept_graph(_kb(spark, d))[1].groupBy("type", "subtype", "prov").agg(F.count("*").alias("edges"), F.count_distinct("s").alias("starts"), F.count_distinct("t").alias("ends"))


def single_category(spark, d):
    """Unified skills and the one category each is under in the concept graph."""
    nodes, edges = curation.concept_graph(_kb(spark, d))
    return edges.where("type = 'broader'").join(nodes.where("kind = 'skill'").select(F.col("id").alias("s")), "s").select("s", "t")


def without_blocked(spark, d):
    """Relations left when skills with malformed labels are blocked."""
    blocked = load(spark, d, "skills").where(text.is_noise("pref_label_en")).select("entity_id")
    rows = load(spark, d, "occupation_skill_relations").select("rel_id", "skill_entity_id").distinct()
    return curation.without(rows, blocked, ("skill_entity_id",)).select("rel_id")


def ontology_triples(spark, d):
    return curation.ontology(spark)


def qa_report(spark, d):
    return curation.qa_report(_kb(spark, d))


def reconciliation(spark, d):
    skills, unified = load(spark, d, "skills"), load(spark, d, "unified_skills")
    return curation.reconciled({
        "skill_ids": (skills.select("entity_id").distinct(), skills.select("entity_id", "source").distinct()),
        "unified_ids": (unified.select("unified_id").distinct(), _unified(spark, d)),
        "all_rows": (unified, unified.select("unified_id").distinct()),
    })


def repeated_gold(spark, d):
    """How often each title is typed, by its folded form."""
    return quality.unique_mentions(load(spark, d, "hellowork").select("title", "url").distinct().where("title is not null"), "title", "url").select("norm", "n")


QUERIES = {
    f.__name__: f
    for f in (
        excluded_labels, spoken_postings, homonyms, short_labels, hinted_titles, profile_texts, attach_inputs, shared_sources, shared_labels, label_pair_tests, skos_relations, taxonomy_nodes, taxonomy_edges,
        placed_skills, transversal_overlay, subtype_overrides, triggered_roles, posting_endpoints, other_sources_index, either_spelling, anchor_targets, anchors, woven, corroborated_links, accepted_links,
        description_targets, audit_rejects, first_aliases, stage_log, ontology_axioms, reconciliation, repeated_gold, whole_graph_nodes, whole_graph_edges,
        single_category, without_blocked, ontology_triples, qa_report,
    )
}

_U = "u as (select unified_id, min(primary_label_en) as primary_label_en, min(it_subtype) as it_subtype, min(alt_labels_en) as alt_labels_en, min(alt_labels_fr) as alt_labels_fr, min(description) as description, min(wikidata_qid) as wikidata_qid, min(wikidata_url) as wikidata_url, min(wikidata_description) as wikidata_description from unified_skills group by 1)"
_LIST = "list_filter(list_transform(regexp_split_to_array(coalesce({c}, ''), '[\\n\\r|]'), lambda x: trim(x)), lambda x: x <> '')"
_PROFILE = "concat_ws('. ', nullif(trim(coalesce(pref_label_en, '')), ''), nullif((select string_agg(x, ', ' order by i) from (select x, min(i) as i from (select unnest(ls) as x, generate_subscripts(ls, 1) as i from (select {ls} as ls)) group by x)), ''), nullif(substr(trim(coalesce(description_en, '')), 1, {n}), ''))"
_CATS = ", ".join(S.q(c) for c in CATEGORY_DOMAINS)
_HINTS = " or ".join(f"contains(' ' || lower(coalesce(title, '')) || ' ', {S.q(h)})" for h in curation.TITLE_HINTS)
_TIERS = ", ".join(
    [f"('SKT_', 'type:{k}', {S.q(v)}, '{k}', 'skill_type', '{k}', '', '')" for k, v in curation.TYPE_LABELS.items()]
    + [f"('SKD_', 'domain:{k}', {S.q(v)}, '{'soft' if k == 'dom_soft' else 'hard'}', 'skill_domain', '{k}', 'SKT_', 'type:{'soft' if k == 'dom_soft' else 'hard'}')" for k, v in curation.DOMAIN_LABELS.items()]
    + [f"('SKC_', 'category:{k}', {S.q(v)}, '{'soft' if CATEGORY_DOMAINS[k] == 'dom_soft' else 'hard'}', 'skill_category', '{k}', 'SKD_', 'domain:{CATEGORY_DOMAINS[k]}')" for k, v in curation.CATEGORY_LABELS.items()]
)
_TAX = f"t as (select * from (values {_TIERS}) as v(prefix, source_id, label, hs, kind, sub, up_prefix, up))"
_ID = "{p} || substr(sha1('TAXONOMY|' || {c}), 1, 12)"
_V = "v as (select vec_id as item, cast(label as bigint) as owner, list_transform(embedding, lambda z: cast(z as double) / sqrt(list_sum(list_transform(embedding, lambda q: cast(q as double) * cast(q as double))))) as vec from embeddings)"
_CEN = """raw as (select cast(label as bigint) as id, i, avg(cast(embedding[i] as double)) as x from embeddings, (select unnest(range(1, 65)) as i) group by 1, 2),
  cen as (select id, list(x / m order by i) as vec from raw join (select id as k, sqrt(sum(x * x)) as m from raw group by 1) on id = k group by id)"""
_KEYED = f"""s as (select entity_id as id, min(pref_label_en) as p, min(alt_labels_en) as alts from skills group by 1),
  k as (select id, 0 as f, {S.verify_key('p')} as key from s where p is not null union all select id, 1, {S.verify_key('x')} from (select id, unnest({_LIST.format(c='alts')}) as x from s)),
  pr as (select distinct entity_id_a as a, entity_id_b as b from concept_alignments where entity_id_a is not null and entity_id_b is not null),
  tested as (select a, b, exists (select 1 from k x join k y on x.key = y.key where x.id = a and y.id = b and x.f = 0 and y.f = 0 and x.key <> '') as pref, exists (select 1 from k x join k y on x.key = y.key where x.id = a and y.id = b and x.key <> '') as "any" from pr)"""
_PROBE_ROWS = ", ".join(f"('{k}', {n}, {S.q(p)})" for k, v in PROBES.items() for n, p in enumerate(v))
_TARGETS = f"""targets as (select unified_id as id, 'occupation' as kind, cast(0 as int) as ord, trim(primary_label_en) as label from u where trim(coalesce(primary_label_en, '')) <> ''
  union select entity_id, 'domain', cast(n as int), p from skills join (values {_PROBE_ROWS}) as pb(k, n, p) on it_subtype = k where source = 'TAXONOMY' and esco_skill_type = 'skill_domain')"""
_PRIMARY = S.norm("primary_label_en")
_OVER = " ".join(f"when {_PRIMARY} = {S.q(k)} then {S.q(v)}" for k, v in curation.SUBTYPE_OVERRIDES.items())
SQL = {
    "excluded_labels": f"with {_U} select unified_id from u where {S.norm('primary_label_en')} not in (select {S.norm('pref_label_en')} from skills where source = 'ESCO' and {S.norm('pref_label_en')} <> '')",
    "spoken_postings": "select site, count(*) as postings from hellowork where regexp_extract(lower(trim(coalesce(lang, ''))), '^[a-z]*') in ('fr', '') group by 1",
    "homonyms": "select source, count(*) filter (where " + " or ".join(f"regexp_matches(coalesce(text, ''), {S.q('(?i)' + p)})" for p in curation.HOMONYMS) + ") as homonyms from documents group by 1",
    "short_labels": f"with {_U} select unified_id from u where it_subtype in ({_CATS}) and trim(coalesce(primary_label_en, '')) <> '' and len(regexp_split_to_array(trim(primary_label_en), '\\s+')) <= 3",
    "hinted_titles": f"select doc_id from documents where {_HINTS}",
    "profile_texts": f"select distinct entity_id, {_PROFILE.format(ls=_LIST.format(c='alt_labels_en'), n=300)} as profile from skills",
    "attach_inputs": f"select distinct entity_id, {_PROFILE.format(ls=_LIST.format(c='alt_labels_en'), n=400)} as profile from occupations where occupation_type = 'isco_group'",
    "shared_sources": "select source from occupations intersect select source from skills",
    "shared_labels": f"with {_U} select distinct a.unified_id, a.x as label from (select unified_id, unnest({_LIST.format(c='alt_labels_en')}) as x from u) a join (select unified_id, unnest({_LIST.format(c='alt_labels_fr')}) as x from u) b on a.unified_id = b.unified_id and a.x = b.x",
    "label_pair_tests": f'with {_KEYED} select a, b, pref, "any" from tested',
    "skos_relations": f"""with {_KEYED} select a, b, case when pref then 'exactMatch' else 'closeMatch' end as relation, case when pref then 0.95 when "any" then 0.85 else 0.75 end::double as confidence, case when pref then 'label' else '' end as flag from tested""",
    "taxonomy_nodes": f"with {_TAX} select {_ID.format(p='prefix', c='source_id')} as entity_id, 'TAXONOMY' as source, source_id, label as pref_label_en, hs as hard_soft_provisional, kind as esco_skill_type, sub as it_subtype from t",
    "taxonomy_edges": f"with {_TAX} select {_ID.format(p='up_prefix', c='up')} as parent_entity_id, {_ID.format(p='prefix', c='source_id')} as child_entity_id from t where up <> ''",
    "placed_skills": "with c as (select it_subtype, min(entity_id) as p from skills where source = 'TAXONOMY' and esco_skill_type = 'skill_category' group by 1), r as (select entity_id, min(it_subtype) as it_subtype from skills where coalesce(source, '') <> 'TAXONOMY' group by 1) select p as parent_entity_id, entity_id as child_entity_id from r join c using (it_subtype)",
    "transversal_overlay": """with c as (select source_id, min(pref_label_en) as l from skills where (source = 'ECF' or (source = 'ESCO' and hard_soft_provisional = 'soft')) and trim(coalesce(source_id, '')) <> '' group by 1 having min(pref_label_en) is not null),
      c2 as (select source_id, min(pref_label_en) as l from skills where (source = 'ECF' or (source = 'ESCO' and hard_soft_provisional = 'soft')) and trim(coalesce(source_id, '')) <> '' group by 1)
      select source, hard_soft_provisional, hard_soft_method, count(*) as n from (
        select s.source, case when s.source = 'ESCO' and c.l is not null then 'soft' else hard_soft_provisional end as hard_soft_provisional, case when s.source = 'ESCO' and c.l is not null then 'collection' else hard_soft_method end as hard_soft_method from skills s left join c on s.source_id = c.source_id
        union all select 'ESCO', 'soft', 'collection' from c2 where source_id not in (select source_id from skills where source = 'ESCO' and source_id is not null)) group by 1, 2, 3""",
    "subtype_overrides": f"with {_U} select unified_id, case {_OVER} else it_subtype end as it_subtype from u",
    "triggered_roles": f"with t as (select {S.norm('title_fr')} as k, min(title_id) as entity from role_titles where {S.norm('title_fr')} <> '' group by 1) select entity, count(distinct url) as postings from hellowork join t on {S.norm('title')} = t.k group by 1",
    "posting_endpoints": f"""with r as (select distinct url, {S.match_key('title')} as key from hellowork where {S.match_key('title')} <> ''), i as (select {S.match_key('title_fr')} as key, cast(min(title_id) as varchar) as entity from role_titles group by 1),
      m as (select key, {S.mint('OCC_', "'SCRAPED'", 'key')} as entity from r group by key having count(*) >= 2) select url, coalesce(i.entity, m.entity) as entity from r left join i using (key) left join m using (key) where coalesce(i.entity, m.entity) is not null""",
    "other_sources_index": f"""with r as (select * from skills where coalesce(source, '') not in ('TAXONOMY', 'ESCO')), i as (select {S.match_key('pref_label_en')} as key, min(entity_id) as entity from r where {S.match_key('pref_label_en')} <> '' group by 1)
      select key, entity, (select min(it_subtype) from r where r.entity_id = i.entity) as it_subtype from i""",
    "either_spelling": f"select distinct entity_id, coalesce({S.blank_null('pref_label_en')}, {S.blank_null('pref_label_fr')}, '') as label from skills",
    "anchor_targets": f"with {_U}, {_TARGETS} select id, kind, ord, label from targets",
    "anchors": f"""with {_U}, {_TARGETS}, f as (select {S.norm('primary_label_en')} as norm, min(wikidata_qid) as qid from u where {S.norm('primary_label_en')} <> '' group by 1)
      select id, qid, 'skos:exactMatch' as relation from targets join f on {S.norm('label')} = norm where kind = 'occupation' and trim(coalesce(qid, '')) <> ''""",
    "woven": f"with {_U} select unified_id, " + ", ".join(f"case when trim(coalesce(wikidata_qid, '')) <> '' then coalesce({c}, '') else '' end as {c}" for c in ("wikidata_qid", "wikidata_url", "wikidata_description")) + " from u",
    "corroborated_links": f"with {_V} select x.owner, x.item, round(max(list_dot_product(x.vec, y.vec)), 3) as near from v x left join v y on x.owner = y.owner and x.item <> y.item group by 1, 2",
    "accepted_links": f"with {_V}, {_CEN}, w as (select v.owner, v.item, round(list_dot_product(v.vec, cen.vec), 3) as weight from v join cen on v.owner = cen.id), r as (select *, row_number() over (partition by owner order by weight desc, item) as n from w where weight >= 0.45) select owner, item, weight from r where n <= 15",
    "description_targets": f"with {_U} select unified_id from u where trim(coalesce(primary_label_en, '')) <> '' and trim(coalesce(description, '')) = '' and it_subtype is not null and unified_id not in (select unified_id from unified_skills where trim(coalesce(description, '')) <> '')",
    "audit_rejects": "select distinct audit_id, lower(trim(nli_pass)) as nli_pass from link_audit where lower(trim(nli_pass)) in ('0', 'false')",
    "first_aliases": f"with {_U} select unified_id, coalesce({_LIST.format(c='alt_labels_fr')}[1], '') as alias from u",
    "stage_log": """with n as (select (select count(*) from occupations) as o, (select count(*) from skills) as s, (select count(*) from hierarchy) as h)
      select 'other' as source, cast(2 as bigint) as rows, 'kept' as details union all select null, 3, 'kept' union all select 'global', o + s + h, 'hierarchy=' || h || ', occupations=' || o || ', skills=' || s from n""",
    "ontology_axioms": """with kinds as (select distinct entity_id as id, case when occupation_type = 'isco_group' then 'isco_group' else 'occupation' end as kind from occupations union select entity_id, case when source = 'TAXONOMY' then esco_skill_type else 'skill' end from skills),
      one as (select id, min(kind) as kind from kinds group by 1),
      e as (select occupation_entity_id as s, skill_entity_id as t, 'requires' as type from occupation_skill_relations union select child_entity_id, parent_entity_id, 'in_domain' from hierarchy where lower(trim(relation_type)) = 'in_domain'),
      j as (select e.*, a.kind as ks, b.kind as kt from e left join one a on e.s = a.id left join one b on e.t = b.id),
      r as (select 'occupation_disjoint_skill' as name, count(*) as n from (select id from kinds where kind in ('occupation', 'skill') group by 1 having count(*) > 1)
        union all select 'requires_occupation_skill', count(*) from j where type = 'requires' and not coalesce(ks = 'occupation' and kt = 'skill', false)
        union all select 'in_domain_occupation_domain', count(*) from j where type = 'in_domain' and not coalesce(ks = 'occupation' and kt = 'skill_domain', false)
        union all select 'ends_declared', count(*) from j where ks is null or kt is null)
      select name, n = 0 as ok, n as n_violations from r""",
    "reconciliation": """with r as (select 'skill_ids' as name, (select count(*) from (select distinct entity_id from skills)) as a, (select count(*) from (select distinct entity_id, source from skills)) as b
      union all select 'unified_ids', (select count(*) from (select distinct unified_id from unified_skills)), (select count(*) from (select distinct unified_id from unified_skills))
      union all select 'all_rows', (select count(*) from unified_skills), (select count(*) from (select distinct unified_id from unified_skills)))
      select name, a as left_rows, b as right_rows, a = b as ok from r""",
    "repeated_gold": f"select {S.norm('title')} as norm, count(*) as n from (select distinct title, url from hellowork where title is not null) where {S.norm('title')} <> '' group by 1",
}

_GRAPH = f"""mem as (select entity, min(unified_id) as u from (select unified_id, unnest({_LIST.format(c='member_entity_ids')}) as entity from unified_skills) group by 1),
  nd as (select id, min(kind) as kind, min(label) as label, min(sub) as sub from (
    select entity_id as id, coalesce(esco_skill_type, '') as kind, coalesce(pref_label_en, '') as label, coalesce(it_subtype, '') as sub from skills where source = 'TAXONOMY'
    union all select entity_id, case when occupation_type = 'isco_group' then 'isco_group' else 'occupation' end, coalesce(pref_label_en, ''), '' from occupations
    union all select unified_id, 'skill', coalesce(primary_label_en, ''), coalesce(it_subtype, '') from unified_skills) where id is not null group by 1),
  raw as (select trim(child_entity_id) as s, trim(parent_entity_id) as t, case when lower(trim(relation_type)) = 'in_domain' then 'in_domain' else 'broader' end as type, '' as subtype, coalesce(source, '') as prov from hierarchy where lower(trim(relation_type)) in ('broader_than', 'in_domain')
    union all select occupation_entity_id, skill_entity_id, 'requires', coalesce(relation_type, ''), coalesce(source, '') from occupation_skill_relations),
  mapped as (select coalesce(m1.u, n1.id) as s, coalesce(m2.u, n2.id) as t, type, subtype, prov from raw left join mem m1 on raw.s = m1.entity left join nd n1 on raw.s = n1.id left join mem m2 on raw.t = m2.entity left join nd n2 on raw.t = n2.id),
  home as (select sub, min(id) as t from nd where kind = 'skill_category' and sub <> '' group by 1),
  edges as (select m.s, m.t, type, subtype, prov from mapped m join nd on m.s = nd.id where m.t is not null and (type <> 'broader' or nd.kind <> 'skill')
    union select id, home.t, 'broader', '', 'TAXONOMY' from nd join home using (sub) where kind = 'skill')"""
_COUNTED = {
    "occupations": ("entity_id", ("source", "source_id", "isco_code", "source_code", "pref_label_en", "pref_label_fr", "alt_labels_en", "alt_labels_fr", "description_en", "description_fr", "occupation_type", "label_language_status")),
    "skills": ("entity_id", ("source", "source_id", "pref_label_en", "pref_label_fr", "alt_labels_en", "alt_labels_fr", "description_en", "description_fr", "esco_skill_type", "esco_reuse_level", "hard_soft_provisional", "hard_soft_method", "it_subtype")),
    "unified_skills": ("unified_id", ("primary_label_en", "primary_label_fr", "alt_labels_en", "alt_labels_fr", "hard_soft", "it_subtype", "sources", "member_entity_ids", "wikidata_qid", "wikidata_url", "wikidata_description", "description", "description_source")),
    "hierarchy": (None, ("parent_entity_id", "child_entity_id", "entity_kind", "relation_type", "source")),
    "occupation_skill_relations": ("rel_id", ("occupation_entity_id", "skill_entity_id", "relation_type", "source", "weight")),
    "concept_alignments": (None, ("entity_id_a", "source_a", "entity_id_b", "source_b", "relation", "confidence", "method", "validated", "merge_flag", "notes")),
}
_TRIM = "regexp_replace(coalesce({c}, ''), '^[\\s\u00a0\u1680\u2000-\u200d\u202f\u205f\u2060\u3000\ufeff]+|[\\s\u00a0\u1680\u2000-\u200d\u202f\u205f\u2060\u3000\ufeff]+$', '', 'g')"


def _counters() -> str:
    parts = []
    for table, (key, columns) in _COUNTED.items():
        parts.append(f"select '{table}' as table_name, 'rows' as counter, count(*) as n from {table}")
        if key:
            parts.append(f"select '{table}', 'keys', count(distinct {key}) from {table}")
        parts += [f"select '{table}', '{c}', count(*) filter ({_TRIM.format(c=c)} <> '') from {table}" for c in columns]
    return " union all ".join(parts)


_NAMES = ", ".join(
    f"('<urn:taxoloom:{s}>', '{p}', '{o if ':' in o else f'<urn:taxoloom:{o}>'}')"
    for s, p, o in (
        *((c, "rdf:type", "owl:Class") for c in ("Occupation", "Skill", "HardSkill", "SoftSkill", "SkillType", "SkillDomain", "SkillCategory", "OccupationGroup")),
        *((c, "rdfs:subClassOf", "skos:Concept") for c in ("Occupation", "Skill", "SkillType", "SkillDomain", "SkillCategory", "OccupationGroup")),
        ("HardSkill", "rdfs:subClassOf", "Skill"), ("SoftSkill", "rdfs:subClassOf", "Skill"), ("Occupation", "owl:disjointWith", "Skill"), ("HardSkill", "owl:disjointWith", "SoftSkill"),
        ("requiresSkill", "rdf:type", "owl:ObjectProperty"), ("requiresSkill", "rdfs:domain", "Occupation"), ("requiresSkill", "rdfs:range", "Skill"),
        ("inDomain", "rdf:type", "owl:ObjectProperty"), ("inDomain", "rdfs:domain", "Occupation"), ("inDomain", "rdfs:range", "SkillDomain"),
        *((c, "rdf:type", "owl:DatatypeProperty") for c in ("hardSoft", "itSubtype", "code", "weight")),
    )
)
SQL |= {
    "whole_graph_nodes": f"with {_GRAPH} select kind, count(*) as nodes, count(distinct label) as labels from nd group by 1",
    "whole_graph_edges": f"with {_GRAPH} select type, subtype, prov, count(*) as edges, count(distinct s) as starts, count(distinct t) as ends from edges group by 1, 2, 3",
    "single_category": f"with {_GRAPH} select s, t from edges join nd on s = id where type = 'broader' and kind = 'skill'",
    "without_blocked": "select distinct rel_id from occupation_skill_relations where coalesce(skill_entity_id, '~') not in (select entity_id from skills where entity_id is not null and (not regexp_matches(trim(coalesce(pref_label_en, '')), '[A-Za-z]') or regexp_matches(trim(coalesce(pref_label_en, '')), '^[(\\[{]') or contains(trim(coalesce(pref_label_en, '')), ' ,')))",
    "ontology_triples": f"select * from (values {_NAMES}) as t(s, p, o)",
    "qa_report": _counters(),
}
