"""Queries on graphs, tables, quality and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxoloom.functions import rules, text
from taxoloom.operators import graph, quality, similarity, tables
from taxoloom.queries import sqltext as S
from taxoloom.session import bare, load

TABLES = ("occupations", "skills", "hierarchy", "occupation_skill_relations", "unified_skills", "concept_alignments")


def _kb(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {t: load(spark, d, t) for t in TABLES}


def _edges(spark: SparkSession, d: str) -> DataFrame:
    """(u, v): parent and child of broader links and, turned round, narrower ones."""
    rows = load(spark, d, "hierarchy").select(F.lower(F.trim("relation_type")).alias("kind"), F.trim("parent_entity_id").alias("a"), F.trim("child_entity_id").alias("b")).where("kind in ('broader_than', 'narrower_than') and coalesce(a, '') <> '' and coalesce(b, '') <> ''")
    return rows.select(F.when(F.col("kind") == "broader_than", F.col("a")).otherwise(F.col("b")).alias("u"), F.when(F.col("kind") == "broader_than", F.col("b")).otherwise(F.col("a")).alias("v")).distinct()


def connected_components(spark, d):
    pairs = load(spark, d, "concept_alignments").where("merge_flag = 'label'").select(F.col("entity_id_a").alias("u"), F.col("entity_id_b").alias("v"))
    nodes = load(spark, d, "skills").select(F.col("entity_id").alias("node"))
    return graph.components(pairs.where("u is not null and v is not null"), nodes)


def merge_components(spark, d):
    """Components of all merge pairs, label and semantic, over occupations and skills."""
    flagged = load(spark, d, "concept_alignments").where(F.lower(bare("merge_flag")).isin("label", "semantic"))
    nodes = None
    for name in ("occupations", "skills"):
        part = load(spark, d, name).select(bare("entity_id").alias("node"))
        nodes = part if nodes is None else nodes.unionByName(part)
    return graph.components(flagged.select(bare("entity_id_a").alias("u"), bare("entity_id_b").alias("v")), nodes.where("node <> ''"))


def cycle_check(spark, d):
    return graph.cycle_members(_edges(spark, d))


def reach_root(spark, d):
    edges = _edges(spark, d)
    roots = edges.select(F.col("u").alias("node")).distinct().join(edges.select(F.col("v").alias("node")).distinct(), "node", "left_anti")
    return graph.reached(edges, roots)


def two_level_search(spark, d):
    edges = _edges(spark, d)
    roots = load(spark, d, "skills").where("esco_skill_type = 'skill_domain'").select(F.col("entity_id").alias("node")).distinct()
    return graph.search_two_levels(edges, roots.withColumn("ord", F.col("node")))


def tree_edges(spark, d):
    codes = load(spark, d, "occupations").where("isco_code rlike '^[0-9]+$'").select("isco_code").distinct()
    return graph.prefix_parents(codes, "isco_code", "ROOT")


def parent_counts(spark, d):
    nodes = load(spark, d, "skills").select(F.col("entity_id").alias("node"))
    return graph.parent_counts(nodes, _edges(spark, d)).groupBy("parents").agg(F.count("*").alias("nodes"))


def _nodes(spark, d):
    taxonomy = load(spark, d, "skills").where("source = 'TAXONOMY'").select(F.col("entity_id").alias("id"), F.col("esco_skill_type").alias("kind"), F.col("pref_label_en").alias("label"))
    jobs = load(spark, d, "occupations").select(F.col("entity_id").alias("id"), F.lit("occupation").alias("kind"), F.col("pref_label_en").alias("label"))
    skills = load(spark, d, "unified_skills").select(F.col("unified_id").alias("id"), F.lit("skill").alias("kind"), F.col("primary_label_en").alias("label"))
    return taxonomy.unionByName(jobs).unionByName(skills).groupBy("id").agg(F.min("kind").alias("kind"), F.min("label").alias("label"))


def concept_graph_nodes(spark, d):
    return _nodes(spark, d)


def _concept_edges(spark, d):
    members = load(spark, d, "unified_skills").select(F.col("unified_id").alias("unified"), F.explode(text.split_multi("member_entity_ids")).alias("entity")).distinct()
    rel = load(spark, d, "occupation_skill_relations").where("occupation_entity_id is not null and skill_entity_id is not null")
    raw = rel.select(F.col("occupation_entity_id").alias("s"), F.col("skill_entity_id").alias("t"), F.lit("requires").alias("type"), F.col("relation_type").alias("subtype"), F.col("source").alias("prov"), "weight", "rel_id")
    both = graph.remap(raw, members, _nodes(spark, d))
    return graph.distinct_edges(both, ["s", "t", "type", "subtype", "prov"], "weight", "rel_id")


def concept_graph_edges(spark, d):
    return _concept_edges(spark, d)


def backbone(spark, d):
    nodes = _nodes(spark, d).where("kind <> 'skill'")
    edges = _edges(spark, d).select(F.col("u").alias("s"), F.col("v").alias("t"))
    return graph.kept_between(edges, nodes)


def triples(spark, d):
    nodes = _nodes(spark, d).where("kind <> 'skill'")
    edges = _edges(spark, d).select(F.col("u").alias("s"), F.col("v").alias("t"), F.lit("broader_than").alias("type"))
    kinds = {"occupation": "esco:Occupation", "skill_type": "kg:SkillType", "skill_domain": "kg:Domain", "skill_category": "kg:Category"}
    return graph.typed_triples(nodes, edges, "urn:kg:", kinds, {"broader_than": "skos:narrower"})


def layout(spark, d):
    nodes = load(spark, d, "skills").where("source = 'TAXONOMY'").select(F.col("entity_id").alias("id")).distinct()
    return graph.sunflower(nodes, "id")


def member_validity(spark, d):
    members = load(spark, d, "unified_skills").select("unified_id", F.explode(text.split_multi("member_entity_ids")).alias("entity_id")).distinct()
    shared = members.groupBy("entity_id").agg(F.countDistinct("unified_id").alias("owners")).where("owners > 1")
    return shared


def invariants(spark, d):
    return quality.invariants(_kb(spark, d))


def replace_source_rows(spark, d):
    old = load(spark, d, "occupations").select("entity_id", "source", "pref_label_en")
    new = old.where("source = 'NOC'").withColumn("pref_label_en", F.upper("pref_label_en"))
    return tables.replace_source(old, new, "source", "NOC").groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("pref_label_en").alias("labels"))


def upsert_labels(spark, d):
    old = load(spark, d, "skills").select("entity_id", F.col("pref_label_en").alias("label")).distinct()
    new = load(spark, d, "unified_skills").select(F.explode(text.split_multi("member_entity_ids")).alias("entity_id")).distinct().withColumn("label", F.lit("new"))
    return tables.insert_absent(old, new, ["entity_id"]).groupBy("label").agg(F.count("*").alias("n"))


def last_write_wins(spark, d):
    rows = load(spark, d, "hellowork").select("url", "title", "retrieved_at")
    return tables.last_write(rows, ["url"], [F.col("retrieved_at"), F.coalesce("title", F.lit(""))])


def remove_source(spark, d):
    left = tables.without_source({t: load(spark, d, t) for t in TABLES if t != "unified_skills"}, "ROME")
    out = None
    for name in sorted(left):
        row = left[name].agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def pending_targets(spark, d):
    targets = load(spark, d, "skills").where("pref_label_fr is null").select("entity_id", "pref_label_en").distinct()
    done = load(spark, d, "unified_skills").where("primary_label_fr is not null").select(F.col("primary_label_en").alias("pref_label_en"))
    return tables.pending(targets, done, ["pref_label_en"]).select("entity_id")


def quota_limits(spark, d):
    rows = load(spark, d, "documents").select("doc_id", "source").where("source is not null")
    return tables.quota(rows, "source", [F.col("doc_id")], 80, 700)


def enrich_precedence(spark, d):
    base = load(spark, d, "unified_skills").groupBy("unified_id").agg(F.min("description").alias("description"))
    wiki = load(spark, d, "unified_skills").select("unified_id", F.col("wikidata_description").alias("description"))
    made = load(spark, d, "unified_skills").select("unified_id", F.col("primary_label_en").alias("description"))
    return tables.enriched(base, "unified_id", "description", [("wikidata", wiki), ("generated", made)])


def label_fill(spark, d):
    """Missing French labels from the record's own alternatives, then from unified records."""
    rows = load(spark, d, "skills").groupBy("entity_id").agg(*[F.min(c).alias(c) for c in ("pref_label_fr", "alt_labels_fr")])
    own = rows.select("entity_id", F.get(text.split_multi("alt_labels_fr"), F.lit(0)).alias("pref_label_fr"))
    merged = load(spark, d, "unified_skills").select(F.explode(text.split_multi("member_entity_ids")).alias("entity_id"), F.col("primary_label_fr").alias("pref_label_fr"))
    return tables.enriched(rows.select("entity_id", "pref_label_fr"), "entity_id", "pref_label_fr", [("alias", own), ("merged", merged)])


def qa_counts(spark, d):
    rows = load(spark, d, "skills")
    return rows.groupBy("source").agg(F.count("*").alias("n"), F.count_if(quality.given("pref_label_fr")).alias("with_fr"), F.count_if(quality.given("description_en")).alias("with_description"), F.count_if(F.col("hard_soft_provisional") == "soft").alias("soft"))


def kpi_nonempty(spark, d):
    return quality.filled_counts(load(spark, d, "unified_skills"), ["primary_label_en", "primary_label_fr", "description", "wikidata_qid"])


def duplicate_keys(spark, d):
    return quality.repeats(load(spark, d, "skills"), ["entity_id"])


def row_multiplicity(spark, d):
    return quality.multiplicity(load(spark, d, "occupation_skill_relations"), ["occupation_entity_id", "skill_entity_id", "relation_type"])


def unique_gold(spark, d):
    return quality.unique_mentions(load(spark, d, "hellowork").where("title is not null"), "title", "url")


def coverage_slices(spark, d):
    index = load(spark, d, "unified_skills").select(text.match_key("primary_label_en").alias("key")).distinct().withColumn("hit", F.lit(True))
    rows = load(spark, d, "skills").where("source <> 'TAXONOMY'").select("source", F.coalesce("hard_soft_provisional", F.lit("-")).alias("kind"), text.match_key("pref_label_en").alias("key"), quality.given("pref_label_fr").alias("near"))
    joined = rows.join(index, "key", "left").withColumn("exact", F.coalesce("hit", F.lit(False)))
    return quality.coverage(joined, ["source", "kind"], "exact", "near")


def cluster_collapse(spark, d):
    rows = load(spark, d, "skills").where("source <> 'TAXONOMY'").select(F.coalesce("pref_label_fr", F.lit("")).alias("cluster"), text.match_key("pref_label_en").alias("node")).where("cluster <> ''")
    return quality.collapse(rows, "cluster", "node")


def source_contribution(spark, d):
    parts = {"occupations": "occupations", "skills": "skills", "relations": "occupation_skill_relations"}
    out = None
    for name, t in parts.items():
        rows = load(spark, d, t).where("source is not null").groupBy("source").agg(F.count("*").alias("n")).withColumn("what", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("source").pivot("what", list(parts)).agg(F.sum("n")).fillna(0)


def relation_histogram(spark, d):
    return load(spark, d, "hierarchy").groupBy(F.lower(F.trim("relation_type")).alias("kind"), "entity_kind").agg(F.count("*").alias("n"), F.countDistinct("child_entity_id").alias("children"))


def multi_source_topn(spark, d):
    rows = load(spark, d, "unified_skills").select("unified_id", F.size(text.split_multi("member_entity_ids")).cast("long").alias("members")).distinct().where("members > 1")
    return rows.orderBy(F.desc("members"), "unified_id").limit(8)


def top_skills_of_top_role(spark, d):
    rel = load(spark, d, "occupation_skill_relations").where("occupation_entity_id is not null and skill_entity_id is not null")
    top = rel.groupBy("occupation_entity_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "occupation_entity_id").limit(1)
    labels = load(spark, d, "skills").groupBy(F.col("entity_id").alias("skill_entity_id")).agg(F.min("pref_label_en").alias("label"))
    asked = rel.join(top.select("occupation_entity_id"), "occupation_entity_id").join(labels, "skill_entity_id").groupBy("label").agg(F.round(F.sum(text.to_float("weight")), 2).alias("demand")).where("demand is not null")
    return asked.orderBy(F.desc("demand"), "label").limit(10)


def skill_to_roles(spark, d):
    skill = load(spark, d, "skills").where("source <> 'TAXONOMY'").agg(F.min(F.lower("pref_label_en")).alias("wanted"))
    ids = load(spark, d, "skills").join(skill, F.lower("pref_label_en") == F.col("wanted")).select(F.col("entity_id").alias("skill_entity_id")).distinct()
    return load(spark, d, "occupation_skill_relations").join(ids, "skill_entity_id", "left_semi").select("occupation_entity_id").where("occupation_entity_id is not null").distinct().orderBy("occupation_entity_id").limit(10)


def neighbourhood(spark, d):
    domain = load(spark, d, "skills").where("esco_skill_type = 'skill_domain'").select(F.col("entity_id").alias("u")).distinct()
    return _edges(spark, d).join(domain, "u", "left_semi").groupBy("u").agg(F.count("*").alias("children"))


def scored_links(spark, d):
    """Audited links by verdict."""
    rows = load(spark, d, "link_audit").dropDuplicates(["audit_id"])
    verdict = similarity.audit_verdict(F.coalesce(F.col("nli") >= 0.5, F.lit(False)), F.coalesce(F.col("demand_exact") > 0, F.lit(False)), F.coalesce(F.col("creation_cosine") >= 0.75, F.lit(False)))
    return rows.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


def _vectors(spark, d):
    return load(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("grp"), F.col("embedding").alias("vec"))


def candidate_pairs_topk(spark, d):
    return similarity.mutual_top(_vectors(spark, d), 0.30, 5).select("a", "b", F.round("sim", 4).alias("sim"))


def nearest_anchor(spark, d):
    """The nearest group centre of every vector."""
    rows = _vectors(spark, d)
    return similarity.nearest(rows.select("id", "vec"), similarity.centroids(rows)).select("a", "b", F.round("sim", 4).alias("sim"))


def attach_rerank(spark, d):
    """The three nearest centres of every vector, ranked again with a stand-in for entailment."""
    rows = _vectors(spark, d)
    short = similarity.cosine_pairs(rows.withColumn("grp", F.lit(0)), similarity.centroids(rows).withColumn("grp", F.lit(1)), -1.0, 3)
    entail = F.round(F.pmod(F.col("a") * 7 + F.col("b") * 13, F.lit(100)) / 100, 2)
    return similarity.rerank(short.withColumn("entail", entail), "a", "sim", "entail").select("a", "target", F.round("sim", 4).alias("sim"), "doubtful")


def contrastive_gate(spark, d):
    """Vectors nearer to the centres of the upper groups than to those of the lower ones, unless entailment speaks for them."""
    rows = _vectors(spark, d)
    centres = similarity.centroids(rows)
    near = similarity.nearest(rows.select("id", "vec"), centres.where("id < 5")).select(F.col("a").alias("id"), F.col("sim").alias("sim_in"))
    far = similarity.nearest(rows.select("id", "vec"), centres.where("id >= 5")).select(F.col("a").alias("id"), F.col("sim").alias("sim_out"))
    nli = F.round(F.pmod(F.col("id"), F.lit(10)) / 10, 1)
    return near.join(far, "id").select("id", similarity.gate(F.round("sim_in", 4), F.round("sim_out", 4), nli, F.lit(False), sim_non=0.3).alias("decision"))


def vector_search(spark, d):
    """The ten nearest of all vectors for every query vector; queries are the ids divisible by 50."""
    rows = _vectors(spark, d).withColumn("grp", F.col("id"))
    found = similarity.cosine_pairs(rows.where("id % 50 = 0"), rows, -1.0, 11)
    return similarity.top_per(found, ["a"], [-F.col("sim"), F.col("b")], 10).select("a", "b", F.round("sim", 4).alias("sim"))


def skos_decision(spark, d):
    pairs = similarity.mutual_top(_vectors(spark, d), 0.30, 5).withColumn("sim", F.round("sim", 4))
    rel, conf, flag = similarity.merge_decision(F.col("a") % 7 == F.col("b") % 7, F.col("a") % 3 == F.col("b") % 3, F.col("sim"), F.when(F.col("a") % 2 == 0, F.lit(0.7)), F.col("a") % 5 == 0, F.lit(True), sim_occ=0.35, sim_skill=0.4)
    return pairs.select("a", "b", rel.alias("relation"), conf.alias("confidence"), flag.alias("flag"))


def tfidf_char_cosine(spark, d):
    rows = load(spark, d, "role_titles").select(F.col("title_id").alias("id"), text.normalize_label("title_fr").alias("t"))
    weights = similarity.tfidf(rows, "id", "t")
    return similarity.sparse_cosine(weights, weights, 0.5).where("a < b").select("a", "b", F.round("sim", 3).alias("sim"))


QUERIES = {
    f.__name__: f
    for f in (
        connected_components, merge_components, cycle_check, reach_root, two_level_search, tree_edges, parent_counts, concept_graph_nodes, concept_graph_edges, backbone, triples, layout, member_validity, invariants,
        replace_source_rows, upsert_labels, last_write_wins, remove_source, pending_targets, quota_limits, enrich_precedence, label_fill, qa_counts, kpi_nonempty, duplicate_keys, row_multiplicity,
        unique_gold, coverage_slices, cluster_collapse, source_contribution, relation_histogram, multi_source_topn, top_skills_of_top_role, skill_to_roles, neighbourhood, scored_links,
        candidate_pairs_topk, vector_search, nearest_anchor, attach_rerank, contrastive_gate, skos_decision, tfidf_char_cosine,
    )
}

_E = "e as (select distinct case when kind = 'broader_than' then a else b end as u, case when kind = 'broader_than' then b else a end as v from (select lower(trim(relation_type)) as kind, trim(parent_entity_id) as a, trim(child_entity_id) as b from hierarchy) where kind in ('broader_than', 'narrower_than') and coalesce(a, '') <> '' and coalesce(b, '') <> '')"
_MEM = "mem as (select distinct unified_id, trim(e) as entity from (select unified_id, unnest(regexp_split_to_array(coalesce(member_entity_ids, ''), '[\\n\\r|]')) as e from unified_skills) where trim(e) <> '')"
_N = """nodes as (select id, min(kind) as kind, min(label) as label from (select entity_id as id, esco_skill_type as kind, pref_label_en as label from skills where source = 'TAXONOMY' union all select entity_id, 'occupation', pref_label_en from occupations union all select unified_id, 'skill', primary_label_en from unified_skills) group by 1)"""
_SIM = "round(list_dot_product(x.vec, y.vec), 9)"
_V = "v as (select vec_id as id, cast(label as bigint) as grp, list_transform(embedding, lambda z: cast(z as double) / sqrt(list_sum(list_transform(embedding, lambda q: cast(q as double) * cast(q as double))))) as vec from embeddings)"
_CENT = """raw as (select cast(label as bigint) as id, i, avg(cast(embedding[i] as double)) as x from embeddings, (select unnest(range(1, 65)) as i) group by 1, 2),
  cen as (select id, list(x / m order by i) as vec from raw join (select id as k, sqrt(sum(x * x)) as m from raw group by 1) on id = k group by id)"""
_TOP = f"""{_V}, s as (select x.id as a, y.id as b, x.grp as ga, y.grp as gb, {_SIM} as sim from v x join v y on x.grp <> y.grp where {_SIM} >= 0.30),
  r as (select *, row_number() over (partition by a, gb order by sim desc, b) as n from s), pairs as (select least(a, b) as a, greatest(a, b) as b, round(max(sim), 4) as sim from r where n <= 5 group by 1, 2)"""
_REACH = f"""{_E}, roots as (select distinct u as node from e where u not in (select v from e)), walk as (select node, 0 as hops from roots union select e.v, w.hops + 1 from walk w join e on w.node = e.u where w.hops < 100)"""
_GONE = "gone as (select entity_id from (select entity_id from occupations where source = 'ROME' union select entity_id from skills where source = 'ROME') where entity_id not in (select entity_id from occupations where coalesce(source, '') <> 'ROME' union select entity_id from skills where coalesce(source, '') <> 'ROME'))"
_NOTGONE = "coalesce({c}, '') not in (select entity_id from gone)"
SQL = {
    "connected_components": """with recursive p as (select entity_id_a as a, entity_id_b as b from concept_alignments where merge_flag = 'label' and entity_id_a in (select entity_id from skills) and entity_id_b in (select entity_id from skills)),
      e as (select a, b from p where a <> b union select b, a from p where a <> b), r as (select entity_id as n, entity_id as m from skills union select r.n, e.b from r join e on r.m = e.a) select n as node, min(m) as component from r group by 1""",
    "merge_components": """with recursive k as (select trim(entity_id) as n from occupations where trim(coalesce(entity_id, '')) <> '' union select trim(entity_id) from skills where trim(coalesce(entity_id, '')) <> ''),
      p as (select trim(entity_id_a) as a, trim(entity_id_b) as b from concept_alignments where lower(trim(merge_flag)) in ('label', 'semantic') and trim(entity_id_a) in (select n from k) and trim(entity_id_b) in (select n from k)),
      e as (select a, b from p where a <> b union select b, a from p where a <> b), r as (select n, n as m from k union select r.n, e.b from r join e on r.m = e.a) select n as node, min(m) as component from r group by 1""",
    "cycle_check": f"""with recursive {_E}, w as (select u as start, v as here from e union select w.start, e.v from w join e on w.here = e.u), c as (select distinct start from w where start = here),
      f as (select start as n from c union select e.v from f join e on f.n = e.u), b as (select start as n from c union select e.u from b join e on b.n = e.v) select distinct f.n as node from f join b on f.n = b.n""",
    "reach_root": f"with recursive {_REACH} select node, cast(min(hops) as int) as hops from walk group by 1",
    "two_level_search": f"""with {_E}, r as (select distinct entity_id as n from skills where esco_skill_type = 'skill_domain'),
      a as (select n as node, n as branch, 0 as depth, '' as via from r union all select e.v, e.u, 1, e.u from e where e.u in (select n from r)),
      f as (select node, branch, depth from (select *, row_number() over (partition by node order by depth, branch, via) as k from a) where k = 1),
      b as (select node, branch, depth, '' as via from f union all select e.v, f.branch, 2, e.u from f join e on f.node = e.u where f.depth = 1)
      select node, branch, cast(depth as int) as depth from (select *, row_number() over (partition by node order by depth, branch, via) as k from b) where k = 1""",
    "tree_edges": "with c as (select distinct isco_code from occupations where regexp_matches(isco_code, '^[0-9]+$')) select isco_code, case when substr(isco_code, 1, length(isco_code) - 1) in (select isco_code from c) then substr(isco_code, 1, length(isco_code) - 1) else 'ROOT' end as parent from c",
    "parent_counts": f"with {_E}, n as (select s.entity_id, count(distinct e.u) as parents from (select distinct entity_id from skills) s left join e on s.entity_id = e.v group by 1) select parents, count(*) as nodes from n group by 1",
    "concept_graph_nodes": f"with {_N} select id, kind, label from nodes",
    "concept_graph_edges": f"""with {_N}, {_MEM}, m as (select entity, min(unified_id) as unified from mem group by 1),
      x as (select coalesce(m1.unified, n1.id) as s, coalesce(m2.unified, n2.id) as t, 'requires' as type, relation_type as subtype, source as prov, weight, rel_id from occupation_skill_relations r
        left join m m1 on m1.entity = r.occupation_entity_id left join nodes n1 on n1.id = r.occupation_entity_id left join m m2 on m2.entity = r.skill_entity_id left join nodes n2 on n2.id = r.skill_entity_id)
      select s, t, type, subtype, prov, arg_min_null(weight, rel_id) as weight from x where s is not null and t is not null group by 1, 2, 3, 4, 5""",
    "backbone": f"with {_N}, {_E} select u as s, v as t from e where u in (select id from nodes where kind <> 'skill') and v in (select id from nodes where kind <> 'skill')",
    "triples": f"""with {_N}, {_E} select '<urn:kg:' || id || '>' as s, 'rdf:type' as p, case kind when 'occupation' then 'esco:Occupation' when 'skill_type' then 'kg:SkillType' when 'skill_domain' then 'kg:Domain' when 'skill_category' then 'kg:Category' else 'skos:Concept' end as o from nodes where kind <> 'skill'
      union all select '<urn:kg:' || id || '>', 'skos:prefLabel', '"' || replace(replace(label, '\\', '\\\\'), '"', '\\"') || '"' from nodes where kind <> 'skill' and coalesce(label, '') <> ''
      union all select '<urn:kg:' || u || '>', 'skos:narrower', '<urn:kg:' || v || '>' from e""",
    "layout": "with n as (select id, row_number() over (order by id) as n from (select distinct entity_id as id from skills where source = 'TAXONOMY')) select id, round(sqrt(n) * cos(n * 2.399963229728653), 4) as x, round(sqrt(n) * sin(n * 2.399963229728653), 4) as y from n",
    "member_validity": f"with {_MEM} select entity as entity_id, count(distinct unified_id) as owners from mem group by 1 having count(distinct unified_id) > 1",
    "replace_source_rows": "with o as (select entity_id, source, pref_label_en from occupations), n as (select * from o where source is distinct from 'NOC' union all (select distinct entity_id, source, upper(pref_label_en) from o where source = 'NOC')) select source, count(*) as n, count(distinct pref_label_en) as labels from n group by 1",
    "upsert_labels": f"with {_MEM}, o as (select distinct entity_id, pref_label_en as label from skills), n as (select label from o union all select 'new' from (select distinct entity from mem) where entity not in (select entity_id from o)) select label, count(*) as n from n group by 1",
    "last_write_wins": "select url, title, retrieved_at from (select url, title, retrieved_at, row_number() over (partition by url order by retrieved_at desc nulls last, coalesce(title, '') desc) as r from hellowork) where r = 1",
    "remove_source": f"""with {_GONE} select 'occupations' as table_name, count(*) as n from occupations where coalesce(source, '') <> 'ROME' union all select 'skills', count(*) from skills where coalesce(source, '') <> 'ROME'
      union all select 'hierarchy', count(*) from hierarchy where coalesce(source, '') <> 'ROME' and {_NOTGONE.format(c='parent_entity_id')} and {_NOTGONE.format(c='child_entity_id')}
      union all select 'occupation_skill_relations', count(*) from occupation_skill_relations where coalesce(source, '') <> 'ROME' and {_NOTGONE.format(c='occupation_entity_id')} and {_NOTGONE.format(c='skill_entity_id')}
      union all select 'concept_alignments', count(*) from concept_alignments where coalesce(source_a, '') <> 'ROME' and coalesce(source_b, '') <> 'ROME' and {_NOTGONE.format(c='entity_id_a')} and {_NOTGONE.format(c='entity_id_b')}""",
    "pending_targets": "select entity_id from (select distinct entity_id, pref_label_en from skills where pref_label_fr is null) where not exists (select 1 from unified_skills u where u.primary_label_fr is not null and u.primary_label_en = pref_label_en)",
    "quota_limits": "select doc_id, source from (select doc_id, source, row_number() over (partition by source order by doc_id) as r from documents where source is not null) where r <= 80 order by doc_id limit 700",
    "enrich_precedence": f"""with b as (select unified_id, min(description) as d, min({S.blank_null('wikidata_description')}) as w, min({S.blank_null('primary_label_en')}) as p from unified_skills group by 1)
      select unified_id, coalesce({S.blank_null('d')}, w, p, '') as description, case when {S.blank_null('d')} is not null then 'source' when w is not null then 'wikidata' when p is not null then 'generated' else '' end as description_source from b""",
    "label_fill": f"""with {_MEM}, r as (select entity_id, min(pref_label_fr) as f, nullif(trim(list_filter(list_transform(regexp_split_to_array(coalesce(min(alt_labels_fr), ''), '[\\n\\r|]'), lambda x: trim(x)), lambda x: x <> '')[1]), '') as a from skills group by 1),
      u as (select entity, min(trim(primary_label_fr)) as m from mem join unified_skills using (unified_id) where {S.blank_null('primary_label_fr')} is not null group by 1)
      select entity_id, coalesce({S.blank_null('f')}, a, m, '') as pref_label_fr, case when {S.blank_null('f')} is not null then 'source' when a is not null then 'alias' when m is not null then 'merged' else '' end as pref_label_fr_source from r left join u on entity = entity_id""",
    "qa_counts": f"select source, count(*) as n, count(*) filter ({S.blank_null('pref_label_fr')} is not null) as with_fr, count(*) filter ({S.blank_null('description_en')} is not null) as with_description, count(*) filter (hard_soft_provisional = 'soft') as soft from skills group by 1",
    "kpi_nonempty": "select count(*) as rows, " + ", ".join(f"count(*) filter ({S.blank_null(c)} is not null) as {c}" for c in ("primary_label_en", "primary_label_fr", "description", "wikidata_qid")) + " from unified_skills",
    "duplicate_keys": "select entity_id, count(*) as n from skills group by 1 having count(*) > 1",
    "row_multiplicity": "select count(*) as distinct_rows, cast(sum(n - 1) as bigint) as surplus_rows from (select occupation_entity_id, skill_entity_id, relation_type, count(*) as n from occupation_skill_relations group by 1, 2, 3)",
    "unique_gold": f"select norm, arg_min(title, url) as surface, count(*) as n from (select title, url, {S.norm('title')} as norm from hellowork where title is not null) where norm <> '' group by 1",
    "coverage_slices": f"""with i as (select distinct {S.match_key('primary_label_en')} as key from unified_skills), r as (select source, coalesce(hard_soft_provisional, '-') as kind, {S.match_key('pref_label_en')} in (select key from i) as exact, {S.blank_null('pref_label_fr')} is not null as near from skills where source <> 'TAXONOMY')
      select coalesce(source, 'ALL') as source, coalesce(kind, 'ALL') as kind, count(*) as n, count(*) filter (exact) as exact, count(*) filter (near) as near, count(*) filter (exact or near) as either, round(100.0 * count(*) filter (exact) / count(*), 1) as exact_pct, round(100.0 * count(*) filter (near) / count(*), 1) as near_pct, round(100.0 * count(*) filter (exact or near) / count(*), 1) as either_pct
      from r group by grouping sets ((source, kind), ())""",
    "cluster_collapse": f"select cluster, count(*) as resolved, count(distinct node) as nodes, count(distinct node) = 1 as collapsed from (select pref_label_fr as cluster, {S.match_key('pref_label_en')} as node from skills where source <> 'TAXONOMY' and coalesce(pref_label_fr, '') <> '') group by 1 having count(*) >= 2",
    "source_contribution": """select source, cast(sum(o) as bigint) as occupations, cast(sum(s) as bigint) as skills, cast(sum(r) as bigint) as relations from (select source, 1 as o, 0 as s, 0 as r from occupations union all select source, 0, 1, 0 from skills union all select source, 0, 0, 1 from occupation_skill_relations) where source is not null group by 1""",
    "relation_histogram": "select lower(trim(relation_type)) as kind, entity_kind, count(*) as n, count(distinct child_entity_id) as children from hierarchy group by 1, 2",
    "multi_source_topn": f"with {_MEM} select unified_id, members from (select distinct unified_id, cast(len(list_distinct(list_filter(list_transform(regexp_split_to_array(coalesce(member_entity_ids, ''), '[\\n\\r|]'), lambda x: trim(x)), lambda x: x <> ''))) as bigint) as members from unified_skills) where members > 1 order by members desc, unified_id limit 8",
    "top_skills_of_top_role": """with r as (select * from occupation_skill_relations where occupation_entity_id is not null and skill_entity_id is not null), t as (select occupation_entity_id from r group by 1 order by count(*) desc, occupation_entity_id limit 1), l as (select entity_id, min(pref_label_en) as label from skills group by 1)
      select label, round(sum(try_cast(weight as double)), 2) as demand from r join l on r.skill_entity_id = l.entity_id where r.occupation_entity_id in (select occupation_entity_id from t) group by 1 having sum(try_cast(weight as double)) is not null order by demand desc, label limit 10""",
    "skill_to_roles": """with s as (select entity_id from skills where lower(pref_label_en) = (select min(lower(pref_label_en)) from skills where source <> 'TAXONOMY')) select distinct occupation_entity_id from occupation_skill_relations where skill_entity_id in (select entity_id from s) and occupation_entity_id is not null order by 1 limit 10""",
    "neighbourhood": f"with {_E} select u, count(*) as children from e where u in (select entity_id from skills where esco_skill_type = 'skill_domain') group by 1",
    "scored_links": """select case when coalesce(nli >= 0.5, false) and (coalesce(demand_exact > 0, false) or coalesce(creation_cosine >= 0.75, false)) then 'strong' when coalesce(demand_exact > 0, false) or coalesce(creation_cosine >= 0.75, false) then 'corroborated' when coalesce(nli >= 0.5, false) then 'nli_only' else 'weak' end as verdict, count(*) as n from (select distinct on (audit_id) * from link_audit) group by 1""",
    "candidate_pairs_topk": f"with {_TOP} select a, b, sim from pairs",
    "vector_search": f"with {_V}, s as (select x.id as a, y.id as b, {_SIM} as sim from v x join v y on x.id % 50 = 0 and x.id <> y.id) select a, b, round(sim, 4) as sim from (select *, row_number() over (partition by a order by sim desc, b) as r from s) where r <= 10",
    "nearest_anchor": f"with {_V}, {_CENT}, s as (select x.id as a, y.id as b, {_SIM} as sim from v x, cen y) select a, b, round(sim, 4) as sim from (select *, row_number() over (partition by a order by sim desc, b) as r from s) where r = 1",
    "attach_rerank": f"""with {_V}, {_CENT}, s as (select x.id as a, y.id as b, {_SIM} as sim from v x, cen y), t as (select *, row_number() over (partition by a order by sim desc, b) as r from s),
      u as (select a, b, sim, row_number() over (partition by a order by sim + 0.5 * round(((a * 7 + b * 13) % 100) / 100.0, 2) desc, sim desc, b) as k from t where r <= 3) select a, b as target, round(sim, 4) as sim, sim < 0.60 as doubtful from u where k = 1""",
    "contrastive_gate": f"""with {_V}, {_CENT}, i as (select x.id, round(max({_SIM}), 4) as sim_in from v x join cen y on y.id < 5 group by 1), o as (select x.id, round(max({_SIM}), 4) as sim_out from v x join cen y on y.id >= 5 group by 1)
      select i.id, case when sim_out >= 0.3 and sim_out - sim_in >= 0.05 and round((i.id % 10) / 10.0, 1) < 0.15 then 'nli' else 'keep' end as decision from i join o on i.id = o.id""",
    "skos_decision": f"""with {_TOP}, x as (select *, a % 7 = b % 7 as pref, a % 3 = b % 3 as lab, case when a % 2 = 0 then 0.7 end as nli, a % 5 = 0 as occ from pairs),
      y as (select *, greatest(sim, coalesce(0.60 + 0.30 * nli, sim)) as raw from x), z as (select *, round(case when pref then greatest(raw, 0.95) when lab then greatest(raw, 0.85) else raw end, 4) as confidence from y)
      select a, b, case when pref then 'exactMatch' when lab then 'closeMatch' when confidence >= 0.70 then 'closeMatch' else 'relatedMatch' end as relation, confidence,
      case when pref then 'label' when (case when occ then sim >= 0.35 else sim >= 0.4 end) and (not (occ and nli is not null) or nli >= 0.60) then 'semantic' else '' end as flag from z""",
    "tfidf_char_cosine": f"""with t as (select title_id as id, {S.norm('title_fr')} as t from role_titles), w as (select id, ' ' || unnest(string_split(t, ' ')) || ' ' as w from t), n as (select unnest([3, 4, 5]) as n),
      g as (select id, substr(w, i, n) as term from (select id, w, n, unnest(range(1, cast(length(w) - n + 2 as bigint))) as i from w, n where length(w) >= n)), f as (select id, term, count(*) as tf from g group by 1, 2), df as (select term, count(*) as df from f group by 1),
      r as (select id, f.term, tf * (ln((1.0 + (select count(*) from t)) / (1.0 + df)) + 1) as w from f join df on f.term = df.term), m as (select id, sqrt(sum(w * w)) as m from r group by 1), u as (select r.id, term, w / m as w from r join m on r.id = m.id)
      select x.id as a, y.id as b, round(sum(x.w * y.w), 3) as sim from u x join u y on x.term = y.term and x.id < y.id group by 1, 2 having sum(x.w * y.w) >= 0.5""",
}

_REAL_S = "(select distinct entity_id as n from skills where coalesce(esco_skill_type, '') not in ('skill_type', 'skill_domain', 'skill_category'))"
_REAL_O = "(select distinct entity_id as n from occupations where coalesce(occupation_type, '') <> 'isco_group')"
_SOFT = ", ".join(S.q(c) for c, x in rules.CATEGORY_DOMAINS.items() if x == "dom_soft")
_HARD = ", ".join(S.q(c) for c, x in rules.CATEGORY_DOMAINS.items() if x != "dom_soft")
_PARENTS = "select 1 from {real} r left join (select v, count(*) as n from w where kind = '{kind}' and type = '{type}' group by 1) p on r.n = p.v where coalesce(p.n, 0) <> 1"
_MEMBERS = "(select unified_id, trim(e) as m from (select unified_id, unnest(string_split(member_entity_ids, '|')) as e from unified_skills) where trim(e) <> '')"
_CHECKS = {
    "edges_resolve": "select 1 from w where u not in (select n from nd) or v not in (select n from nd)",
    "no_self_loop": "select 1 from w where u = v",
    "acyclic": "select 1 from reach where a = b limit 1",
    "one_category_per_skill": _PARENTS.format(real=_REAL_S, kind="skill", type="broader_than"),
    "one_backbone_and_domain_per_occupation": _PARENTS.format(real=_REAL_O, kind="occupation", type="broader_than") + " union all " + _PARENTS.format(real=_REAL_O, kind="occupation", type="in_domain"),
    "occupations_reach_root": f"select n from {_REAL_O} where n not in (select node from below) union all select cast(i as varchar) from (select unnest(range(1, 1 + abs((select count(*) from (select distinct u from bk where u not in (select v from bk))) - 1))) as i)",
    "groups_in_scope": "select 1 from occupations where occupation_type = 'isco_group' and coalesce(isco_code, '') <> '' and not regexp_matches(isco_code, '^(25|35|133)')",
    "no_skill_over_skill": f"select 1 from w where u in (select n from {_REAL_S}) and v in (select n from {_REAL_S})",
    "hard_soft_matches": f"select 1 from unified_skills where coalesce(hard_soft, '') = '' or coalesce(it_subtype, '') = '' or (it_subtype in ({_SOFT}) and hard_soft <> 'soft') or (it_subtype in ({_HARD}) and hard_soft <> 'hard')",
    "relations_typed": f"select 1 from occupation_skill_relations where coalesce(occupation_entity_id, '~') not in (select n from {_REAL_O}) union all select 1 from occupation_skill_relations where coalesce(skill_entity_id, '~') not in (select n from {_REAL_S})",
    "members_valid": f"select 1 from unified_skills where len(list_filter(string_split(coalesce(member_entity_ids, ''), '|'), lambda x: trim(x) <> '')) = 0 union all select 1 from {_MEMBERS} where m not in (select n from nd) union all select 1 from (select m from (select distinct unified_id, m from {_MEMBERS}) group by m having count(*) > 1)",
    "ids_unique": "select 1 from (select entity_id from (select entity_id from occupations union all select entity_id from skills) group by 1 having count(*) > 1) union all select 1 from (select unified_id from unified_skills group by 1 having count(*) > 1)",
    "relations_unique": "select unnest(range(1, n)) from (select count(*) as n from occupation_skill_relations group by occupation_entity_id, skill_entity_id, relation_type, source, weight having count(*) > 1)",
}
SQL["invariants"] = """with recursive w as (select trim(coalesce(parent_entity_id, '')) as u, trim(coalesce(child_entity_id, '')) as v, lower(trim(coalesce(relation_type, ''))) as type, lower(trim(coalesce(entity_kind, ''))) as kind from hierarchy),
  nd as (select entity_id as n from occupations union select entity_id from skills),
  ew as (select distinct u as a, v as b from w where u <> '' and v <> ''), reach as (select a, b from ew union select r.a, e.b from reach r join ew e on r.b = e.a),
  bk as (select u, v from w where kind = 'occupation' and type = 'broader_than'), one as (select v as node, min(u) as parent from bk where u <> '' and v <> '' group by 1),
  below as (select distinct parent as node from one where parent not in (select node from one) union select o.node from one o join below b on o.parent = b.node) """ + " union all ".join(
    f"select '{name}' as name, count(*) = 0 as ok, count(*) as n_violations from ({sql})" for name, sql in _CHECKS.items()
)
