"""Curating a knowledge base: what is kept out, what is put in by hand, and what outside records add.

All of it is projections and joins with lists; the lists are parameters and carry no hint, so the planner broadcasts
small ones.  Blank and null are the same everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxoloom.functions.rules import CATEGORY_DOMAINS
from taxoloom.functions.text import clean_aliases, mint_id, normalize_label, split_multi
from taxoloom.operators import graph, tables
from taxoloom.operators.similarity import dot
from taxoloom.session import bare

# The tiers of the skill ontology, key -> label, and each domain's type.
TYPE_LABELS = {"hard": "Technical skills", "soft": "Soft & transversal skills"}
DOMAIN_LABELS = {
    "dom_software": "Software Development", "dom_web_mobile": "Web & Mobile Development", "dom_data_ai": "Data, Analytics & AI", "dom_infra_cloud": "Infrastructure, Systems & Cloud",
    "dom_networks": "Networks & Telecommunications", "dom_security": "Cybersecurity", "dom_it_mgmt": "IT Management, Governance & Support", "dom_emerging": "Emerging Technologies",
    "dom_cross": "General & Cross-cutting IT", "dom_soft": "Soft & Transversal Skills",
}
CATEGORY_LABELS = {
    "programming_languages": "Programming & software development", "methodology": "Methodologies & practices", "web": "Web development", "mobile_development": "Mobile development",
    "data_databases": "Databases & data management", "data_engineering": "Big data & data engineering", "ai_ml": "AI & machine learning", "systems_infrastructure": "Systems & infrastructure",
    "cloud_devops": "Cloud & DevOps", "hardware_embedded": "Hardware & embedded systems", "networks": "Networks & telecom", "security": "Security & cybersecurity",
    "it_management": "IT management & governance", "emerging_tech": "Emerging tech (IoT, AR/VR, blockchain)", "knowledge_general": "General IT knowledge", "other_hard": "Other technical",
    "soft_cognitive": "Cognitive: creativity & problem-solving", "soft_self_management": "Self-management, resilience & dependability", "soft_collaboration": "Communication & collaboration",
    "soft_leadership": "Leadership & social influence", "soft_learning": "Curiosity & lifelong learning", "soft_transversal": "Soft & transversal (other)",
}
# Categories of skills whose sources disagree, by folded primary label.
SUBTYPE_OVERRIDES = {
    "cypress": "web", "playwright": "web", "cdn": "cloud_devops", "consul": "cloud_devops", "a/b testing": "methodology", "test driven development": "methodology", "workflow software": "other_hard",
    "distributed computing": "knowledge_general", "computer science": "knowledge_general", "computer technology": "knowledge_general", "digital systems": "knowledge_general",
    "information systems": "knowledge_general", "cryptocurrency": "emerging_tech",
}
# How outside records are described that only share a name.
HOMONYMS = (
    r"\b(city|town|village|municipality|commune|hamlet|borough|county|province|prefecture|human settlement|census-designated place)\b",
    r"\b(journal|magazine|periodical|newspaper|manga|book series|anthology)\b",
    r"\bcomic books?\b|\bcomics\b|\bgraphic novel\b",
    r"\b(feature film|film directed|album by|studio album|song by|musical group|rock band)\b",
    r"\b(river|mountain|lake|island|airport|railway station|crater|asteroid|moth|butterfly)\b",
    r"\b(given name|surname|family name|first name|footballer|politician|actor|actress)\b",
    r"\bvideo game (publisher|developer|company|console|series)\b",
    r"\b(19|20)\d\d video game\b",
    r"\bStack Exchange site\b",
    r"\bWikimedia (template|category|module|project|permanent duplicate|duplicat)",
    r"\bsystem tray\b",
    r"\bnews (website|site|and media website)\b",
)
# What the titles of postings of the field hold.
TITLE_HINTS = (
    "developer", "engineer", "programmer", "software", "devops", "sysadmin", "sre", "backend", "back-end", "back end", "frontend", "front-end", "front end", "full stack", "fullstack",
    "data scientist", "data engineer", "data analyst", "machine learning", " ml ", " ai ", "web develop", "mobile develop", "cloud", "cyber", "security engineer", "qa engineer",
    "platform engineer", "site reliability", "architect", "it support", "technical support",
)


# --- predicates


def excluded(rows: DataFrame, label: str, names: DataFrame, name: str = "name") -> DataFrame:
    """Rows whose folded label is on a list of unwanted ones left out."""
    keys = names.select(normalize_label(name).alias("_key")).where("_key <> ''").distinct()
    return rows.withColumn("_key", normalize_label(label)).join(keys, "_key", "left_anti").drop("_key")


def spoken(lang: str, accepted: tuple[str, ...]) -> Column:
    """Whether a language tag, case, blanks and region aside, is an accepted one; '' accepts a missing tag."""
    return F.regexp_extract(F.lower(bare(lang)), "^[a-z]*", 0).isin(*accepted)


def homonym(description: Column | str) -> Column:
    """Whether an outside description tells of something else of that name."""
    text = F.coalesce(F.col(description) if isinstance(description, str) else description, F.lit(""))
    return text.rlike("(?i)" + "|".join(f"(?:{p})" for p in HOMONYMS))


def short_label(label: str, kind: str, kinds: tuple[str, ...], most: int = 3) -> Column:
    """Labels of given kinds with at most ``most`` words: those worth looking up by name."""
    text = bare(label)
    return F.col(kind).isin(*kinds) & (text != "") & (F.size(F.split(text, "\\s+")) <= most)


def hinted(title: str, hints: tuple[str, ...] = TITLE_HINTS) -> Column:
    """Whether a title, with a blank on both sides, holds any of the hints."""
    text = F.concat(F.lit(" "), F.lower(F.coalesce(F.col(title), F.lit(""))), F.lit(" "))
    return F.exists(F.array(*[F.lit(h) for h in hints]), lambda h: F.contains(text, h))


def profile_text(label: str, alts: str, description: str, most: int = 300) -> Column:
    """What a record is compared by: label, alternatives and the opening of the description, blank ones left out."""
    parts = F.array(bare(label), F.array_join(split_multi(alts), ", "), F.substring(bare(description), 1, most))
    return F.array_join(F.filter(parts, lambda x: x != ""), ". ")


def overlap(a: Column, b: Column) -> Column:
    """The entries two lists share, in the order of the first."""
    return F.array_intersect(a, b)


def label_tests(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) with ``pref``, whether preferred keys meet, and ``any``, whether any do; ``labels`` has (id, pref, every), arrays of keys."""
    a, b = (labels.select(F.col("id").alias(s), F.col("pref").alias(f"_p{s}"), F.col("every").alias(f"_e{s}")) for s in "ab")
    met = pairs.join(a, "a", "left").join(b, "b", "left")
    hit = lambda x, y: F.coalesce(F.arrays_overlap(x, y), F.lit(False))
    return met.withColumns({"pref": hit("_pa", "_pb"), "any": hit("_ea", "_eb")}).drop("_pa", "_pb", "_ea", "_eb")


def either(rows: DataFrame, names: tuple[str, ...]) -> Column:
    """A column under whichever of its spellings the table has; '' if it has none."""
    there = [bare(n) for n in names if n in rows.columns]
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in there], F.lit("")) if there else F.lit("")


# --- the ontology and what is put in by hand


def taxonomy(spark: SparkSession, source: str = "TAXONOMY") -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the three tiers: types, domains, categories, and each one's parent."""
    soft = "dom_soft"
    rows = [("SKT_", f"type:{k}", v, k, "skill_type", k, None) for k, v in TYPE_LABELS.items()]
    rows += [("SKD_", f"domain:{k}", v, "soft" if k == soft else "hard", "skill_domain", k, ("SKT_", "type:" + ("soft" if k == soft else "hard"))) for k, v in DOMAIN_LABELS.items()]
    rows += [("SKC_", f"category:{k}", v, "soft" if CATEGORY_DOMAINS[k] == soft else "hard", "skill_category", k, ("SKD_", f"domain:{CATEGORY_DOMAINS[k]}")) for k, v in CATEGORY_LABELS.items()]
    flat = [(p, i, label, hs, kind, sub, *(up or ("", ""))) for p, i, label, hs, kind, sub, up in rows]
    table = spark.createDataFrame(flat, "prefix string, source_id string, pref_label_en string, hard_soft_provisional string, esco_skill_type string, it_subtype string, up_prefix string, up string")
    own = F.concat("prefix", mint_id("", F.lit(source), "source_id"))
    nodes = table.select(own.alias("entity_id"), F.lit(source).alias("source"), "source_id", "pref_label_en", "hard_soft_provisional", "esco_skill_type", "it_subtype")
    edges = table.where("up <> ''").select(F.concat("up_prefix", mint_id("", F.lit(source), "up")).alias("parent_entity_id"), own.alias("child_entity_id"), F.lit("skill").alias("entity_kind"), F.lit("broader_than").alias("relation_type"), F.lit(source).alias("source"))
    return nodes, edges


def placed_skills(skills: DataFrame, categories: DataFrame, source: str = "TAXONOMY") -> DataFrame:
    """One edge from each real skill to the node of its category; ``categories`` has (entity_id, it_subtype)."""
    nodes = categories.where("esco_skill_type = 'skill_category'").groupBy("it_subtype").agg(F.min("entity_id").alias("parent_entity_id"))
    real = skills.where("coalesce(source, '') <> 'TAXONOMY'").groupBy(F.col("entity_id").alias("child_entity_id")).agg(F.min("it_subtype").alias("it_subtype"))
    return real.join(nodes, "it_subtype").select("parent_entity_id", "child_entity_id", F.lit("skill").alias("entity_kind"), F.lit("broader_than").alias("relation_type"), F.lit(source).alias("source"))


def overlay(skills: DataFrame, collection: DataFrame, source: str, prefix: str = "SKL_") -> DataFrame:
    """Skills with a hand-made collection laid over those of one source: listed ones become soft, lacking ones are added.

    ``collection`` has (source_id, pref_label_en), free of unwanted labels.
    """
    listed = collection.where(bare("source_id") != "").groupBy("source_id").agg(F.min("pref_label_en").alias("_label"))
    here = F.col("source").eqNullSafe(source) & F.col("_label").isNotNull()
    marked = skills.join(listed, "source_id", "left")
    marked = marked.withColumns({"hard_soft_provisional": F.when(here, "soft").otherwise(F.col("hard_soft_provisional")), "hard_soft_method": F.when(here, "collection").otherwise(F.col("hard_soft_method"))})
    lacking = listed.join(skills.where(F.col("source") == source).select("source_id").distinct(), "source_id", "left_anti")
    new = lacking.select(mint_id(prefix, F.lit(source), "source_id").alias("entity_id"), F.lit(source).alias("source"), "source_id", F.col("_label").alias("pref_label_en"), F.lit("soft").alias("hard_soft_provisional"), F.lit("collection").alias("hard_soft_method"))
    return marked.select(*skills.columns).unionByName(new, allowMissingColumns=True)


def overridden(rows: DataFrame, label: str, field: str, values: dict[str, str] = SUBTYPE_OVERRIDES) -> DataFrame:
    """A field set by hand for some folded labels."""
    table = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return rows.withColumn(field, F.coalesce(F.try_element_at(table, normalize_label(label)), F.col(field)))


def literal_rows(spark: SparkSession, rows: list[dict[str, str]], fields: list[str]) -> DataFrame:
    """A short list kept by hand as a table of strings in the listed fields."""
    return spark.createDataFrame([tuple(r.get(f) or "" for f in fields) for r in rows], ", ".join(f"`{f}` string" for f in fields))


def triggered(tokens: DataFrame, token: str, triggers: DataFrame) -> DataFrame:
    """Tokens that stand for a listed entity: ``triggers`` has (token, entity)."""
    keys = triggers.select(normalize_label("token").alias("_key"), "entity").where("_key <> ''").groupBy("_key").agg(F.min("entity").alias("entity"))
    return tokens.withColumn("_key", normalize_label(token)).join(keys, "_key").drop("_key")


def endpoint(rows: DataFrame, label_key: str, index: DataFrame, minted: DataFrame) -> DataFrame:
    """Each row's entity: the one in the index, else one that was minted for the key and kept; rows with neither go."""
    known = index.select(F.col("key").alias(label_key), F.col("entity").alias("_known"))
    fresh = minted.select(F.col("key").alias(label_key), F.col("entity").alias("_fresh"))
    return rows.join(known, label_key, "left").join(fresh, label_key, "left").withColumn("entity", F.coalesce("_known", "_fresh")).where("entity is not null").drop("_known", "_fresh")


# --- outside records


def anchor_targets(occupations: DataFrame, domains: DataFrame, probes: dict[str, tuple[str, ...]]) -> DataFrame:
    """(id, kind, ord, label) to look up: labels of unified occupations, and the ordered probes of domains."""
    jobs = occupations.where(bare("primary_label_en") != "").select(F.col("unified_id").alias("id"), F.lit("occupation").alias("kind"), F.lit(0).alias("ord"), bare("primary_label_en").alias("label")).distinct()
    table = F.create_map(*[x for k, v in probes.items() for x in (F.lit(k), F.array(*[F.lit(p) for p in v]))])
    parts = domains.where("esco_skill_type = 'skill_domain'").select(F.col("entity_id").alias("id"), F.posexplode(F.try_element_at(table, F.col("it_subtype"))).alias("ord", "label"))
    return jobs.unionByName(parts.select("id", F.lit("domain").alias("kind"), "ord", "label"))


def anchors(targets: DataFrame, found: DataFrame) -> DataFrame:
    """(id, kind, label, qid, description, relation): the first target label of each id that was found, homonyms left out.

    ``found`` has (norm, kind, qid, description, match_method).  Occupations are not checked for homonyms.
    """
    keyed = targets.withColumn("norm", normalize_label("label"))
    good = found.where((bare("qid") != "") & ((F.col("kind") == "occupation") | ~homonym("description")))
    met = keyed.join(good, ["norm", "kind"])
    first = met.groupBy("id", "kind").agg(F.min_by(F.struct("label", "qid", "description", "match_method"), F.struct("ord", "label", "qid")).alias("x")).select("id", "kind", "x.*")
    return first.withColumn("relation", mapping_relation(F.col("match_method"))).drop("match_method")


def mapping_relation(method: Column) -> Column:
    """The mapping relation of a match method: exact labels match exactly, all others closely."""
    return F.when(F.coalesce(method, F.lit("")).startswith("exact"), "skos:exactMatch").otherwise("skos:closeMatch")


def woven(rows: DataFrame, links: DataFrame, languages: tuple[str, ...] = ("en", "fr")) -> DataFrame:
    """Unified rows with what the outside says: identifier, address and description always from ``links``, aliases added.

    ``links`` has (unified_id, qid, wikidata_url, wd_description, wd_aliases_<language>); a row without a link is blanked.
    """
    one = links.groupBy("unified_id").agg(*[F.min(c).alias(f"_{c}") for c in links.columns if c != "unified_id"])
    out = rows.join(one, "unified_id", "left")
    for language in languages:
        field, primary = f"alt_labels_{language}", f"primary_label_{language}"
        had = split_multi(field)
        seen = F.concat(F.array(normalize_label(primary)), F.transform(had, lambda x: normalize_label(x)))
        fresh = clean_aliases(F.coalesce(f"_wd_aliases_{language}", F.lit("")), seen)
        out = out.withColumn(field, F.when(F.size(fresh) > 0, F.array_join(F.concat(had, fresh), " | ")).otherwise(F.col(field)))
    blank = F.lit("")
    out = out.withColumns({"wikidata_qid": F.coalesce("_qid", blank), "wikidata_url": F.coalesce("_wikidata_url", blank), "wikidata_description": F.coalesce("_wd_description", blank)})
    return out.select(*rows.columns)


def corroborated(links: DataFrame, profiles: DataFrame, vectors: DataFrame) -> DataFrame:
    """(owner, item, near): the largest cosine of each linked item to its owner's profile, itself left out.

    ``links`` and ``profiles`` have (owner, item), ``vectors`` (item, vec) of length one; no profile gives null.
    """
    vec = vectors.select("item", "vec")
    mine = links.select("owner", "item").distinct().join(vec, "item")
    # profiles are joined on the owner, of which links are the side that adaptive execution splits
    others = profiles.select("owner", F.col("item").alias("other")).distinct().join(vec.select(F.col("item").alias("other"), F.col("vec").alias("_o")), "other")
    best = mine.join(others, "owner").where("item <> other").groupBy("owner", "item").agg(F.round(F.max(dot(F.col("vec"), F.col("_o"))), 3).alias("near"))
    return links.select("owner", "item").distinct().join(best, ["owner", "item"], "left")


# --- generated texts and their log


def description_targets(rows: DataFrame, label: str, description: str, kinds: Column, done: DataFrame, key: str) -> DataFrame:
    """Named rows of the wanted kinds without a description that no kept text answers."""
    return tables.pending(rows.where((bare(label) != "") & (bare(description) == "") & kinds), done, [key])


def accepted_links(picks: DataFrame, vectors: DataFrame, owners: DataFrame, floor: float = 0.45, most: int = 15) -> DataFrame:
    """(owner, item, weight) of picked items near enough to their owner, at most ``most`` an owner; a list the bound defines."""
    met = picks.join(vectors.select("item", "vec"), "item").join(owners.select("owner", F.col("vec").alias("_o")), "owner")
    near = met.withColumn("weight", F.round(dot(F.col("vec"), F.col("_o")), 3)).where(F.col("weight") >= floor)
    return tables.top_per(near, ["owner"], [-F.col("weight"), F.col("item")], most).select("owner", "item", "weight")


def rejects(snapshot: DataFrame, valid: str, keys: list[str]) -> DataFrame:
    """Kept results that were found unfit, in the order of their keys."""
    return snapshot.where(F.coalesce(F.col(valid).cast("string"), F.lit("")).isin("0", "false")).orderBy(*keys)


def first_alias(column: str) -> Column:
    """The first entry of a list that isn't blank; '' if there is none."""
    return F.coalesce(F.get(split_multi(column), F.lit(0)), F.lit(""))


def logged(log: DataFrame, name: str, counts: dict[str, DataFrame]) -> DataFrame:
    """The audit table with one stage's row replaced: (source, rows, details) with the number of rows of each table."""
    row = None
    for table, rows in counts.items():
        part = rows.agg(F.count("*").alias("n")).select(F.lit(table).alias("t"), "n")
        row = part if row is None else row.unionByName(part)
    new = row.agg(F.sum("n").alias("rows"), F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "t", F.col("n").cast("string")))), ", ").alias("details")).select(F.lit(name).alias("source"), "rows", "details")
    return tables.replace_source(log, new, "source", name)


def axioms(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(name, ok, n_violations) of a concept graph: nodes (id, kind), edges (s, t, type)."""
    kinds = nodes.select("id", "kind").distinct()
    both = kinds.where(F.col("kind").isin("occupation", "skill")).groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    one = kinds.groupBy("id").agg(F.min("kind").alias("kind"))
    ends = edges.select("s", "t", "type").join(one.select(F.col("id").alias("s"), F.col("kind").alias("ks")), "s", "left").join(one.select(F.col("id").alias("t"), F.col("kind").alias("kt")), "t", "left")

    def wrong(name: str, target: str) -> Column:
        return F.count_if((F.col("type") == name) & ~(F.col("ks").eqNullSafe("occupation") & F.col("kt").eqNullSafe(target)))

    counted = ends.agg(wrong("requires", "skill").alias("requires"), wrong("in_domain", "skill_domain").alias("in_domain"), F.count_if(F.col("ks").isNull() | F.col("kt").isNull()).alias("declared"))
    long = counted.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).alias("n_violations")) for n, c in (("requires_occupation_skill", "requires"), ("in_domain_occupation_domain", "in_domain"), ("ends_declared", "declared"))])))
    rows = both.agg(F.count("*").alias("n_violations")).select(F.lit("occupation_disjoint_skill").alias("name"), "n_violations").unionByName(long)
    return rows.select("name", (F.col("n_violations") == 0).alias("ok"), "n_violations")


def concept_graph(kb: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(nodes (id, kind, label, it_subtype), edges (s, t, type, subtype, prov, weight)) of a knowledge base.

    Nodes are unified records, the ontology and the groups of roles; roles that no unified record holds stand for
    themselves.  Links lead from child to parent: broader, in_domain, requires.  The broader links of skills are not
    taken over but made anew from the unified record's category, so each has one.  Of equal edges the smallest weight
    counts.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    taxonomy_rows = kb["skills"].where("source = 'TAXONOMY'")
    roles, members = kb["occupations"].where("coalesce(occupation_type, '') <> 'isco_group'"), None
    parts = [
        taxonomy_rows.select(F.col("entity_id").alias("id"), text("esco_skill_type").alias("kind"), text("pref_label_en").alias("label"), text("it_subtype").alias("it_subtype")),
        kb["occupations"].where("occupation_type = 'isco_group'").select(F.col("entity_id").alias("id"), F.lit("isco_group").alias("kind"), text("pref_label_en").alias("label"), F.lit("").alias("it_subtype")),
    ]
    for table, kind in (("unified_skills", "skill"), ("unified_occupations", "occupation")):
        if table in kb:
            sub = text("it_subtype") if "it_subtype" in kb[table].columns else F.lit("")
            parts.append(kb[table].select(F.col("unified_id").alias("id"), F.lit(kind).alias("kind"), text("primary_label_en").alias("label"), sub.alias("it_subtype")))
            held = kb[table].select(F.col("unified_id").alias("unified"), F.explode(split_multi("member_entity_ids")).alias("entity"))
            members = held if members is None else members.unionByName(held)
    if "unified_occupations" not in kb:
        parts.append(roles.select(F.col("entity_id").alias("id"), F.lit("occupation").alias("kind"), text("pref_label_en").alias("label"), F.lit("").alias("it_subtype")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    nodes = every.groupBy("id").agg(F.min("kind").alias("kind"), F.min("label").alias("label"), F.min("it_subtype").alias("it_subtype")).where("id is not null")
    told = kb["hierarchy"].select(F.trim("child_entity_id").alias("s"), F.trim("parent_entity_id").alias("t"), F.lower(F.trim("relation_type")).alias("kind"), text("source").alias("prov"))
    told = told.where("kind in ('broader_than', 'in_domain')").select("s", "t", F.when(F.col("kind") == "in_domain", "in_domain").otherwise("broader").alias("type"), F.lit("").alias("subtype"), "prov", F.lit("").alias("weight"))
    needs = kb["occupation_skill_relations"].select(F.col("occupation_entity_id").alias("s"), F.col("skill_entity_id").alias("t"), F.lit("requires").alias("type"), text("relation_type").alias("subtype"), text("source").alias("prov"), text("weight").alias("weight"))
    placed = graph.remap(told.unionByName(needs), members, nodes)
    kinds = nodes.select(F.col("id").alias("s"), F.col("kind").alias("_kind"))
    placed = placed.join(kinds, "s").where("type <> 'broader' or _kind <> 'skill'").drop("_kind")
    homes = nodes.where("kind = 'skill_category' and it_subtype <> ''").groupBy("it_subtype").agg(F.min("id").alias("t"))
    anew = nodes.where("kind = 'skill'").join(homes, "it_subtype").select(F.col("id").alias("s"), "t", F.lit("broader").alias("type"), F.lit("").alias("subtype"), F.lit("TAXONOMY").alias("prov"), F.lit("").alias("weight"))
    edges = placed.select(*anew.columns).unionByName(anew).groupBy("s", "t", "type", "subtype", "prov").agg(F.min("weight").alias("weight"))
    return nodes, edges


def without(rows: DataFrame, blocked: DataFrame, columns: tuple[str, ...], key: str = "entity_id") -> DataFrame:
    """Rows that name a blocked id in any of the columns left out: labels and relations of what the gate kept out."""
    ids = blocked.select(F.col(key)).where(f"`{key}` is not null").distinct()
    for c in columns:
        rows = rows.join(ids.select(F.col(key).alias(c)), c, "left_anti")
    return rows


def ontology(spark: SparkSession, base: str = "urn:taxoloom:") -> DataFrame:
    """(s, p, o): classes with what they are kinds of, what excludes what, and properties with domain and range."""
    classes = (("Occupation", "skos:Concept"), ("Skill", "skos:Concept"), ("HardSkill", "Skill"), ("SoftSkill", "Skill"), ("SkillType", "skos:Concept"), ("SkillDomain", "skos:Concept"), ("SkillCategory", "skos:Concept"), ("OccupationGroup", "skos:Concept"))
    properties = (("requiresSkill", "Occupation", "Skill"), ("inDomain", "Occupation", "SkillDomain"))
    iri = lambda x: x if ":" in x else f"<{base}{x}>"
    rows = [(iri(c), "rdf:type", "owl:Class") for c, _ in classes] + [(iri(c), "rdfs:subClassOf", iri(up)) for c, up in classes]
    rows += [(iri("Occupation"), "owl:disjointWith", iri("Skill")), (iri("HardSkill"), "owl:disjointWith", iri("SoftSkill"))]
    for name, domain, value in properties:
        rows += [(iri(name), "rdf:type", "owl:ObjectProperty"), (iri(name), "rdfs:domain", iri(domain)), (iri(name), "rdfs:range", iri(value))]
    rows += [(iri(n), "rdf:type", "owl:DatatypeProperty") for n in ("hardSoft", "itSubtype", "code", "weight")]
    return spark.createDataFrame(rows, "s string, p string, o string")


def qa_report(kb: dict[str, DataFrame]) -> DataFrame:
    """(table, counter, n): rows, distinct keys and filled columns of every table, one pass each."""
    keys = {"occupations": "entity_id", "skills": "entity_id", "unified_skills": "unified_id", "hierarchy": None, "occupation_skill_relations": "rel_id", "concept_alignments": None}
    out = None
    for table, key in keys.items():
        rows = kb[table]
        filled = [c for c, t in rows.dtypes if t == "string" and c != key]
        counts = [F.count("*").alias("rows"), *([F.count_distinct(key).alias("keys")] if key else []), *[F.count_if(bare(c) != "").alias(c) for c in filled]]
        one = rows.agg(*counts)
        long = one.select(F.lit(table).alias("table_name"), F.inline(F.array(*[F.struct(F.lit(c).alias("counter"), F.col(c).alias("n")) for c in one.columns])))
        out = long if out is None else out.unionByName(long)
    return out


def reconciled(checks: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(name, left_rows, right_rows, ok) of pairs of frames that should have equally many rows."""
    out = None
    for name, (a, b) in checks.items():
        row = a.agg(F.count("*").alias("left_rows")).crossJoin(b.agg(F.count("*").alias("right_rows"))).select(F.lit(name).alias("name"), "left_rows", "right_rows", (F.col("left_rows") == F.col("right_rows")).alias("ok"))
        out = row if out is None else out.unionByName(row)
    return out
