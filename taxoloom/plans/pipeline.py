"""From sources to a checked knowledge base, whole or source by source.

A stage is a function from tables to tables.  Stages build plans and start no jobs of their own but where a fixed point
has to be found; the runner writes what a stage changed, so a later stage starts from files.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxoloom.functions import rules
from taxoloom.functions.text import first_given, first_sentence, match_key, split_multi, verify_key, without_echo
from taxoloom.operators import curation, graph, lookup, quality, similarity, tables, votes
from taxoloom.plans.providers import Embedding, Entailment, TextMaker
from taxoloom.sources.registry import ExtractionSource, Registry, StructuredSource, ingest, ingest_mentions

KB = dict[str, DataFrame]
ORDER = ("ingest", "hierarchy", "align", "attach", "merge", "qa")
ENRICHMENT = ("wikidata", "agent", "translate")
#: How near a pair must be to be looked at, how many are looked at for each record and source, and how many groups a role is held against.
FLOOR, TOP, SHORTLIST = 0.50, 5, 3


@dataclass
class Context:
    """What stages share."""

    spark: SparkSession
    registry: Registry
    folder: str
    focus: str | None = None
    embedding: Embedding | None = None
    entailment: Entailment = field(default_factory=Entailment)
    maker: TextMaker = field(default_factory=TextMaker)
    translator: TextMaker = field(default_factory=TextMaker)
    notes: list[str] = field(default_factory=list)


def stage_ingest(ctx: Context, kb: KB) -> KB:
    sources = ctx.registry.builtin() if ctx.focus is None else [ctx.registry.get(ctx.focus)]
    for source in sources:
        if isinstance(source, StructuredSource):
            kb = ingest(ctx.spark, source, kb)
        elif isinstance(source, ExtractionSource):
            kb = ingest_mentions(ctx.spark, source, kb)
    return kb


def stage_hierarchy(ctx: Context, kb: KB) -> KB:
    """Every skill gets its category and its kind, and an edge to its category; roles get one to their domain."""
    own = F.when(F.col("it_subtype").isin(*rules.CATEGORY_DOMAINS), F.col("it_subtype"))
    placed = kb["skills"].withColumn("it_subtype", F.when(F.col("source") == "TAXONOMY", F.col("it_subtype")).otherwise(rules.category(first_given("pref_label_en", "pref_label_fr"), "hard_soft_provisional", "esco_skill_type", own)))
    kind = F.coalesce(F.nullif(F.trim(F.coalesce("hard_soft_provisional", F.lit(""))), F.lit("")), rules.hard_soft_of(F.col("it_subtype")))
    skills = placed.withColumn("hard_soft_provisional", kind)
    nodes, tiers = curation.taxonomy(ctx.spark)
    if skills.where("source = 'TAXONOMY'").isEmpty():
        skills = skills.unionByName(nodes, allowMissingColumns=True).select(*skills.columns)
        edges = tiers
    else:
        edges = kb["hierarchy"].where("source = 'TAXONOMY'").join(skills.where("source = 'TAXONOMY'").select(F.col("entity_id").alias("child_entity_id")).distinct(), "child_entity_id", "left_semi").select(*tiers.columns)
    tops = skills.where("source = 'TAXONOMY' and esco_skill_type = 'skill_domain'").groupBy(F.col("it_subtype").alias("_domain")).agg(F.min("entity_id").alias("parent_entity_id"))
    roles = kb["occupations"].where("coalesce(occupation_type, '') <> 'isco_group'").groupBy(F.col("entity_id").alias("child_entity_id")).agg(F.min("pref_label_en").alias("label"), F.min("isco_code").alias("code"))
    facets = roles.withColumn("_domain", rules.role_domain(F.col("label"), "code")).join(tops, "_domain").select("parent_entity_id", "child_entity_id", F.lit("occupation").alias("entity_kind"), F.lit("in_domain").alias("relation_type"), F.lit("TAXONOMY").alias("source"))
    new = edges.unionByName(curation.placed_skills(skills, skills.where("source = 'TAXONOMY'"))).unionByName(facets)
    return kb | {"skills": skills, "hierarchy": tables.replace_source(kb["hierarchy"], new, "source", "TAXONOMY")}


def _comparable(rows: DataFrame) -> DataFrame:
    """(id, source, text, pref, every, description) of records, once each."""
    label = first_given("pref_label_en", "pref_label_fr")
    one = rows.groupBy("entity_id", "source").agg(*[F.min(c).alias(c) for c in ("pref_label_en", "pref_label_fr", "alt_labels_en", "description_en")])
    keys = lambda labels: F.filter(F.transform(labels, lambda x: verify_key(x)), lambda k: k != "")
    told = one.withColumn("_label", label)
    return told.select(
        F.col("entity_id").alias("id"), "source", curation.profile_text("_label", "alt_labels_en", "description_en").alias("text"), keys(F.array("_label")).alias("pref"),
        keys(F.concat(F.array("_label"), split_multi("alt_labels_en"))).alias("every"), F.trim(F.coalesce("description_en", F.lit(""))).alias("description"),
    ).where("size(pref) > 0 and source is not null")


def near_pairs(ctx: Context, rows: DataFrame, left: DataFrame | None = None) -> DataFrame:
    """(a, b, sim) of the nearest records of other sources, both ways, each pair once; with ``left`` those with an end there.

    Vectors come from the context's provider, else from the texts' own character n-grams.
    """
    mine = rows if left is None else left
    of = rows.select("id", "source")
    if ctx.embedding is not None:
        vecs = lambda df: ctx.embedding.vectors(df, "text").select("id", F.col("source").alias("grp"), "vec")
        found = similarity.cosine_pairs(vecs(mine), vecs(rows), FLOOR, TOP)
        if left is not None:
            found = found.unionByName(similarity.cosine_pairs(vecs(rows), vecs(mine), FLOOR, TOP))
        sims = found.select("a", "b", "sim")
    else:
        weights = similarity.tfidf(rows, "id", "text")
        own = weights if left is None else weights.join(left.select("id"), "id", "left_semi")
        raw = similarity.sparse_cosine(own, weights, FLOOR).where("a <> b")
        both = raw.unionByName(raw.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim")).distinct()
        sided = both.join(of.select(F.col("id").alias("a"), F.col("source").alias("sa")), "a").join(of.select(F.col("id").alias("b"), F.col("source").alias("sb")), "b").where("sa <> sb")
        sims = similarity.top_per(sided, ["a", "sb"], [-F.round("sim", 9), F.col("b")], TOP)
    return sims.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("sim").alias("sim"))


def verified(ctx: Context, rows: DataFrame, pairs: DataFrame, occupation: bool) -> DataFrame:
    """The pairs as alignments: relation, confidence and merge flag by labels, similarity and entailment."""
    tested = curation.label_tests(pairs, rows.select("id", "pref", "every"))
    side = lambda s: rows.select(F.col("id").alias(s), F.col("source").alias(f"source_{s}"), F.col("description").alias(f"_d{s}"))
    told = tested.join(side("a"), "a").join(side("b"), "b")
    defined = (F.col("_da") != "") & (F.col("_db") != "")
    told = told.withColumn("_nli", F.when((F.col("sim") >= 0.70) & defined, ctx.entailment.mutual(F.col("_da"), F.col("_db"))))
    relation, confidence, flag = similarity.merge_decision(F.col("pref"), F.col("any"), F.col("sim"), F.col("_nli"), F.lit(occupation), defined)
    none = F.lit(None).cast("string")
    return told.select(
        F.col("a").alias("entity_id_a"), "source_a", F.col("b").alias("entity_id_b"), "source_b", relation.alias("relation"), F.round(confidence, 4).cast("string").alias("confidence"),
        F.lit("similarity").alias("method"), none.alias("validated"), F.nullif(flag, F.lit("")).alias("merge_flag"), none.alias("notes"),
    )


def stage_align(ctx: Context, kb: KB) -> KB:
    """Skills of one key as exact matches, and near pairs of skills and of occupations, verified.

    The French label serves where there is no English one.  With a focus only pairs with an end in that source are sought,
    all others stay as they were.
    """
    real = kb["skills"].where("coalesce(source, '') <> 'TAXONOMY'")
    rows = real.select("entity_id", "source", match_key(first_given("pref_label_en", "pref_label_fr")).alias("key"), F.coalesce("hard_soft_provisional", F.lit("")).alias("kind")).where("key <> ''").dropDuplicates(["entity_id"])
    stars = lookup.star_edges(rows, "entity_id", ["key", "kind"], "entity_id")
    of = rows.select("entity_id", "source")
    pairs = stars.join(of.select(F.col("entity_id").alias("a"), F.col("source").alias("source_a")), "a").join(of.select(F.col("entity_id").alias("b"), F.col("source").alias("source_b")), "b")
    shaped = pairs.select(F.col("a").alias("entity_id_a"), "source_a", F.col("b").alias("entity_id_b"), "source_b", F.lit("exactMatch").alias("relation"), F.lit("0.97").alias("confidence"), F.lit("match_key_exact").alias("method"), F.lit(None).cast("string").alias("validated"), F.lit("label").alias("merge_flag"), F.lit(None).cast("string").alias("notes"))
    for table, occupation in (("occupations", True), ("skills", False)):
        if table not in kb:
            continue
        told = kb[table].where("coalesce(occupation_type, '') <> 'isco_group'") if occupation else real
        known = _comparable(told)
        near = near_pairs(ctx, known, None if ctx.focus is None else known.where(F.col("source") == ctx.focus))
        near = near.join(stars.select("a", "b"), ["a", "b"], "left_anti")
        shaped = shaped.unionByName(verified(ctx, known, near, occupation))
    old = kb["concept_alignments"].where("coalesce(method, '') <> 'match_key_exact'")
    ours = F.coalesce("method", F.lit("")) == "similarity"
    if ctx.focus is not None:
        ours = ours & (F.col("source_a").eqNullSafe(ctx.focus) | F.col("source_b").eqNullSafe(ctx.focus))
    return kb | {"concept_alignments": old.where(~ours).unionByName(shaped)}


def stage_attach(ctx: Context, kb: KB) -> KB:
    """Roles of attaching sources without a code take that of an equally named one, else that of the group they are nearest to.

    The three nearest groups are ranked again with entailment; the role hangs under the group that wins.
    """
    needy = F.col("source").isin(*(ctx.registry.attaching() or [""])) & (F.trim(F.coalesce("isco_code", F.lit(""))) == "")
    named = kb["occupations"].withColumn("_key", match_key("pref_label_en"))
    coded = named.where("trim(coalesce(isco_code, '')) <> '' and _key <> '' and coalesce(occupation_type, '') <> 'isco_group'").groupBy("_key").agg(F.min("isco_code").alias("_code"))
    out = named.join(coded, "_key", "left").withColumn("isco_code", F.when(needy, F.col("_code")).otherwise(F.col("isco_code"))).select(*kb["occupations"].columns)
    groups = kb["occupations"].where("occupation_type = 'isco_group' and length(trim(coalesce(isco_code, ''))) = 4")
    if not ctx.registry.attaching() or groups.isEmpty():
        return kb | {"occupations": out}
    open_, listed = _comparable(out.where(needy)), _comparable(groups.withColumn("source", F.lit("~group")))
    both = open_.unionByName(listed)
    if ctx.embedding is not None:
        vecs = lambda df: ctx.embedding.vectors(df, "text").select("id", F.col("source").alias("grp"), "vec")
        short = similarity.cosine_pairs(vecs(open_), vecs(listed), -1.0, SHORTLIST).select("a", "b", "sim")
    else:
        weights = similarity.tfidf(both, "id", "text")
        side = lambda df: weights.join(df.select("id").distinct(), "id", "left_semi")
        short = similarity.top_per(similarity.sparse_cosine(side(open_), side(listed)), ["a"], [-F.round("sim", 9), F.col("b")], SHORTLIST)
    texts = lambda df, s: df.select(F.col("id").alias(s), F.col("description").alias(f"_d{s}"))
    judged = short.join(texts(open_, "a"), "a").join(texts(listed, "b"), "b").withColumn("entail", ctx.entailment.score(F.col("_da"), F.col("_db")))
    chosen = similarity.rerank(judged, "a", "sim", "entail").select(F.col("a").alias("entity_id"), F.col("target").alias("_group"))
    codes = groups.groupBy(F.col("entity_id").alias("_group")).agg(F.min("isco_code").alias("_near"))
    won = chosen.join(codes, "_group")
    filled = out.join(won.select("entity_id", "_near"), "entity_id", "left").withColumn("isco_code", F.when(F.trim(F.coalesce("isco_code", F.lit(""))) == "", F.col("_near")).otherwise(F.col("isco_code")))
    edges = won.select(F.col("_group").alias("parent_entity_id"), F.col("entity_id").alias("child_entity_id"), F.lit("occupation").alias("entity_kind"), F.lit("broader_than").alias("relation_type"), F.lit("ATTACH").alias("source"))
    mine = (F.col("source") == "ATTACH") if ctx.focus is None else None
    return kb | {"occupations": filled.select(*kb["occupations"].columns), "hierarchy": tables.replace_children(kb["hierarchy"], edges.select(*kb["hierarchy"].columns), "child_entity_id", mine)}


def _merged(rows: DataFrame, pairs: DataFrame, prefix: str) -> tuple[DataFrame, DataFrame]:
    """(rows with their component, one row a component with its labels, sources and members)."""
    comp = graph.components(pairs, rows.select(F.col("entity_id").alias("node"))).withColumnRenamed("node", "entity_id")
    rows = rows.join(comp, "entity_id")
    out = votes.component_ids(rows, "component", "entity_id", prefix)
    label = votes.consensus_label(rows, ["component"], "pref_label_en", "alt_labels_en").withColumnRenamed("pref_label_en", "primary_label_en")
    every = rows.withColumn("_all", F.concat(split_multi("pref_label_en"), split_multi("alt_labels_en")))
    alts = votes.other_labels(every, ["component"], "_all", "entity_id", label.withColumnRenamed("primary_label_en", "primary")).withColumnRenamed("labels", "alt_labels_en")
    parts = [
        label,
        votes.consensus_label(rows, ["component"], "pref_label_fr").withColumnRenamed("pref_label_fr", "primary_label_fr"),
        alts,
        votes.majority(rows, ["component"], "description_en", longest=True).withColumnRenamed("description_en", "description"),
        votes.sorted_list(rows, ["component"], "source", "sources"),
        votes.sorted_list(rows, ["component"], "entity_id", "member_entity_ids"),
    ]
    for part in parts:
        out = out.join(part, "component", "left")
    return rows, out


def stage_merge(ctx: Context, kb: KB) -> KB:
    """Components of merge pairs as unified skills and occupations, their fields by vote.

    Semantic pairs of occupations count only between roles of one code.
    """
    flags = kb["concept_alignments"].select(F.lower(F.trim("merge_flag")).alias("flag"), F.trim("entity_id_a").alias("u"), F.trim("entity_id_b").alias("v")).where("flag in ('label', 'semantic')")
    rows, out = _merged(kb["skills"].where("coalesce(source, '') <> 'TAXONOMY'"), flags.select("u", "v"), "USKL_")
    for part in (votes.majority(rows, ["component"], "hard_soft_provisional").withColumnRenamed("hard_soft_provisional", "hard_soft"), votes.majority(rows, ["component"], "it_subtype")):
        out = out.join(part, "component", "left")
    out = curation.overridden(out, "primary_label_en", "it_subtype")
    jobs = kb["occupations"].where("coalesce(occupation_type, '') <> 'isco_group'")
    code = lambda s: jobs.groupBy(F.col("entity_id").alias(s)).agg(F.min(F.trim(F.coalesce("isco_code", F.lit("")))).alias(f"_c{s}"))
    same = flags.join(code("u"), "u").join(code("v"), "v").where("flag = 'label' or (_cu <> '' and _cu = _cv)")
    mine, roles = _merged(jobs, same.select("u", "v"), "UOCC_")
    roles = roles.join(votes.majority(mine, ["component"], "isco_code"), "component", "left")
    now = F.current_timestamp()
    return kb | {"unified_skills": out.drop("component").withColumn("built_at", now), "unified_occupations": roles.drop("component").withColumn("built_at", now)}


def stage_wikidata(ctx: Context, kb: KB) -> KB:
    """Outside identifiers, descriptions and aliases of the records that were found; without ``kb['found']`` nothing changes."""
    if "found" not in kb:
        return kb
    jobs = kb["unified_occupations"].select("unified_id", "primary_label_en")
    targets = curation.anchor_targets(jobs, kb["skills"].limit(0), {"": ("",)})
    skills = kb["unified_skills"].select(F.col("unified_id").alias("id"), F.lit("skill").alias("kind"), F.lit(0).alias("ord"), F.col("primary_label_en").alias("label")).where(curation.short_label("label", "kind", ("skill",)))
    return kb | {"wikidata_links": curation.anchors(targets.unionByName(skills), kb["found"])}


def stage_agent(ctx: Context, kb: KB) -> KB:
    """Descriptions for unified skills that lack one: generated, cut to a sentence, checked by length and entailment, kept by id."""
    done = kb.get("generated", ctx.spark.createDataFrame([], "unified_id string, description string"))
    rows = kb["unified_skills"]
    targets = curation.description_targets(rows, "primary_label_en", "description", F.lit(True), done, "unified_id")
    said = targets.select("unified_id", "primary_label_en", ctx.maker.answers(F.concat(F.lit("skill: "), F.col("primary_label_en"))).alias("raw")).where("raw is not null")
    made = said.withColumn("description", first_sentence(without_echo("primary_label_en", "raw"), 400))
    nli = ctx.entailment.score(F.col("description"), F.col("primary_label_en"))
    fit = made.where(F.length("description").between(20, 400) & (F.coalesce(nli, F.lit(1.0)) >= 0.50)).select("unified_id", "description")
    kept = done.unionByName(fit)
    return kb | {"generated": kept, "unified_skills": tables.enriched(rows, "unified_id", "description", [("llm", kept)])}


def stage_translate(ctx: Context, kb: KB) -> KB:
    """French labels for unified skills that lack one; a label is asked for once and kept by its text."""
    done = kb.get("translated", ctx.spark.createDataFrame([], "label string, french string"))
    rows = kb["unified_skills"]
    lacking = rows.where((F.trim(F.coalesce("primary_label_fr", F.lit(""))) == "") & (F.trim(F.coalesce("primary_label_en", F.lit(""))) != ""))
    fresh = tables.pending(lacking.select(F.col("primary_label_en").alias("label")).distinct(), done, ["label"])
    kept = done.unionByName(fresh.select("label", ctx.translator.answers(F.col("label")).alias("french")).where("trim(coalesce(french, '')) <> ''"))
    filled = rows.join(kept.select(F.col("label").alias("primary_label_en"), "french"), "primary_label_en", "left")
    filled = filled.withColumn("primary_label_fr", first_given("primary_label_fr", "french")).select(*rows.columns)
    return kb | {"translated": kept, "unified_skills": filled}


def stage_qa(ctx: Context, kb: KB) -> KB:
    return kb | {"qa": quality.invariants(kb)}


STAGES: dict[str, Callable[[Context, KB], KB]] = {"ingest": stage_ingest, "hierarchy": stage_hierarchy, "align": stage_align, "attach": stage_attach, "merge": stage_merge, "qa": stage_qa, "wikidata": stage_wikidata, "agent": stage_agent, "translate": stage_translate}


def chosen(only: list[str] | None = None, start: str | None = None, end: str | None = None) -> list[str]:
    """Stages in their order: the listed ones, or from one to another."""
    unknown = set(only or []) - set(ORDER) - set(ENRICHMENT)
    if unknown:
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    names = [s for s in ORDER if only is None or s in only]
    extra = [s for s in ENRICHMENT if only is not None and s in only]
    lo = ORDER.index(start) if start else 0
    hi = ORDER.index(end) if end else len(ORDER) - 1
    return [s for s in names if lo <= ORDER.index(s) <= hi] + extra


def run(ctx: Context, kb: KB, names: list[str] | None = None) -> KB:
    """The stages in order; what each changed is written under ``folder`` and read back."""
    names = names or list(ORDER)
    for at, name in enumerate(names):
        new = STAGES[name](ctx, kb)
        for table, rows in new.items():
            if rows is not kb.get(table):
                path = f"{ctx.folder}/{at}-{name}/{table}"
                rows.write.mode("overwrite").parquet(path)
                new[table] = ctx.spark.read.parquet(path)
        kb = new
    last = max((ORDER.index(s) for s in names if s in ORDER), default=len(ORDER))
    if stale := list(ORDER[last + 1 :]):
        ctx.notes.append(f"not run after {ORDER[last]}: {', '.join(stale)}")
    return kb


def recounted(ctx: Context, kb: KB) -> KB:
    """The audit table with the numbers of the whole base told anew."""
    log = kb.get("provenance", ctx.spark.createDataFrame([], "source string, rows long, details string"))
    return kb | {"provenance": curation.logged(log, "global", {t: kb[t] for t in ("occupations", "skills", "hierarchy", "occupation_skill_relations", "concept_alignments") if t in kb})}


def add_source(ctx: Context, kb: KB, name: str) -> KB:
    """One source read and everything that depends on it derived again."""
    return recounted(ctx, run(replace(ctx, focus=name), kb))


def remove_source(ctx: Context, kb: KB, name: str) -> KB:
    """A source, what referred to it and what was derived from it gone."""
    names = ("occupations", "skills", "hierarchy", "occupation_skill_relations", "concept_alignments")
    left = tables.without_source({t: kb[t] for t in names}, name)
    return recounted(ctx, run(replace(ctx, focus=None), kb | left, ["hierarchy", "align", "merge", "qa"]))


def propose_and_verify(targets: DataFrame, propose: Callable[[DataFrame, int], DataFrame], verify: Callable[[DataFrame], DataFrame], key: str, rounds: int = 2) -> tuple[DataFrame, DataFrame]:
    """(committed, deferred): proposals are checked, and targets whose proposal failed are proposed for again, a bounded number of times.

    ``verify`` adds a boolean ``ok``.
    """
    done, open_ = None, targets
    for n in range(rounds):
        judged = verify(propose(open_, n))
        good = judged.where("ok")
        done = good if done is None else done.unionByName(good)
        open_ = open_.join(good.select(key), key, "left_anti")
    return done, open_


def sparse_roles(occupations: DataFrame, relations: DataFrame, most: int = 6, limit: int = 40) -> DataFrame:
    """Roles with few relations, the barest first."""
    counts = relations.groupBy(F.col("occupation_entity_id").alias("entity_id")).agg(F.count("*").alias("n"))
    rows = occupations.select("entity_id").distinct().join(counts, "entity_id", "left").select("entity_id", F.coalesce("n", F.lit(0)).alias("n")).where(F.col("n") <= most)
    return rows.orderBy("n", "entity_id").limit(limit)


def grounding(rows: DataFrame, label: str, domain: str, description: str, aliases: str) -> DataFrame:
    """A line of context for each record: its domain, description and first three aliases."""
    three = F.array_join(F.slice(split_multi(aliases), 1, 3), ", ")
    parts = F.array(F.col(label), F.col(domain), F.col(description), F.when(three != "", F.concat(F.lit("also: "), three)))
    return rows.withColumn("context", F.array_join(F.filter(parts, lambda x: F.trim(F.coalesce(x, F.lit(""))) != ""), ". "))
