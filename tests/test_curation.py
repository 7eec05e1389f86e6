import json
from datetime import datetime as dt

from tests.conftest import DATA
from pyspark.sql import functions as F

from taxoloom import __main__ as cli
from taxoloom.functions import masking, text
from taxoloom.operators import curation, forest, graph, orphans, quality, similarity, tables
from taxoloom.plans import pipeline, providers, toolbox
from taxoloom.session import load
from taxoloom.sources import readers, registry, sinks


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_rows_without_a_source_stay(spark):
    old = frame(spark, [("a", None), ("b", "S"), ("c", "T")], "k string, source string")
    assert rows(tables.replace_source(old, frame(spark, [("d", "S")], "k string, source string"), "source", "S"), "k") == [("a",), ("c",), ("d",)]
    pairs = frame(spark, [("a", None, "S"), ("b", None, None)], "k string, x string, y string")
    assert rows(tables.replace_pairs(pairs, pairs.limit(0), "x", "y", "S"), "k") == [("b",)]
    edges = frame(spark, [("p", "c", "A"), ("q", "d", "B")], "u string, v string, source string")
    assert rows(tables.replace_children(edges, edges.limit(0), "v", F.col("source") == "A"), "v") == [("d",)]


def test_records_come_back(spark):
    t = [dt(2024, m, 1) for m in range(1, 9)]
    told = [("A", t[0], t[2]), ("A", t[3], t[2]), ("B", t[0], t[2]), ("B", t[4], None), ("C", t[5], t[1])]
    records = orphans.existence_deltas(frame(spark, told, "id string, seen timestamp_ntz, gone timestamp_ntz"), "d", "id", "seen", "gone")
    refs = frame(spark, [(n, k, t[m]) for n, (k, m) in enumerate([("A", 1), ("A", 4), ("B", 3), ("B", 5), ("C", 0), ("C", 3)])], "rid long, f string, ts timestamp_ntz")
    made = orphans.reference_rows(refs, "t", "rid", "ts", {"f": "d"})
    assert rows(orphans.orphan_rows(made, records), "row_id", "reason") == [(1, "deleted"), (2, "deleted"), (4, "late"), (5, "deleted")]
    one, two = orphans.merge_state(records, made), orphans.merge_state(records.limit(0), made.where("row_id > 2"), orphans.merge_state(records, made.where("row_id <= 2")))
    assert rows(orphans.orphan_periods(one), "key", "period") == rows(orphans.orphan_periods(two), "key", "period")


def _kb(spark):
    occ = frame(spark, [("G", "isco_group", "2511"), ("O1", "", "2511"), ("O2", "", "2511")], "entity_id string, occupation_type string, isco_code string")
    skl = frame(spark, [("C", "TAXONOMY", "skill_category"), ("D", "TAXONOMY", "skill_domain"), ("S1", "X", ""), ("S2", "X", "")], "entity_id string, source string, esco_skill_type string")
    links = [("G", "O1", "occupation", "broader_than"), ("G", "O2", "occupation", "broader_than"), ("D", "O1", "occupation", "in_domain"), ("D", "O2", "occupation", "in_domain"), ("C", "S1", "skill", "broader_than"), ("C", "S2", "skill", "broader_than"), ("D", "C", "skill", "broader_than")]
    rel = frame(spark, [("O1", "S1", "demand", "X", "1")], "occupation_entity_id string, skill_entity_id string, relation_type string, source string, weight string")
    uni = frame(spark, [("U1", "S1|S2", "hard", "web")], "unified_id string, member_entity_ids string, hard_soft string, it_subtype string")
    shape = "parent_entity_id string, child_entity_id string, entity_kind string, relation_type string"
    return {"occupations": occ, "skills": skl, "hierarchy": frame(spark, links, shape), "occupation_skill_relations": rel, "unified_skills": uni}, shape


def test_each_invariant_is_told(spark):
    kb, shape = _kb(spark)
    broken = lambda kb: {r["name"] for r in quality.invariants(kb).where("not ok").collect()}
    assert broken(kb) == set()
    more = lambda t, data: kb | {t: kb[t].unionByName(spark.createDataFrame(data, kb[t].schema))}
    assert "edges_resolve" in broken(more("hierarchy", [("C", "none", "skill", "related_to")]))
    assert {"no_self_loop", "acyclic"} <= broken(more("hierarchy", [("C", "C", "skill", "related_to")]))
    assert "acyclic" in broken(more("hierarchy", [("O1", "G", "occupation", "related_to")]))
    assert "one_category_per_skill" in broken(more("hierarchy", [("D", "S1", "skill", "broader_than")]))
    assert {"one_backbone_and_domain_per_occupation", "occupations_reach_root"} <= broken(more("occupations", [("O3", "", "")]))
    assert "groups_in_scope" in broken(more("occupations", [("H", "isco_group", "1111")]))
    assert "no_skill_over_skill" in broken(more("hierarchy", [("S1", "S2", "skill", "related_to")]))
    assert "hard_soft_matches" in broken(more("unified_skills", [("U2", "", "soft", "web")]))
    assert "relations_typed" in broken(more("occupation_skill_relations", [("G", "S1", "x", "y", "z")]))
    assert {"members_valid", "ids_unique"} <= broken(more("unified_skills", [("U1", "S9", "hard", "web")]))
    assert "relations_unique" in broken(more("occupation_skill_relations", [("O1", "S1", "demand", "X", "1")]))


def test_predicates(spark):
    df = frame(spark, [("FR-fr ", "a b", "Senior Developer"), (None, None, None), ("de", "city in France", "nurse")], "lang string, d string, t string")
    got = [tuple(r) for r in df.select(curation.spoken("lang", ("fr", "")), curation.homonym("d"), curation.hinted("t")).collect()]
    assert got == [(True, False, True), (True, False, False), (False, True, False)]
    labels = frame(spark, [("1", ["a"], ["a", "x"]), ("2", ["a"], ["a"]), ("3", ["b"], ["x"])], "id string, pref array<string>, every array<string>")
    tested = curation.label_tests(frame(spark, [("1", "2"), ("1", "3"), ("1", "9")], "a string, b string"), labels)
    assert rows(tested, "b", "pref", "any") == [("2", True, True), ("3", False, True), ("9", False, False)]
    assert curation.literal_rows(spark, [{"a": "x"}, {}], ["a", "b"]).count() == 2


def test_weaving_blanks_what_is_not_linked(spark):
    unified = frame(spark, [("U1", "Rust", "Rouille", "rustlang", "", "Q0", "u0", "d0"), ("U2", "Go", "", "", "", "Q1", "u1", "d1")], "unified_id string, primary_label_en string, primary_label_fr string, alt_labels_en string, alt_labels_fr string, wikidata_qid string, wikidata_url string, wikidata_description string")
    links = frame(spark, [("U1", "Q9", "u9", "d9", "Rust | rustlang | Rust language", "")], "unified_id string, qid string, wikidata_url string, wd_description string, wd_aliases_en string, wd_aliases_fr string")
    assert rows(curation.woven(unified, links), "unified_id", "wikidata_qid", "alt_labels_en") == [("U1", "Q9", "rustlang | Rust language"), ("U2", "", "")]


def test_sparse_cosine_with_a_floor_loses_nothing(spark):
    words = ["data base", "data bases", "data lake", "web forms", "web form", "forms of web", "queue", "", "data base"]
    weights = similarity.tfidf(frame(spark, list(enumerate(words)), "id long, t string"), "id", "t")
    every = {(a, b): round(s, 6) for a, b, s in similarity.sparse_cosine(weights, weights).collect()}
    for floor in (0.2, 0.5, 0.9):
        assert {(a, b): round(s, 6) for a, b, s in similarity.sparse_cosine(weights, weights, floor).collect()} == {k: s for k, s in every.items() if s >= floor}


def test_numbered(spark):
    got = graph.numbered(spark.range(1000).withColumn("id", F.col("id") * 7 % 1000).repartition(5), "id")
    assert got.where("n <> id + 1").count() == 0


def test_text_and_providers(spark):
    page = '<script type="application/ld+json">{"@graph": [{"@type": ["Thing", "JobPosting"], "title": "Dev", "description": "<p>do</p>"}]}</script><a href="/x#y">a</a><a href="/x">b</a>'
    df = frame(spark, [("https://h.example/p/q", page)], "url string, html string")
    assert df.select(text.page_links("html", "url")).first()[0] == ["https://h.example/x"]
    assert rows(providers.postings_of(df), "title", "text") == [("Dev", "do")]
    hidden = frame(spark, [("uses Machine Learning and C++ daily",)], "t string").select(masking.mask("t", ("machine learning",)).alias("m")).first()["m"]
    assert hidden["text"] == "uses Zt0z and Zt1z daily" and hidden["tokens"] == ["Machine Learning", "C++"]
    tries = []

    def ask(ids):
        tries.append(len(ids))
        return json.dumps({"results": {"bindings": [{"id": {"value": "x/Q1"}, "label": {"value": "one"}}]}})

    known = providers.labels_of_ids(["Q1", "Q2"], ask, {})
    assert known == {"Q1": {"label": "one"}, "Q2": {}} and providers.labels_of_ids(["Q1", "Q2"], ask, known) == known and tries == [2]
    assert "FILTER NOT EXISTS" in providers.label_query(["a"], "en", ("Q1",), ("Q2",))

    def dead(prompts):
        raise PermissionError

    assert df.select(providers.TextMaker(dead, fallback=lambda ps: ["local"] * len(ps)).answers(F.col("url"))).first()[0] == "local"
    assert df.select(text.bio_spans(F.array(*map(F.lit, ("<NAME>", "web", "forms"))), F.array(*map(F.lit, ("O", "B", "I"))))).first()[0] == ["web forms"]


def test_readers_and_reports(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\nl�eau,1\n", encoding="utf-8")
    assert readers.read_smart(spark, f"file://{tmp_path}/x.csv", ["a"], line_breaks=False).first()[0] == "l'eau"
    assert frame(spark, [("{'k': ['a', 'b']}",)], "t string").select(readers.dict_literal("t")).first()[0] == {"k": ["a", "b"]}
    try:
        sinks.report(spark.range(5), "R", 4)
        raise AssertionError
    except ValueError:
        pass


def test_toolbox(spark):
    box = toolbox.Toolbox(frame(spark, [("a", "x", [1.0, 0.0]), ("b", "x", [0.0, 1.0]), ("c", "y", [0.6, 0.8])], "entity_id string, label string, vec array<double>"))
    owner = frame(spark, [("o", [1.0, 0.0])], "id string, vec array<double>")
    assert [r["b"] for r in box.shortlist(owner, 1, 2).orderBy(F.desc("sim")).collect()] == ["c", "b"]
    assert rows(box.by_label(frame(spark, [("x",)], "label string")), "entity_id") == [("b",)]
    log = toolbox.committed(frame(spark, [("t", "k", "old", "2000")], "task string, key string, output string, created_at string"), frame(spark, [("k", "new")], "key string, output string"), "t")
    assert rows(log, "output") == [("new",)]


def test_alignment_attachment_and_merge_of_roles(spark, tmp_path):
    kb = {t: load(spark, DATA, t).limit(0) for t in ("occupations", "skills", "hierarchy", "concept_alignments", "occupation_skill_relations", "unified_skills")}
    made = [
        ("OCC_1", "A", "Network engineer", "", "2523", "builds computer networks"), ("OCC_2", "B", "Network engineers", "", "2523", "builds computer networks"), ("OCC_3", "B", "Pastry cook", "", "", "bakes"),
        ("OCC_4", "N", "Senior network engineering", "", "", "builds networks"), ("OCC_5", "G", "Computer network professionals", "isco_group", "2523", "networks"), ("OCC_6", "G", "Bakers", "isco_group", "7512", "bread"),
    ]
    kb["occupations"] = kb["occupations"].unionByName(frame(spark, made, "entity_id string, source string, pref_label_en string, occupation_type string, isco_code string, description_en string"), allowMissingColumns=True)
    reg = registry.Registry()
    reg.register(registry.Source("N", True, True))
    ctx = pipeline.Context(spark, reg, f"file://{tmp_path}")
    kb = pipeline.stage_attach(ctx, pipeline.stage_align(ctx, kb))
    assert rows(kb["concept_alignments"].where("merge_flag is not null"), "entity_id_a", "entity_id_b", "relation") == [("OCC_1", "OCC_2", "exactMatch")]
    assert rows(kb["occupations"].where("source = 'N'"), "isco_code") == [("2523",)]
    assert rows(kb["hierarchy"], "parent_entity_id", "child_entity_id") == [("OCC_5", "OCC_4")]
    merged = pipeline.stage_merge(ctx, kb)["unified_occupations"]
    assert rows(merged.where("sources = 'A | B'"), "member_entity_ids") == [("OCC_1 | OCC_2",)] and merged.count() == 3


def test_mentions_become_relations(spark):
    kb = {t: load(spark, DATA, t) for t in ("occupations", "skills", "occupation_skill_relations")}
    job = kb["occupations"].where("length(trim(pref_label_en)) > 8").orderBy("entity_id").first()["pref_label_en"]
    skill = kb["skills"].where("length(trim(pref_label_en)) > 8 and source <> 'TAXONOMY'").orderBy("entity_id").first()["pref_label_en"]
    source = registry.ExtractionSource("X", documents=lambda s: s.createDataFrame([(1, "t"), (2, "t"), (3, None)], "doc_id long, text string"), extract=lambda t: [("occupation", job), ("skill", skill), ("skill", skill)])
    new = registry.ingest_mentions(spark, source, kb)["occupation_skill_relations"].where("source = 'X'")
    assert [(r["relation_type"], r["weight"]) for r in new.collect()] == [("demand", "2")]


def test_nodes_under_several_parents_come_out(spark):
    told = frame(spark, [("a", "c", "broader_than"), ("b", "c", "broader_than"), ("c", "d", "broader_than")], "p string, c string, r string")
    got = rows(forest.resolve_all(told, "p", "c", "r"), "entity_id", "root_entity_id", "depth", "cycle_state")
    assert got == [("a", "a", 0, "none"), ("b", "b", 0, "none"), ("c", "a", 1, "none"), ("d", "a", 2, "none")]


def test_command_line(tmp_path):
    (tmp_path / "e").write_text("# x\nSPARK_CONF_a=b\nPATH=zz\n")
    assert cli.settings(str(tmp_path / "e"))["SPARK_CONF_a"] == "b" and cli.settings(str(tmp_path / "e"))["PATH"] != "zz"
    assert cli.settings(str(tmp_path / "none")) == {}
    assert cli.main(["--kb", "x", "--out", "y", "--list"]) == 0
