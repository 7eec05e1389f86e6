import json
import os
import uuid

import pytest
from tests.conftest import DATA
from pyspark.sql import functions as F

from taxoloom.plans import pipeline, providers
from taxoloom.session import Scratch, load, sweep
from taxoloom.sources import exports, loaders, readers, registry, sinks
from taxoloom.streaming import postings


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_readers(spark, tmp_path):
    assert readers.read_table(spark, f"file://{tmp_path}/none.csv", ["a", "b"]).count() == 0
    (tmp_path / "x.csv").write_bytes("﻿a;b\n1;é\n;x\n".encode("utf-8"))
    got = readers.read_smart(spark, f"file://{tmp_path}/x.csv", ["a", "b", "c"])
    assert sorted(tuple(r) for r in got.collect()) == [("", "x", ""), ("1", "é", "")]
    (tmp_path / "y.csv").write_bytes("a,b\n1,é€\n".encode("cp1252"))
    assert readers.sniff((tmp_path / "y.csv").read_bytes()) == ("windows-1252", ",")
    assert readers.read_smart(spark, f"file://{tmp_path}/y.csv", ["b"]).first()[0] == "é€"
    os.makedirs(tmp_path / "s" / "t")
    (tmp_path / "s" / "t" / "p.csv").write_text("title,url\nDev,u1\n,u2\n")
    assert readers.read_snapshots(spark, f"file://{tmp_path}/s", ["title", "url"], "title").count() == 1
    (tmp_path / "train.json").write_text('{"tokens": ["a"], "tags": ["B"]}\n')
    assert readers.read_splits(spark, f"file://{tmp_path}").first()["split"] == "train"


def test_loaders(spark):
    wide = frame(spark, [("1", "One", "11", "Eleven", 1), ("1", "Uno", "12", "Twelve", 2)], "a string, al string, b string, bl string, o int")
    defs = frame(spark, [("12", "Dozen", "twelve things")], "code string, title string, definition string")
    got = loaders.levels(wide, [("a", "al"), ("b", "bl")], order="o", definitions=defs)
    assert sorted(tuple(r) for r in got.collect()) == [("1", "One", 1, ""), ("11", "Eleven", 2, ""), ("12", "Dozen", 2, "twelve things")]
    triples = frame(spark, [("x", "label", "X"), ("x", "up", "y"), ("x", "rel", "z")], "s string, p string, o string")
    parts = loaders.predicates(triples, "label", "up", "same", "rel")
    assert parts["related"].count() == 2 and parts["canonical"].count() == 0
    rowset = frame(spark, [("s", "[['17.0', 'a'], ['x']]"), ("t", "[['x']]"), ("u", "bad")], "k string, p string")
    assert [r["k"] for r in loaders.first_path(rowset, "p", "17.0").collect()] == ["s"]
    texts = frame(spark, [("k", "b", "2"), ("k", "a", "10"), ("k", " ", "1")], "k string, t string, p string")
    assert loaders.texts_in_order(texts, ["k"], "t", "p").first()["text"] == "b a"
    routed = loaders.routed(frame(spark, [("1", "k"), ("2", "k"), ("3", "k")], "r string, k string"), "r", {"1": frame(spark, [("k", "one")], "k string, label string"), "2": frame(spark, [("k", "two")], "k string, label string")}, "k")
    assert sorted(r["label"] for r in routed.collect()) == ["one", "two"]


def sample_source(spark_rows):
    return registry.StructuredSource("DEMO", True, True, True, True, occupations=lambda s: s.createDataFrame(spark_rows, "source_id string, pref_label_en string, pref_label_fr string"), skills=lambda s: s.createDataFrame([("k1", "audit of things", ""), ("k2", "(junk", "")], "source_id string, pref_label_en string, pref_label_fr string"))


def test_registry(spark):
    reg = registry.Registry()
    reg.register(sample_source([]))
    with pytest.raises(ValueError):
        reg.register(registry.Source("DEMO"))
    assert reg.attaching() == ["DEMO"] and reg.get("DEMO").screened
    assert reg.get("DEMO").entities(spark, "skills").count() == 1
    assert reg.get("DEMO").blocked(spark, "skills").first()["reason"] == "malformed"
    ex = registry.ExtractionSource("X", documents=lambda s: s.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"), extract=lambda t: [("skill", w) for w in t.split()])
    assert ex.mentions(spark).count() == 2


def test_add_then_remove_restores(spark, tmp_path):
    kb = {t: load(spark, DATA, t) for t in ("occupations", "skills", "hierarchy", "occupation_skill_relations", "concept_alignments", "unified_skills")}
    reg = registry.Registry()
    reg.register(sample_source([("o1", "brand new role", "")]))
    ctx = pipeline.Context(spark, reg, f"file://{tmp_path}/kb", "DEMO")
    base = pipeline.run(pipeline.Context(spark, registry.Registry(), f"file://{tmp_path}/base"), kb, ["hierarchy", "align", "merge"])
    added = pipeline.add_source(ctx, base, "DEMO")
    assert added["skills"].where("source = 'DEMO'").count() == 1 and added["occupations"].where("source = 'DEMO'").count() == 1
    assert added["qa"].count() == 13
    gone = pipeline.remove_source(pipeline.Context(spark, reg, f"file://{tmp_path}/gone"), added, "DEMO")
    for t in ("occupations", "skills", "unified_skills"):
        keys = [c for c in base[t].columns if c != "built_at"]
        assert gone[t].select(*keys).exceptAll(base[t].select(*keys)).count() == 0, t
        assert gone[t].count() == base[t].count()


def test_align_falls_back_to_french(spark, tmp_path):
    kb = {t: load(spark, DATA, t).limit(0) for t in ("skills", "concept_alignments")}
    made = [("SKL_1", "A", None, "Travail en équipe"), ("SKL_2", "B", " ", "travail en equipe"), ("SKL_3", "C", "teamwork", "Travail en équipe")]
    skills = kb["skills"].unionByName(frame(spark, made, "entity_id string, source string, pref_label_en string, pref_label_fr string"), allowMissingColumns=True)
    got = pipeline.stage_align(pipeline.Context(spark, registry.Registry(), f"file://{tmp_path}"), kb | {"skills": skills})["concept_alignments"]
    assert [(r["entity_id_a"], r["entity_id_b"], r["merge_flag"]) for r in got.collect()] == [("SKL_1", "SKL_2", "label")]


def test_stages():
    assert pipeline.chosen(None, "align", "merge") == ["align", "attach", "merge"]
    assert pipeline.chosen(["qa", "ingest"]) == ["ingest", "qa"]
    with pytest.raises(ValueError):
        pipeline.chosen(["x"])


def test_propose_and_verify(spark):
    targets = frame(spark, [("a",), ("b",), ("c",)], "k string")
    propose = lambda t, n: t.withColumn("v", F.lit(n))
    verify = lambda p: p.withColumn("ok", (F.col("k") == "a") | (F.col("v") == 1) & (F.col("k") == "b"))
    done, left = pipeline.propose_and_verify(targets, propose, verify, "k")
    assert sorted(r["k"] for r in done.collect()) == ["a", "b"] and [r["k"] for r in left.collect()] == ["c"]


def test_providers(spark):
    df = frame(spark, [("x", "y")], "a string, b string")
    assert df.select(providers.Entailment().mutual(F.col("a"), F.col("b"))).first()[0] is None
    model = providers.BatchEntailment(lambda pairs: [0.2 if p == "x" else 0.7 for p, _ in pairs])
    assert df.select(model.mutual(F.col("a"), F.col("b"))).first()[0] == 0.2
    assert df.select(providers.TextMaker().answers(F.col("a"))).first()[0] is None
    assert df.select(providers.TextMaker(lambda ps: [p * 2 for p in ps]).answers(F.col("a"))).first()[0] == "xx"
    kept = providers.KeptVectors(frame(spark, [("x", [1.0])], "text string, vec array<double>"), lambda fresh: fresh.withColumn("vec", F.array(F.lit(0.0))))
    assert sorted(r["vec"] for r in kept.vectors(frame(spark, [("x",), ("z",)], "t string"), "t").collect()) == [[0.0], [1.0]]
    pages = frame(spark, [("u", '<script type="application/ld+json">{"@type": "JobPosting", "title": "Dev", "description": "<b>do</b>"}</script>'), ("v", "<h1>Ops</h1>" + "word " * 60), ("w", "<h1>short</h1>")], "url string, html string")
    assert sorted((r["url"], r["title"]) for r in providers.postings_of(pages).collect()) == [("u", "Dev"), ("v", "Ops")]
    assert providers.lookup_batches(["a"], lambda b: None) == []
    assert providers.lookup_batches(["a"], lambda b: json.dumps({"results": {"bindings": [{"q": {"value": "Q1"}}]}})) == [{"q": "Q1"}]


def test_sinks_and_exports(spark, tmp_path):
    data = frame(spark, [("a", "S1"), ("b", "S2")], "k string, source string")
    path = f"file://{tmp_path}/t"
    sinks.write_by_source(data, path)
    sinks.write_by_source(frame(spark, [("c", "S1")], "k string, source string"), path)
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == ["b", "c"]
    sinks.write_snapshot(None, frame(spark, [("k", 1, "x"), ("k", 2, "y")], "k string, at int, v string"), ["k"], "at", f"file://{tmp_path}/s")
    assert spark.read.parquet(f"file://{tmp_path}/s").first()["v"] == "y"
    assert "| a | S1 |" in sinks.report(data, "R")
    nodes = frame(spark, [("n<1", 'say "x"')], "id string, label string")
    edges = frame(spark, [("n<1", "n<1")], "s string, t string")
    exports.write_graphml(nodes, edges, f"{tmp_path}/g.xml")
    import xml.etree.ElementTree as ET

    assert len(ET.parse(f"{tmp_path}/g.xml").getroot()) == 5
    exports.write_json(nodes, edges, f"file://{tmp_path}/j")
    assert {json.loads(r[0])["is"] for r in spark.read.text(f"file://{tmp_path}/j").collect()} == {"node", "edge"}
    exports.write_ntriples(frame(spark, [("<urn:a>", "skos:prefLabel", '"x"')], "s string, p string, o string"), f"file://{tmp_path}/n", {"skos": "http://www.w3.org/2004/02/skos/core#"})
    assert spark.read.text(f"file://{tmp_path}/n").first()[0] == '<urn:a> <http://www.w3.org/2004/02/skos/core#prefLabel> "x" .'
    exports.write_page(frame(spark, [("n", 0.0, 1.0)], "id string, x double, y double"), edges, f"{tmp_path}/p.html")
    assert "<svg" in open(f"{tmp_path}/p.html").read()


def test_stream_keeps_last(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"file://{tmp_path}/out"
    frame(spark, [("u", 1, "old"), ("v", 1, "only")], "k string, at int, v string").coalesce(1).write.parquet(src)
    frame(spark, [("u", 2, "new")], "k string, at int, v string").coalesce(1).write.mode("append").parquet(src)
    stream = postings.read_folder(spark, src, "k string, at int, v string", 1)
    q = stream.writeStream.foreachBatch(postings.keep_last(out, ["k"], "at")).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    name = spark.read.text(f"{out}/CURRENT").first()[0]
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(f"{out}/{name}").collect()) == [("u", "new"), ("v", "only")]


def test_scratch(spark):
    s = Scratch(spark, uuid.uuid4().hex)
    df = s.cut(spark.range(5))
    assert df.count() == 5
    s.drop(df)
    assert not readers.exists(spark, f"{s.base}/0")
    s.cut(spark.range(2))
    assert readers.exists(spark, s.base)
    assert sweep(spark) > 0 and not readers.exists(spark, s.base)
