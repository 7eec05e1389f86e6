import random

import pytest
from pyspark.sql import functions as F

from taxoloom.operators import demand, forest, graph, lookup, orphans, quality, similarity, tables, votes


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


# --- references without records


def existence(spark, data):
    return orphans.existence_deltas(frame(spark, data, "id string, seen timestamp_ntz, gone timestamp_ntz, key string, at string"), "d", "id", "seen", "gone")


def test_orphans(spark):
    from datetime import datetime as dt

    t = [dt(2024, 1, n) for n in range(1, 10)]
    records = existence(spark, [("A", t[2], t[5], "x", "y"), ("A", t[3], t[5], "x", "y"), ("B", t[0], None, None, None), (None, t[0], None, "", ""), ("C", None, None, "", "")])
    refs = [(1, "a ", t[1]), (2, " A", t[2]), (3, "A", t[5]), (4, "Z", t[5]), (5, "", t[5]), (6, None, t[5]), (7, "b", None), (8, "Z", None), (4, "Z", t[5]), (9, "C", t[0])]
    found = orphans.orphan_rows(orphans.reference_rows(frame(spark, refs, "rid long, f string, ts timestamp_ntz").withColumn("key", F.lit("clash")), "t", "rid", "ts", {"f": "d"}), records)
    assert rows(found.distinct(), "row_id", "reason") == [(1, "late"), (3, "deleted"), (4, "missing"), (8, "missing")]


def test_orphan_state_in_two_batches(spark):
    from datetime import datetime as dt

    records = existence(spark, [("A", dt(2024, 1, 1), None, "", "")])
    none = existence(spark, [])
    refs = lambda *keys: frame(spark, [("d", k, 1) for k in keys], "domain string, key string, n int")
    first = orphans.merge_state(none, refs("A", "B", "B"))
    assert rows(orphans.orphan_keys(first), "key", "refs") == [("A", 1), ("B", 2)]
    withdrawn = refs("B").withColumn("n", F.lit(-1))
    second = orphans.merge_state(records, withdrawn, first)
    assert rows(orphans.orphan_keys(second), "key", "refs") == [("B", 1)]


def test_orphans_empty(spark):
    refs = orphans.reference_rows(frame(spark, [], "rid long, f string, ts timestamp_ntz"), "t", "rid", "ts", {"f": "d"})
    assert orphans.orphan_rows(refs, existence(spark, [])).count() == 0


# --- hierarchies


def resolved_by_hand(up):
    out = {}
    for start in set(up) | set(up.values()):
        trail, node = [], start
        while node in up and node not in trail:
            trail.append(node)
            node = up[node]
        if node in up:
            on = start in trail[trail.index(node) :]
            out[start] = ("", -1, "on" if on else "below")
        else:
            out[start] = (node, len(trail), "none")
    return out


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_forest_against_brute_force(spark, seed):
    rng = random.Random(seed)
    up = {}
    for n in range(1, 300):
        up[f"n{n}"] = f"n{rng.randrange(max(0, n - 8), n)}"
    for n in rng.sample(range(1, 300), 4):
        up[f"n{n}"] = f"n{min(299, n + rng.randrange(0, 30))}"
    up["self"] = "self"
    links = frame(spark, list(up.items()), "node string, parent string").repartition(5)
    got = {r[0]: tuple(r[1:]) for r in forest.resolve(links).collect()}
    assert got == resolved_by_hand(up)


def test_long_chain(spark):
    links = frame(spark, [(f"c{n:04d}", f"c{n - 1:04d}") for n in range(1, 1500)], "node string, parent string").repartition(3)
    got = forest.resolve(links)
    assert got.where("cycle_state <> 'none'").count() == 0
    assert got.agg(F.max("depth")).first()[0] == 1499
    deep = forest.paths(links, got).where("entity_id = 'c1499'").first()
    assert len(deep["path"]) == 1500 and deep["path"][0] == "c0000"


def test_directed_links_and_descendants(spark):
    data = [("a", "b", " Broader_Than "), ("c", "b", "narrower_than"), ("b", "a", "narrower_than"), ("", "x", "broader_than"), (None, "y", "broader_than"), ("b", "d", "related_to"), ("b", "e", "broader_than"), ("b", "e", "broader_than"), (None, None, None)]
    links = forest.directed_links(frame(spark, data, "p string, c string, r string").withColumn("node", F.lit("clash")), "p", "c", "r")
    assert rows(links, "node", "parent") == [("b", "a"), ("c", "b"), ("e", "b")]
    tree = frame(spark, [("b", "a"), ("c", "b"), ("d", "b")], "node string, parent string")
    got = rows(forest.descendants(forest.paths(tree)), "entity_id", "descendant_id", "distance")
    assert got == [("a", "b", 1), ("a", "c", 2), ("a", "d", 2), ("b", "c", 1), ("b", "d", 1)]


def test_forest_empty(spark):
    empty = frame(spark, [], "node string, parent string")
    assert forest.resolve(empty).count() == 0
    assert forest.paths(empty).count() == 0


# --- graphs


def test_components_do_not_depend_on_order(spark):
    rng = random.Random(3)
    pairs = [(f"v{rng.randrange(60)}", f"v{rng.randrange(60)}") for _ in range(45)] + [("v1", "unknown")]
    nodes = frame(spark, [(f"v{n}",) for n in range(60)], "node string")
    first = rows(graph.components(frame(spark, pairs, "u string, v string"), nodes), "node", "component")
    rng.shuffle(pairs)
    assert first == rows(graph.components(frame(spark, [(b, a) for a, b in pairs], "u string, v string"), nodes), "node", "component")
    label = dict(first)
    assert all(label[a] == label[b] for a, b in pairs if a in label and b in label)
    assert all(c <= n for n, c in first)


def test_cycles_reach_and_search(spark):
    edges = frame(spark, [("a", "b"), ("b", "c"), ("c", "b"), ("c", "d"), ("r", "a"), ("r", "d")], "u string, v string")
    assert rows(graph.cycle_members(edges), "node") == [("b",), ("c",)]
    assert rows(graph.reached(edges, frame(spark, [("r",)], "node string")), "node", "hops") == [("a", 1), ("b", 2), ("c", 3), ("d", 1), ("r", 0)]
    got = graph.search_two_levels(edges, frame(spark, [("r", 1), ("a", 2)], "node string, ord int"))
    assert rows(got, "node", "branch", "depth") == [("a", "a", 0), ("b", "a", 1), ("c", "a", 2), ("d", "r", 1), ("r", "r", 0)]


def test_remap(spark):
    edges = frame(spark, [("x", "y", 1), ("x", "z", 2), ("q", "y", 3)], "s string, t string, n int")
    members = frame(spark, [("y", "U1"), ("y", "U2")], "entity string, unified string")
    nodes = frame(spark, [("x",), ("U1",)], "id string")
    assert rows(graph.remap(edges, members, nodes), "s", "t", "n") == [("x", "U1", 1)]


# --- tables and votes


def test_tables_round_trips(spark):
    old = frame(spark, [("a", "S1", 1), ("b", "S2", 2), ("b", "S2", 2)], "k string, source string, n int")
    new = frame(spark, [("c", "S1", 3), ("c", "S1", 3)], "k string, source string, n int")
    once = tables.replace_source(old, new, "source", "S1")
    assert rows(once, "k", "n") == [("b", 2), ("b", 2), ("c", 3)]
    assert rows(tables.replace_source(once, new, "source", "S1"), "k", "n") == rows(once, "k", "n")
    grown = tables.insert_absent(old, new, ["k"])
    assert rows(tables.insert_absent(grown, new, ["k"]), "k") == rows(grown, "k")
    assert rows(tables.last_write(frame(spark, [("u", 1, "x"), ("u", 2, "y")], "k string, ts int, v string"), ["k"], [F.col("ts")]), "k", "v") == [("u", "y")]
    assert rows(tables.project(old, ["k", "absent"]), "k", "absent")[0] == ("a", "")


def test_enriched(spark):
    base = frame(spark, [("a", ""), ("b", None), ("c", "own"), ("d", " ")], "k string, f string")
    out = tables.enriched(base, "k", "f", [("one", frame(spark, [("a", "1"), ("a", "0")], "k string, f string")), ("two", frame(spark, [("a", "2"), ("b", "2")], "k string, f string"))])
    assert rows(out, "k", "f", "f_source") == [("a", "0", "one"), ("b", "2", "two"), ("c", "own", "source"), ("d", "", "")]


def test_votes(spark):
    data = [(1, "bb"), (1, "a"), (1, "bb"), (1, "a"), (1, " "), (1, None), (2, "Café"), (2, "cafe"), (2, "tea")]
    for part in (data, data[::-1]):
        df = frame(spark, part, "k int, v string")
        assert rows(votes.majority(df, ["k"], "v"), "k", "v")[0] == (1, "a")
        assert rows(votes.majority(df, ["k"], "v", longest=True), "k", "v")[0] == (1, "bb")
        assert rows(votes.consensus_label(df, ["k"], "v"), "k", "v")[1] == (2, "Café") or rows(votes.consensus_label(df, ["k"], "v"), "k", "v")[1] == (2, "cafe")


# --- look-ups and demand


def test_lookups(spark):
    skills = frame(spark, [("s1", "Data Mining", 1), ("s2", "data mining", 2), ("s3", "Spark (tool)", 3)], "e string, l string, o int")
    index = lookup.label_index(skills, "e", "o", [F.array("l")])
    assert rows(index, "key", "entity") == [("data mining", "s1"), ("spark", "s3")]
    assert rows(lookup.key_join(frame(spark, [(1, "Data minings"), (2, "x")], "i int, t string"), "t", index), "i", "entity") == [(1, "s1")]
    docs = frame(spark, [(1, "we do data mining with spark and big data mining"), (2, None), (3, "")], "d long, t string")
    assert rows(lookup.dictionary_hits(docs, "d", "t", index), "d", "entity") == [(1, "s1"), (1, "s3")]
    phrases = frame(spark, [("big data", "bd"), ("data mining", "dm"), ("big data mining", "bdm"), ("mining", "m")], "key string, entity string")
    assert rows(lookup.longest_hits(docs, "d", "t", phrases), "d", "entity") == [(1, "bdm"), (1, "dm")]
    probes = frame(spark, [("r", ["nothing", "spark", "data mining"])], "o string, p array<string>")
    assert rows(lookup.first_probe(probes, "o", "p", index), "owner", "probe", "entity") == [("r", "spark", "s3")]
    stars = lookup.star_edges(frame(spark, [("a", "k"), ("b", "k"), ("c", "k"), ("d", "z")], "e string, key string"), "e", ["key"], "e")
    assert rows(stars, "a", "b") == [("a", "b"), ("a", "c")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_runs_of_words_stay_where_the_texts_are(spark, monkeypatch):
    phrases = frame(spark, [("big data", "bd"), ("data", "d"), ("data", "d2"), ("a b c d", "d"), ("a b c d e", "x"), ("", "y"), (None, "z"), ("c++", None)], "key string, entity string")
    docs = frame(spark, [(1, "Big DATA, big data; data"), (2, "a b c d e"), (3, None), (4, "a b c"), (5, "C++")], "i long, t string")
    want = [(1, "bd"), (1, "d"), (1, "d2"), (2, "d"), (5, None)]
    hits = lookup.dictionary_hits(docs, "i", "t", phrases)
    assert rows(hits, "i", "entity") == want
    assert "Join" not in plan(hits) and "hashpartitioning" not in plan(hits)
    twice = docs.union(docs).union(frame(spark, [(1, "c++ data"), (None, "data"), (None, "data")], "i long, t string"))
    both = lambda: sorted((str(i), str(e)) for i, e in lookup.dictionary_hits(twice, "i", "t", phrases).collect())
    assert both() == sorted((str(i), str(e)) for i, e in [*want, (1, None), (None, "d"), (None, "d2")])
    few = both()
    monkeypatch.setattr(lookup, "MAX_PHRASES", 7)  # seven have a key
    assert both() == few and "Join" not in plan(lookup.dictionary_hits(docs, "i", "t", phrases))
    monkeypatch.setattr(lookup, "MAX_PHRASES", 6)
    assert both() == few and "SortMergeJoin" in plan(lookup.dictionary_hits(docs, "i", "t", phrases))


def test_longest_phrases_are_found_where_the_texts_are(spark, monkeypatch):
    phrases = frame(spark, [("b c", "bc"), ("a b", "ab2"), ("a b", "ab1"), ("c d e", "cde"), ("a", "a"), ("b", "b"), ("c", "c"), ("d e f g", "x")], "key string, entity string")
    docs = frame(spark, [(1, "A b c d e a"), (2, "a b, a b c b"), (3, None), (4, "d e f g"), (5, "c B")], "i long, t string")
    want = [(1, "a"), (1, "ab1"), (1, "cde"), (2, "ab1"), (2, "b"), (2, "c"), (5, "b"), (5, "c")]
    hits = lookup.longest_hits(docs, "i", "t", phrases)
    assert rows(hits, "i", "entity") == want
    assert "Join" not in plan(hits) and "hashpartitioning" not in plan(hits)
    assert rows(lookup.longest_hits(docs.where("i < 0"), "i", "t", phrases), "i", "entity") == []
    short = [(1, "ab1"), (1, "cde"), (2, "ab1"), (2, "c"), (5, "c")]
    assert rows(lookup.longest_hits(docs, "i", "t", phrases, deny=("a", "b", "a b")), "i", "entity") == short
    twice = docs.union(docs).union(frame(spark, [(5, "a b")], "i long, t string"))  # places of another text don't block
    both = lambda: rows(lookup.longest_hits(twice, "i", "t", phrases), "i", "entity")
    assert both() == sorted([*want, (5, "ab1")])
    monkeypatch.setattr(lookup, "MAX_PHRASES", 0)
    assert both() == sorted([*want, (5, "ab1")]) and "SortMergeJoin" in plan(lookup.longest_hits(docs, "i", "t", phrases))
    assert rows(lookup.longest_hits(docs, "i", "t", phrases, deny=("a", "b", "a b")), "i", "entity") == short


def test_demand(spark):
    index = frame(spark, [("t1", "s"), ("t2", "s")], "key string, entity string")
    data = frame(spark, [(1, "r", "t1"), (1, "r", "t1"), (1, "r", "t2"), (2, "r", "t1")], "p int, role string, tok string")
    assert rows(demand.per_token(data, "p", "role", "tok", index), "weight") == [(3,)]
    assert rows(demand.resolved_counts(data, "p", "role", "tok", index, before=2), "weight") == [(2,)]
    assert rows(demand.resolved_counts(data, "p", "role", "tok", index, after=4), "weight") == []
    assert rows(demand.per_posting(data, "p", "role", "tok", 2), "tok", "weight") == [("t1", 2)]


# --- vectors and quality


def test_cosine_blocks_agree(spark):
    rng = random.Random(5)
    data = [(n, n % 3, [rng.gauss(0, 1) for _ in range(8)]) for n in range(80)] + [(99, 1, None)]
    df = frame(spark, data, "id long, grp int, vec array<double>")
    whole = rows(similarity.cosine_pairs(df, df, 0.2, 4), "a", "b", "sim")
    assert whole and whole == rows(similarity.cosine_pairs(df, df, 0.2, 4, block=13), "a", "b", "sim")
    assert similarity.cosine_pairs(df, df.limit(0), 0.2, 4).count() == 0


def test_decisions(spark):
    rel, conf, flag = similarity.merge_decision(F.lit(True), F.lit(True), F.lit(0.5), F.lit(None).cast("double"), F.lit(False), F.lit(True))
    r = spark.range(1).select(rel, conf, flag).first()
    assert tuple(r) == ("exactMatch", 0.95, "label")
    g = lambda *x: spark.range(1).select(similarity.gate(*map(F.lit, x))).first()[0]
    assert g(0.5, 0.7, 0.1, False) == "nli" and g(0.5, 0.7, None, False) == "keep" and g(0.5, 0.7, 0.1, True) == "malformed"


def test_coverage(spark):
    df = frame(spark, [("a", True, False), ("a", False, True), ("b", False, False)], "s string, e boolean, n boolean")
    assert rows(quality.coverage(df, ["s"], "e", "n"), "s", "n", "exact", "either_pct") == [("ALL", 3, 1, 66.7), ("a", 2, 1, 100.0), ("b", 1, 0, 0.0)]
