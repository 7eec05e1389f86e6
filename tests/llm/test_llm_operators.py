import random
from datetime import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxoloom.llm import abuse, entities, entries, groups, leakage, lookalike, packing, survivor


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# --- 2: groups


def union_find(pairs):
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = sorted((top(a), top(b)))
            up[b] = a
    return sorted((x, top(x)) for x in up)


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_against_union_find(spark, seed):
    rng = random.Random(seed)
    pairs = [(f"v{rng.randrange(400):03d}", f"v{rng.randrange(400):03d}") for _ in range(220)]
    pairs += [(f"w{n:03d}", f"w{n + 1:03d}") for n in range(150)]  # a long chain
    pairs += [("hub", f"x{n:03d}") for n in range(200)] + [("s", "s"), pairs[0], pairs[0][::-1]]
    got = rows(groups.groups(frame(spark, pairs, "u string, v string").withColumn("group_id", F.lit("clash"))), "entity_id", "group_id")
    assert got == union_find(pairs)


def test_group_inputs(spark):
    told = frame(spark, [("a", "b", " Label", 1), ("a", None, "label", 2), ("", "c", "semantic", 3), ("c", "d", "no", 4), ("e", "f", None, 5)], "a string, b string, f string, u int")
    assert rows(groups.merge_pairs(told, "a", "b", "f"), "u", "v") == [("a", "b")]
    lists = frame(spark, [("y | x|z| ",), ("y|y",), (None,), ("",)], "m string")
    assert rows(groups.list_pairs(lists, "m"), "u", "v") == [("x", "y"), ("x", "z")]
    assert groups.groups(frame(spark, [], "u string, v string")).count() == 0


# --- 3: survivors


def test_survivor(spark):
    t = [dt(2024, 1, n) for n in range(1, 9)]
    data = [
        ("g", "r1", t[1], "Old name", "hard", "A|b"), ("g", "r2", t[2], "New name", "N/A", "b"), ("g", "r3", t[3], "SKL_0123456789ab", "soft", "c ; d,C"), ("g", "r3", t[3], "SKL_0123456789ab", "soft", "c ; d,C"),
        ("g", "r4", None, " ", None, None), ("h", "r5", t[1], "-", "???", ""), ("i", "r6", t[1], "x", "y", "zz"), ("i", "r7", t[5], "x2", "\xa0", "yy"),
    ]
    df = frame(spark, data, "group_id string, rid string, built timestamp_ntz, name string, kind string, src string").withColumn("value", F.lit("clash"))
    trust = frame(spark, [("A", 2), ("b", 1), (None, 1), ("c", None)], "source string, trust_rank int")
    votes = survivor.long_votes(df, trust, ("name", "kind", "src"), "rid", "src", "built")
    won = rows(survivor.best_row(votes, by_breadth=("src",)), "group_id", "field_name", "row_id")
    assert won == [("g", "kind", "r1"), ("g", "name", "r2"), ("g", "src", "r3"), ("i", "kind", "r6"), ("i", "name", "r7"), ("i", "src", "r7")]
    golden = survivor.wide(survivor.best_row(votes), ("name", "kind")).where("group_id = 'g'").first()
    assert (golden["name"], golden["kind"]) == ("New name", "hard")
    assert survivor.consensus(votes).where("field_name = 'kind' and group_id = 'g'").first()["value"] == "hard"
    assert survivor.best_row(survivor.long_votes(df.limit(0), trust, ("name",), "rid", "src", "built")).count() == 0


# --- 4: look-alikes


def test_canonical():
    same = ["paiement en ligne", "pаіеment en lіgne", "ｐａｉｅｍｅｎｔ en ligne", "paie​ment en\xa0ligne ", "﻿paiement en ligne", "pai\xadement en ligne"]
    assert {lookalike.canonical(s) for s in same} == {"paiement en ligne"}
    assert lookalike.canonical("réseau") == lookalike.canonical("réseau") == lookalike.canonical("rе́seau") == "réseau"
    assert lookalike.canonical("ﬁn") == "fin" and lookalike.canonical("a‑b") == "a-b"
    assert lookalike.canonical("Москва банк") == "Москва банк"  # a text of one script stays
    assert lookalike.canonical("ОРЕN") == "OPEN"
    for other in ("Paiement en ligne", "paiement  en ligne", "paiément en ligne"):
        assert lookalike.canonical(other) != "paiement en ligne"
    assert lookalike.canonical(None) is None and lookalike.canonical("") == ""
    long = "аб" * 20000 + " x"
    assert len(lookalike.canonical(long)) == len(long)


def test_alike_pairs(spark):
    df = frame(spark, [("a", "ok"), ("b", "оk"), ("b", "оk"), ("c", "ok"), ("d", None), ("e", ""), ("f", "​"), (None, "ok"), ("g", "other")], "id string, l string").withColumn("form", F.lit(1))
    assert rows(lookalike.alike_pairs(df, "id", "l"), "entity_id_a", "entity_id_b") == [("a", "b"), ("b", "c")]
    assert lookalike.alike_pairs(df.limit(0), "id", "l").count() == 0


# --- 5: reference lists

LIST = [(1, "Développeur mobile", None), (2, "Développeur jeux vidéo", "Video Games Developer"), (3, "Chef de projet web", "Web Project Manager"), (4, "Testeur mobile", "Mobile Tester"), (5, "Chef de projet mobile", None), (6, "Testeur web", "Web Tester")]


@pytest.mark.parametrize(
    "said, entry",
    [
        ("DÉVELOPPEUR MOBILE H/F", 1), ("Developpeuse en mobile (CDI)", 1), ("devleoppeur jv", 2), ("Mobile Developer", 1), ("Games developer, video", 2), ("CDP mob.", 5), ("Cheffe de projet - web", 3), ("web project mangaer", 3),
        ("Testeur·se mobile", 4), ("Développeur web", None), ("Chef de rang", None), ("mobile", None), ("", None), (None, None), ("Boulanger", None), ("x" * 5000, None),
    ],
)
def test_entries(spark, said, entry):
    listed = frame(spark, LIST, "title_id long, fr string, en string")
    got = entries.match(frame(spark, [(1, said, "x"), (2, said, "y")], "n int, t string, token string"), "t", listed, "title_id", "fr", "en").collect()
    assert len(got) == 2 and {r["title_id"] for r in got} == {entry}


def test_entries_rank_by_closeness(spark):
    listed = frame(spark, [("b", "Conseiller ventes", None), ("a", "Conseiller vente", None), ("c", "Conseiller tri", None)], "code string, fr string, en string")
    got = {r["t"]: (r["code"], r["score"]) for r in entries.match(frame(spark, [("conseiller ventes",), ("conseiller vente",), ("conseiler vente",)], "t string"), "t", listed, "code", "fr", "en").collect()}
    assert got["conseiller ventes"] == ("b", 1.0) and got["conseiller vente"] == ("a", 1.0)
    assert got["conseiler vente"][0] == "a" and 0.8 < got["conseiler vente"][1] < 1.0


def test_entries_empty(spark):
    none = frame(spark, [], "title_id long, fr string, en string")
    assert entries.match(frame(spark, [("a",)], "t string"), "t", none, "title_id", "fr", "en").first()["title_id"] is None


def test_edit_distance():
    assert entries.osa("abcd", "abdc", 2) == 1 and entries.osa("abc", "abc", 1) == 0 and entries.osa("abc", "xyz", 1) == 2


# --- 6.. 7: entities


def test_entities(spark):
    rng = random.Random(4)
    acts = [("repair", "fix"), ("audit", "examine"), ("index", "catalogue")]
    things = [("message queues", "queueing channels"), ("web forms", "online forms"), ("radio antennas", "aerials"), ("search indexes", "lookup indexes")]
    tools = ["Kaninos", "Bugeron", "Vesikax", "Mobazex", "Tutidik"]
    data, truth = [], {}
    for n in range(900):
        a, t, w = rng.randrange(3), rng.randrange(4), rng.choice(tools)
        act, thing = rng.choice(acts[a]), rng.choice(things[t])
        label = rng.choice([f"{act} {thing} with {w}", f"{w}: {act} {thing}", f"{act} of {thing} ({w})"])
        if n % 50 == 7:
            label = label.replace(w, w[:3] + w[4:])
        data.append((f"e{n:04d}", f"S{n % 4}", label, None, f"Being able to {rng.choice(acts[a])} {rng.choice(things[t])} using the {w} toolset.", None))
        truth[f"e{n:04d}"] = (a, t, w)
    data += [("z1", "S1", None, None, None, None), (None, "S1", "x", None, None, None), ("z2", None, "x", None, None, None), ("z3", "S2", "", None, "", None), data[0]]
    df = frame(spark, data, "id string, source string, label string, described string, other string, code string").withColumn("node", F.lit("clash"))
    got = {tuple(r) for r in entities.matched_pairs(entities.link(df)).select("entity_id_a", "entity_id_b").collect()}
    source = {d[0]: d[1] for d in data}
    want = {(a, b) for a in truth for b in truth if a < b and truth[a] == truth[b] and source[a] != source[b]}
    assert len(got & want) / len(want) > 0.95 and len(got & want) / len(got) > 0.99
    assert entities.matched_pairs(entities.link(df.limit(0))).count() == 0


def test_records_of_rare_words_stay(spark):
    data = [(f"e{n:04d}", f"S{n % 3}", f"audit web forms with Tool{n % 5}ax", None, None, None) for n in range(600)]
    data += [("r1", "S1", "Zymurgist, Quokka", None, None, None), ("r2", "S2", "quokka zymurgist", None, None, None), ("r3", "S1", "Москва", None, None, None), ("r4", "S2", "москва", None, None, None), ("r5", "S2", "zymurgist", None, None, None)]
    df = frame(spark, data, "id string, source string, label string, described string, other string, code string")
    got = {tuple(r) for r in entities.matched_pairs(entities.link(df)).where("entity_id_a like 'r%' or entity_id_b like 'r%'").select("entity_id_a", "entity_id_b").collect()}
    assert got == {("r1", "r2"), ("r3", "r4")}


def test_rare_synonyms_are_learnt_whatever_the_rest(spark):
    many = [(f"audit number{n % 7}", f"audit number{n % 7}") for n in range(40000)]
    few = [(f"{'steer' if n % 2 else 'pilot'} kite{n % 3}", f"{'pilot' if n % 2 else 'steer'} kite{n % 3}") for n in range(60)]
    told = frame(spark, many + few, "label string, other string").selectExpr("'x' id", "'s' source", "null code", "label", "other", "null described")
    attribute, frequent = entities.learn(entities.tokenised(told))
    assert attribute["steer"] == attribute["pilot"] and "kite1" in frequent
    assert entities._sure({"bofutak": 900, "bo": 30, "futak": 28, "data": 500, "base": 400, "database": 900}) == {"bofutak", "data", "base", "database"}


def test_entities_in_other_frames(spark):
    """Nothing is bound to the wording around the attributes."""
    rng = random.Random(11)
    roles, places, crafts = [("baker", "bread maker"), ("guide", "tour leader"), ("tailor", "clothes maker")], [("harbour", "docks"), ("market", "trade square"), ("castle", "old fortress")], ["violet", "amber", "indigo", "crimson", "teal"]
    data, truth = [], {}
    for n in range(900):
        r, p, c = rng.randrange(3), rng.randrange(3), rng.choice(crafts)
        role, place = rng.choice(roles[r]), rng.choice(places[p])
        label = rng.choice([f"{c}: {role} at the {place}", f"{role}, {place}, {c}", f"{place}: {role} in {c}"])
        told = f"Hired since spring. Folks call this a {rng.choice(roles[r])}; daily walks lead past the {rng.choice(places[p])}, in {c}. Lunch provided."
        data.append((f"e{n:04d}", f"S{n % 4}", label, None, told, None))
        truth[f"e{n:04d}"] = (r, p, c)
    df = frame(spark, data, "id string, source string, label string, described string, other string, code string")
    linked = entities.link(df).cache()
    got = {tuple(r) for r in entities.matched_pairs(linked).select("entity_id_a", "entity_id_b").collect()}
    source = {d[0]: d[1] for d in data}
    want = {(a, b) for a in truth for b in truth if a < b and truth[a] == truth[b] and source[a] != source[b]}
    assert len(got & want) / len(want) > 0.95 and len(got & want) / len(got) > 0.99
    classes = {r["entity_id"]: (r["class_id"], r["links"]) for r in entities.classes_of(linked).collect()}
    assert set(classes) == set(truth) and sum(n for _, n in classes.values()) == 2 * len(got)
    assert all(classes[a][0] == classes[b][0] for a, b in got)


def test_candidate_graph(spark):
    nodes = frame(spark, [("a|b|c", ["a", "b", "c"]), ("a|b|d", ["a", "b", "d"]), ("a|b|c|e", ["a", "b", "c", "e"]), ("x|y", ["x", "y"])], "node string, all array<string>")
    seen = frame(spark, [(w, 2.0) for w in "abcdexy"] + [("z", 9.0)], "attribute string, idf double")
    classes = frame(spark, [("1", ["a", "b"], "cc"), ("2", ["a", "b"], "cc ee"), ("3", ["x"], "yy"), ("4", ["z"], "a")], "class string, have array<string>, left string")
    edges = entities.candidates(classes, nodes, seen)
    got = sorted((r["class"], r["node"], tuple(r["missing"]), round(r["weight"], 3)) for r in edges.collect())
    assert got == [("1", "a|b|c", ("c",), 0.667), ("1", "a|b|d", ("d",), 0.667), ("2", "a|b|c", ("c",), 0.667), ("2", "a|b|c|e", ("c", "e"), 0.5), ("2", "a|b|d", ("d",), 0.667), ("3", "x|y", ("y",), 0.5)]


def test_neighbours_tell_what_a_word_stands_for(spark):
    """A word unlike any attribute, left over in several classes that all lack the same one; a word like an attribute needs no neighbour."""
    edges = [(f"c{n}", "zap", f"n{n}", ["tool"], 0.8) for n in range(5)] + [("c0", "zap", "m0", ["other"], 0.8), ("d", "toool", "n9", ["tool"], 0.8), ("e", "lone", "n9", ["tool"], 0.8), ("f", "toool mane", "n8", ["tool", "name"], 0.5)]
    seen = frame(spark, [("tool", 2.0), ("other", 2.0), ("name", 2.0)], "attribute string, idf double")
    forms = frame(spark, [("tool", "tool"), ("name", "name")], "attribute string, form string")
    df = frame(spark, edges, "class string, left string, node string, missing array<string>, weight double")
    got = {r["class"]: r["node"] for r in entities.propagate(df, forms, seen, entities.Scratch(spark, "t"), 0.7, 0.85).collect()}
    assert got == {f"c{n}": f"n{n}" for n in range(5)} | {"d": "n9"}
    assert entities.propagate(df.limit(0), forms, seen, entities.Scratch(spark, "t"), 0.7, 0.85).count() == 0


def test_decoration_goes(spark):
    data = [(f"e{n:04d}", f"S{n % 3}", f"audit {['forms', 'queues'][n // 2 % 2]} with Tool{'abcde'[n // 4 % 5]}x{' deluxe' if n % 2 else ''}", None, None, None) for n in range(600)]
    df = frame(spark, data, "id string, source string, label string, described string, other string, code string")
    assert entities.link(df).select("node").distinct().count() == 10


def test_whole_descriptions_are_read(spark):
    acts, things, tools = ["audit", "repair", "index"], ["webforms", "antennas", "queues", "sensors"], ["Kaninos", "Bugeron", "Vesikax", "Mobazex", "Tutidik"]
    data = [(f"e{n:04d}", f"S{n % 3}", f"{acts[n % 3]} {things[n // 3 % 4]} with {tools[n // 12 % 5]}", None, None, None) for n in range(600)]
    late = "Starts early. Meets people, e.g. neighbours. Likes tea. Has to audit things. Often on webforms. Relies on Kaninos."
    data += [("z1", "S9", None, late, None, None), ("z2", "S9", None, "Will repair antennas by Bugeron. Meets queues.", None, None), ("z3", "S9", None, "Will audit webforms.", None, None)]
    df = frame(spark, data, "id string, source string, label string, described string, other string, code string")
    node = {r["id"]: r["node"] for r in entities.link(df).where("id like 'z%'").collect()}
    assert node == {"z1": "audit|kaninos|webforms", "z2": "antennas|bugeron|repair", "z3": "audit|webforms"}


def test_blank_labels_are_no_labels(spark):
    data = [(f"e{n:02d}", f"S{n % 3}", f"audit webforms with {['Kaninos', 'Bugeron'][n % 2]}", None, None, None) for n in range(60)]
    data += [(f"z{n}", "S9", label, "Has to audit things. Often on webforms. Relies on Kaninos.", None, None) for n, label in enumerate(["", "  ", "\xa0"])]
    df = frame(spark, data, "id string, source string, label string, described string, other string, code string")
    assert {r["node"] for r in entities.link(df).where("id like 'z%'").collect()} == {"audit|kaninos|webforms"}


# --- 8: packing


def test_packing(spark):
    rng = random.Random(6)
    data = [(n, rng.randrange(1, 400)) for n in range(1500)] + [(5000, 2500), (5001, 512), (5002, 0), (5000, 2500)]
    caps = frame(spark, [(1, 512), (2, 1000), (3, 0)], "size_id long, capacity_tokens int")
    out = packing.pack(frame(spark, data, "doc_id long, n_tokens long"), caps, "doc_id", shard_items=400)
    back = out.groupBy("size_id", "doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("pieces"))
    want = sorted((s, d, n) for s in (1, 2) for d, n in dict(data).items() if n)
    assert rows(back, "size_id", "doc_id", "n") == want
    cap = {1: 512, 2: 1000}
    assert all(r["pieces"] == -(-r["n"] // cap[r["size_id"]]) for r in back.collect())
    full = out.groupBy("size_id", "shard", "container").agg(F.sum("n_tokens").alias("n")).collect()
    assert all(r["n"] <= cap[r["size_id"]] for r in full)
    for s in cap:
        mine = [r["n"] for r in full if r["size_id"] == s]
        assert sum(mine) / (len(mine) * cap[s]) > 0.95


def test_packing_into_many_capacities(spark):
    caps = frame(spark, [(n, 10 + n) for n in range(1203)], "size_id long, capacity_tokens int")
    out = packing.pack(frame(spark, [(1, 7), (2, 4)], "doc_id long, n_tokens long"), caps, "doc_id")
    assert out.select("size_id", "doc_id").distinct().count() == 2 * 1203
    assert packing.pack(frame(spark, [(1, 7)], "doc_id long, n_tokens long"), caps.limit(0), "doc_id").count() == 0


def test_token_counts(spark):
    texts = frame(spark, [(1, "hello world"), (2, ""), (3, None), (4, "é" * 3000)], "doc_id long, text string")
    got = dict(rows(packing.token_counts(texts, "doc_id", "text"), "doc_id", "n_tokens"))
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] > 100


def test_levels_pick_the_smallest_sum_of_squares():
    state = packing.Levels(10)
    assert [state.place(6), state.place(6), state.place(4)] == [0, 1, 1]  # filling a container up leaves one of two alike


# --- 9: leaked texts


def test_leaks_against_brute_force(spark):
    rng = random.Random(8)
    vocab = [f"w{n}" for n in range(30)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(40))) for i in range(12)]
    docs = []
    for n in range(150):
        base = [rng.choice(vocab) for _ in range(rng.randrange(0, 60))]
        if n % 3 == 0:
            words = items[rng.randrange(12)][1].split()
            at, k = rng.randrange(25), rng.choice([11, 12, 13, 14, 20])
            piece = [w.upper() if rng.random() < 0.2 else w for w in words[at : at + k]]
            base[len(base) // 2 : len(base) // 2] = ["<b>" + piece[0] + "</b>", *piece[1:]]
        docs.append((n, (", " if n % 2 else " ").join(base)))
    docs += [(900, None), (901, ""), (902, " ".join(vocab) * 400 + " " + items[0][1]), (903, items[1][1]), (903, items[1][1])]
    items += [(50, None), (51, ""), (52, "too short"), items[0]]

    def shared(a, b):
        x, y = leakage.words(a), leakage.words(b)
        grams = {tuple(y[i : i + 13]) for i in range(len(y) - 12)}
        return any(tuple(x[i : i + 13]) in grams for i in range(len(x) - 12))

    want = sorted({(d, i) for d, t in docs if t for i, u in items if u and shared(t, u)})
    d = frame(spark, docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    e = frame(spark, items, "item_id long, text string")
    assert want and rows(leakage.leaks(d, e), "doc_id", "item_id") == want
    assert leakage.leaks(d, e.limit(0)).count() == 0 and leakage.leaks(d.limit(0), e).count() == 0


def test_long_tags_do_not_part_a_run(spark):
    words = [f"w{n}" for n in range(14)]
    text = " ".join(words[:7]) + f' <a href="{"x" * 3000}">' + " ".join(words[7:])
    d = frame(spark, [(1, text), (1, text), (2, " ".join(words[:12])), (1, "told otherwise")], "doc_id long, text string")
    e = frame(spark, [("i", " ".join(words)), ("i", " ".join(words))], "item_id string, text string")
    assert rows(leakage.leaks(d, e), "doc_id", "item_id", "run_words") == [(1, "i", 14)]


# --- 10: abusive language


def labelled(seed, n):
    rng = random.Random(seed)
    fine = ["the team builds {} every week", "we like {} and tea", "my {} is late but fine", "please review the {} today", "the rules forbid words like idiot in {}"]
    bad = ["you are a stupid {} and everybody knows", "shut up you filthy {}", "get lost, worthless {}", "i hate you, you dumb {}"]
    nouns = ["report", "server", "garden", "cat", "plan", "table"]
    out = []
    for _ in range(n):
        text = [rng.choice(fine).format(rng.choice(nouns)) for _ in range(rng.randrange(1, 9))]
        y = rng.random() < 0.25
        if y:
            s = rng.choice(bad).format(rng.choice(nouns))
            text.insert(rng.randrange(len(text) + 1), s.upper() if rng.random() < 0.2 else s)
        out.append((". ".join(text) + ".", float(y)))
    return out


def test_abuse_held_out():
    train, held = labelled(1, 500), labelled(2, 300)
    rng = np.random.default_rng(3)
    y = np.array([v for _, v in train])
    noisy = np.where(rng.random(len(y)) < 0.05, 1 - y, y)
    w, b = abuse.fit([t for t, _ in train], noisy, np.where(rng.random(len(y)) < 0.5, 2.0, 1.0))
    s = abuse.scores([t for t, _ in held], w, b) >= 0.5
    truth = np.array([v for _, v in held]) > 0.5
    assert (s == truth).mean() > 0.95
    long = "the team builds tables every week. " * 3000
    assert abuse.scores([None, "", long, long + "shut up you filthy cat."], w, b).round(2)[[0, 1]].tolist() == [0, 0]
    a, c = abuse.scores([long, long + "shut up you filthy cat."], w, b)
    assert a < 0.5 <= c
    assert (abuse.scores(["sh​ut up yоu f1lthy cat", "s h u t up you fiiiilthy cat"], w, b) >= 0.5).all()


def test_abuse_on_frames(spark):
    docs = frame(spark, [(n, t) for n, (t, _) in enumerate(labelled(5, 200))] + [(900, None), (901, " ")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    labels = frame(spark, [(n, "a", int(v)) for n, (_, v) in enumerate(labelled(5, 200))] + [(0, "b", None), (None, "a", 1)], "doc_id long, annotator string, abusive int")
    model = abuse.train(docs, labels, "doc_id", "text", "abusive", "annotator")
    out = abuse.score(docs, model, "text")
    assert out.count() == 202 and out.where("doc_id >= 900 and score > 0").count() == 0
    none = abuse.train(docs, labels.limit(0), "doc_id", "text", "abusive", "annotator")
    assert abuse.score(docs, none, "text").where("score > 0.01").count() == 0
