"""Matching entities across sources without keys, by collective linkage in a graph of records.

Attributes are the phrases of a record's label.  Sources name the same attribute differently, so phrases are linked
first: where a label says p and the record's own other text says q in its place, p and q may name one attribute.  Such
links are weighted by how often they are seen against how often their ends are, and must be seen far more often than
chance would have it; weak ones are pruned, and so are those that shorter links explain, again and again until none is
left to prune.  The phrases that stay linked are one attribute.  Words no phrase has are repaired by edit distance to
frequent words, joined or cut where that helps.  A word is left out where the records that have it are found without it
too: it decorates and tells nothing.

Records that say the same, word for word after this, are one class; all further work is on classes.

1. Candidate graph.  A class whose words are all placed is a node.  A class with words left over is joined with the
   nodes that share its two rarest attributes, taken together, so no hot attribute alone makes candidates.  An edge's
   weight is the share of the union's rarity (log of inverse frequency) that both sides have.
2. Meta-blocking.  Of each class only the edges that weigh at least half of its heaviest edge are kept.
3. Propagation.  The words left over stand against the attributes that are missing.  Their similarity is that of their
   spelling, or that of their neighbours: words left over in several classes whose kept edges nearly all lack one and
   the same attribute name that attribute.  An edge's similarity is its weight with the missing attributes added as far
   as they are alike.  Each class goes to its most similar node if that reaches ``enough``; what it took away from the
   ambiguity changes the neighbours' similarities, so this is repeated until nothing changes.

Two nodes differ in an attribute that is known and not the other's, so their similarity can't reach ``enough`` and they
are never compared.  The statistics cover all records; the driver gets the phrases and words that at least ``support``
records have, which grow with the vocabulary and not with the records.  A record none of whose words is known is known
by all its words.

Nulls: a record without a label, blank ones too, is read from its whole description and goes to the node with most
attributes, all of them named there, else it is known by all of them; without both it matches nothing, and so does one
without an id or source.  Repeated records count once; records of one source are never matched.  Empty tables give an
empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxoloom.llm.entries import deletions, osa, reach
from taxoloom.llm.lookalike import canonical
from taxoloom.session import Scratch, bare, spread

#: Function words of English, which are part of no attribute.
JOINERS = frozenset(
    """a about above after against all also am an and any are as at be been before being below between both but by can could did do does
    doing during each few for from had has have having he her here hers him his how i if in into is it its itself may me might more most
    must my no nor not of on one or other our out over own per same shall she should so some such than that the their them then there
    these they this those through to too under up upon us via was we were what when where which while who whom whose why will with within
    without would you your using""".split()
)
_WORD = re.compile(r"[a-z0-9]+(?:[-'][a-z0-9]+)*\.?|[,;:()|/]|\s-\s|\.")
MOST_WORDS = 3


def words(text: str | None) -> list[str]:
    """Words of a text in lower case and one spelling; '|' where punctuation parts them."""
    out: list[str] = []
    for m in _WORD.findall((canonical(text) or "").lower().replace('"', "")):
        m = m.strip()
        if m in ",;:()|/-.":
            out.append("|")
        elif m.endswith("."):
            out += [m[:-1], "."]
        else:
            out.append(m)
    return out


def phrases(ws: list[str]) -> set[str]:
    """Runs of up to three words that no joiner or punctuation parts."""
    found = set()
    for i in range(len(ws)):
        run: list[str] = []
        for w in ws[i : i + MOST_WORDS]:
            if w in ("|", ".") or w in JOINERS:
                break
            run.append(w)
            found.add(" ".join(run))
    return found


def tokenised(records: DataFrame) -> DataFrame:
    """The records with ``label_words``, ``other_words`` and, of those without a label, ``described_words``; every text is cut once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            label = frame["label"].map(lambda t: words(t) if t else None)
            other = frame["other"].map(lambda t: words(t) if t else None)
            described = [words(t) if t and not k else None for k, t in zip(frame["label"], frame["described"])]
            said = [whole(k or t) for k, t in zip(frame["label"], frame["described"])]
            yield frame[["id", "source", "code"]].assign(label_words=label, other_words=other, described_words=described, said=said)

    kinds = dict(records.dtypes)
    schema = f"id {kinds['id']}, source {kinds['source']}, code {kinds['code']}, label_words array<string>, other_words array<string>, described_words array<string>, said string"
    return records.select("id", "source", "code", "label", "other", "described").mapInPandas(run, schema)


def _flush(kind: Counter, columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame([(*(k if isinstance(k, tuple) else (k,)), v) for k, v in kind.items()], columns=columns)


def _singles(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: Counter = Counter()
    for frame in frames:
        for ws, other in zip(frame["label_words"], frame["other_words"]):
            if ws is None:
                continue
            seen.update(("word", w) for w in set(ws) if w not in ("|", "."))
            if other is not None and len(other):
                a, b = phrases(ws), phrases(other)
                seen["told", ""] += 1
                seen.update(("label", p) for p in a - b)
                seen.update(("other", p) for p in b - a)
        if len(seen) > 300_000:
            yield _flush(seen, ["kind", "phrase", "n"])
            seen.clear()
    yield _flush(seen, ["kind", "phrase", "n"])


def _within(a: str, b: str) -> bool:
    """Whether the words of a run in b."""
    x, y = a.split(), b.split()
    return any(y[i : i + len(x)] == x for i in range(len(y) - len(x) + 1))


def _nested(a: str, b: str) -> bool:
    return _within(a, b) or _within(b, a)


def prune(links: dict[tuple[str, str], float], bonus: float = 1.1, firm: list[tuple[str, str]] | None = None) -> list[tuple[str, str]]:
    """The links that stay; a longer phrase is worth ``bonus`` for each word more.

    ``firm`` links stay whatever else is found; they come first, and no other link may hold a phrase of theirs and more.
    """
    kept: list[tuple[str, str]] = list(firm or [])
    fixed = frozenset(kept)
    ends = {x for k in kept for x in k}
    links = {k: w for k, w in links.items() if not any(x not in k and (_within(x, k[0]) or _within(x, k[1])) for x in ends)}
    for (p, q), _ in sorted(links.items(), key=lambda kv: (-kv[1] * bonus ** (len(kv[0][0].split()) + len(kv[0][1].split())), kv[0])):
        if not _nested(p, q) and not any((_nested(p, a) and _nested(q, b)) or (_nested(p, b) and _nested(q, a)) for a, b in kept):
            kept.append((p, q))
    while True:

        def explained(link: tuple[str, str]) -> bool:
            others = {x for k in kept if k != link for x in k}
            p, q = link
            return any(any(x != a and _within(x, a) for x in others) and any(_within(x, b) for x in others) for a, b in ((p, q), (q, p)))

        left = [k for k in kept if k in fixed or not explained(k)]
        if len(left) == len(kept):
            return kept
        kept = left


def spelled_alike(a: str, b: str, phrases_known: frozenset[str] | set[str] = frozenset()) -> bool:
    """Whether two phrases are one but for edits, blanks and hyphens, or one is a word and the other a piece of it that is written apart.

    All of these are matters for repair, not for a link.
    """
    x, y = (re.sub("[ -]", "", t) for t in (a, b))
    if x == y:
        return True
    short, long = sorted((x, y), key=len)
    if long.startswith(short) and f"{short} {long[len(short):]}" in phrases_known or long.endswith(short) and f"{long[:-len(short)]} {short}" in phrases_known:
        return True
    ws, vs = a.split(), b.split()
    return len(ws) == len(vs) and all(osa(w, v, min(reach(w), reach(v))) <= min(reach(w), reach(v)) for w, v in zip(ws, vs))


def special(link: tuple[str, str], seen: dict[tuple[str, str], int], times: float = 3.0) -> bool:
    """Whether parts of both ends are linked too, and ``times`` as often: the link is a case of that one."""
    parts = [[" ".join(ws[i:j]) for i in range(len(ws)) for j in range(i + 1, len(ws) + 1)] for ws in (end.split() for end in link)]
    return any((a, b) != link and seen.get((min(a, b), max(a, b)), 0) >= times * seen[link] for a in parts[0] for b in parts[1])


def coherent(phrase: str, n: dict[str, int], least: float = 0.2) -> bool:
    """Whether the parts of a phrase are seen together often against how often they are seen at all."""
    ws = phrase.split()
    return all(n[phrase] >= least * math.sqrt(n.get(" ".join(ws[:k]), 1) * n.get(" ".join(ws[k:]), 1)) for k in range(1, len(ws)))


def learn(records: DataFrame, support: int = 8, score: float = 0.2, lift: float = 2.0, mutual: float = 0.1) -> tuple[dict[str, str], set[str]]:
    """(phrase -> attribute, known words) from the texts of all ``tokenised`` records.

    Phrases need ``support`` records, whatever the number of all records.  A link needs ``score``, to be seen ``lift``
    times as often as by chance and in a share of ``mutual`` of the records of either end, and no more general link that
    is seen three times as often.  Links that stay above the score by two standard errors come first; the others need
    phrases whose parts belong together, and add what the first don't explain.
    """
    counts = records.select("label_words", "other_words").mapInPandas(_singles, "kind string, phrase string, n long").groupBy("kind", "phrase").agg(F.sum("n").alias("n"))
    counts = Scratch(records.sparkSession, "phrases").cut(counts.where((F.col("n") >= support) | (F.col("phrase") == "")))
    told, frequent = 0, {}
    alone: dict[str, dict[str, int]] = {"label": {}, "other": {}}
    for r in counts.toLocalIterator():
        if r["kind"] == "told":
            told = r["n"]
        elif r["kind"] == "word":
            frequent[r["phrase"]] = r["n"]
        else:
            alone[r["kind"]][r["phrase"]] = r["n"]
    sound = {kind: {p for p in seen if coherent(p, seen)} for kind, seen in alone.items()}
    # a name that labels never use could not tell two of them to be one
    left, right = frozenset(alone["label"]), frozenset(q for q in alone["other"] if all(w in frequent for w in q.split()))

    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for frame in frames:
            for label, other in zip(frame["label_words"], frame["other_words"]):
                if label is not None and other is not None:
                    a, b = phrases(label), phrases(other)
                    x, y = (a - b) & left, (b - a) & right
                    seen.update((p, q) for p in x for q in y)
            if len(seen) > 300_000:
                yield _flush(seen, ["p", "q", "n"])
                seen.clear()
        yield _flush(seen, ["p", "q", "n"])

    firm: dict[tuple[str, str], float] = {}
    rare: dict[tuple[str, str], float] = {}
    often: dict[tuple[str, str], int] = {}
    if left and right:
        met = records.select("label_words", "other_words").mapInPandas(pairs, "p string, q string, n long").groupBy("p", "q").agg(F.sum("n").alias("n")).where(F.col("n") >= support)
        sizes = counts.where("phrase <> ''")
        met = met.join(sizes.where("kind = 'label'").select(F.col("phrase").alias("p"), F.col("n").alias("np")), "p").join(sizes.where("kind = 'other'").select(F.col("phrase").alias("q"), F.col("n").alias("nq")), "q")
        met = met.withColumn("weight", F.col("n") / F.sqrt(F.col("np") * F.col("nq"))).where((F.col("weight") >= score) & (F.col("n") * F.lit(float(told)) >= lift * F.col("np") * F.col("nq")))
        met = met.where(F.col("n") >= mutual * F.greatest("np", "nq"))
        for r in met.toLocalIterator():
            key = (min(r["p"], r["q"]), max(r["p"], r["q"]))
            sure = r["weight"] * (1 - 2 / math.sqrt(r["n"])) >= score
            if spelled_alike(*key, left):
                continue
            if sure or (r["p"] in sound["label"] and r["q"] in sound["other"]):
                kind = firm if sure else rare
                kind[key] = max(kind.get(key, 0.0), r["weight"])
                often[key] = max(often.get(key, 0), r["n"])
    firm, rare = ({k: w for k, w in kind.items() if not special(k, often)} for kind in (firm, rare))
    parent: dict[str, str] = {}

    def top(x: str) -> str:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for p, q in prune({k: w for k, w in rare.items() if k not in firm}, firm=prune(firm)):
        a, b = sorted((top(p), top(q)))
        parent[b] = a
    return {p: top(p) for p in parent}, _sure(frequent)


def _sure(frequent: dict[str, int]) -> set[str]:
    """Frequent words without those that are misspellings, or pieces, of a far more frequent one."""
    index = defaultdict(set)
    for w in frequent:
        for d in deletions(w, reach(w)):
            index[d].add(w)

    def slip(w: str) -> bool:
        near = {o for d in deletions(w, reach(w)) for o in index[d]} - {w}
        return any(frequent[o] >= 8 * frequent[w] and osa(w, o, min(reach(w), reach(o))) <= min(reach(w), reach(o)) for o in near)

    pieces = set()
    for w, n in frequent.items():
        for k in range(1, len(w)):
            halves = {w[:k], w[k:]}
            if all(8 * frequent.get(h, n) <= n for h in halves):
                pieces |= halves
    return {w for w in frequent if w not in pieces and not slip(w)}


class Reader:
    """Turns texts into attributes."""

    def __init__(self, attribute: dict[str, str], frequent: set[str]):
        self.attribute = attribute
        self.parts = {w for p in attribute for w in p.split()}
        self.known = self.parts | frequent | JOINERS
        self.index: dict[str, set[str]] = defaultdict(set)
        for w in self.known:
            if len(w) > 3:
                for d in deletions(w, reach(w)):
                    self.index[d].add(w)
        self.memo: dict[str, str | None] = {}

    def repaired(self, word: str) -> str | None:
        """The one known word closest to a misspelled one."""
        if word not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            best, least, tie = None, 99, False
            for d in deletions(word, reach(word)):
                for v in self.index.get(d, ()):
                    most = min(reach(word), reach(v))
                    n = osa(word, v, most)
                    if n <= most and v != best:
                        if n < least:
                            best, least, tie = v, n, False
                        elif n == least:
                            tie = True
            self.memo[word] = None if tie else best
        return self.memo[word]

    def spelled(self, said: list[str]) -> list[str]:
        raw = [w for w in said if w not in ("|", ".")]
        out: list[str] = []
        i = 0
        while i < len(raw):
            w, after = raw[i], raw[i + 1] if i + 1 < len(raw) else ""
            if after and w + after in self.known:
                out.append(w + after)
                i += 1
            elif w in self.known:
                out.append(w)
            elif w.replace("-", "") in self.known:
                out.append(w.replace("-", ""))
            elif "-" in w and all(x in self.known for x in w.split("-")):
                out += w.split("-")
            elif fixed := self.repaired(w):
                out.append(fixed)
            elif after and after not in self.known and (fixed := self.repaired(w + after)):
                out.append(fixed)
                i += 1
            else:
                out.append(w)
            i += 1
        return out

    def read(self, said: list[str]) -> tuple[list[str], list[str]]:
        """(attributes in order, words left over)."""
        ws = self.spelled(said)
        found: list[str] = []
        left: list[str] = []
        i = 0
        while i < len(ws):
            for k in range(MOST_WORDS, 0, -1):
                p = " ".join(ws[i : i + k])
                if len(ws) - i >= k and p in self.attribute:
                    found.append(self.attribute[p])
                    i += k
                    break
            else:
                w = ws[i]
                if w not in JOINERS:
                    (left if w in self.parts or w not in self.known else found).append(w)
                i += 1
        return list(dict.fromkeys(found)), left


def whole(text: str | None) -> str:
    """All a text says, in one spelling: what a record without any attribute is known by."""
    said = canonical(text) or ""
    return " ".join(w for w in words(said) if w not in ("|", ".")) or " ".join(said.lower().split())


def attributes(records: DataFrame, reader: Reader) -> DataFrame:
    """(id, source, code, labelled, have, left): attributes and words left over, as one text, of ``tokenised`` records.

    ``have`` is sorted.  Records without a label get all attributes of their whole description, in the order they are
    named, and have no words left over.
    """
    kinds = dict(records.dtypes)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            have, left, labelled = [], [], []
            for label, described, said in zip(frame["label_words"], frame["described_words"], frame["said"]):
                labelled.append(label is not None)
                found, rest = reader.read(list(label if label is not None else described))
                have.append(sorted(found) if label is not None else found)
                rest = rest if label is not None else []
                left.append(" ".join(rest) if found or rest else said)
            yield frame[["id", "source", "code"]].assign(labelled=labelled, have=have, left=left)

    return records.mapInPandas(run, f"id {kinds['id']}, source {kinds['source']}, code {kinds['code']}, labelled boolean, have array<string>, left string")


def without_decoration(read: DataFrame, scratch: Scratch, least: float = 0.5, support: int = 8) -> DataFrame:
    """The records without words that decorate: of the labels that have one, a share of ``least`` is there without it too."""
    rest = F.filter(F.split("left", " "), lambda w: w != "")
    # labels with at most one word left over: only that word is judged there, and it is judged by labels without any
    labels = read.where("labelled").select("have", rest.alias("rest")).where("size(rest) < 2 and size(have) + size(rest) > 1").distinct()
    labels = scratch.cut(labels.withColumn("key", F.array_join(F.array_sort("have"), "|")))
    holes = labels.where("size(rest) = 0").select("have", F.explode("have").alias("x")).select("x", F.array_join(F.array_sort(F.array_remove("have", F.col("x"))), "|").alias("key"))
    holes = holes.unionByName(labels.where("size(rest) = 1").select(F.get("rest", F.lit(0)).alias("x"), "key"))
    there = labels.where("size(rest) = 0").select("key", F.lit(1).alias("there")).distinct()
    found = holes.join(there, "key", "left").groupBy("x").agg(F.avg(F.coalesce("there", F.lit(0))).alias("share"), F.count("*").alias("n"))
    loose = found.where((F.col("share") >= least) & (F.col("n") >= support)).agg(F.collect_set("x").alias("loose"))
    kept = read.crossJoin(F.broadcast(loose))  # one row, no longer than the list of known words
    bared = F.array_join(F.array_except(rest, "loose"), " ")
    return kept.withColumns({"have": F.array_except("have", "loose"), "left": F.when(F.col("labelled") & ((F.size("have") > 0) | (bared != "")), bared).otherwise(F.col("left"))}).drop("loose")


def _nearest(left: pd.Series, forms: pd.Series) -> pd.Series:
    """How alike the run of words most like one of the forms is to it: 1 for equal texts, falling with their edit distance."""

    def one(text: str, known) -> float:
        ws = text.split()
        best = 0.0
        for i in range(len(ws)):
            for j in range(i + 1, min(len(ws), i + MOST_WORDS) + 1):
                run = " ".join(ws[i:j])
                for form in known:
                    size = max(len(run), len(form))
                    if size and 1 - abs(len(run) - len(form)) / size > best:
                        best = max(best, 1 - osa(run, form, size) / size)
        return best

    return pd.Series([one(a, b) for a, b in zip(left, forms)])


def _rarity(attrs: str) -> F.Column:
    """Summed rarity of an array of attributes, by the map ``idf`` of the row."""
    return F.aggregate(attrs, F.lit(0.0), lambda t, x: t + F.coalesce(F.try_element_at("idf", x), F.lit(0.0)))


def candidates(classes: DataFrame, nodes: DataFrame, seen: DataFrame) -> DataFrame:
    """(class, left, node, missing, weight): the pruned candidate graph of classes with words left over and nodes.

    ``classes`` has class, have and left, ``nodes`` node and all, ``seen`` attribute and idf.  Both sides carry the rarity
    of their own attributes; an edge's weight is shared rarity over that of the union, words left over counting as much
    as what is missing.
    """
    def weighed(df: DataFrame, key: str, attrs: str) -> DataFrame:
        each = df.select(key, F.explode(attrs).alias("x")).join(seen, F.col("x") == F.col("attribute")).groupBy(key)
        return df.join(each.agg(F.map_from_entries(F.collect_list(F.struct("x", "idf"))).alias("idf"), F.array_sort(F.collect_list(F.struct(-F.col("idf"), "x"))).alias("rank")), key)

    pair = lambda a, b: F.concat_ws("|", F.least(a, b), F.greatest(a, b))
    rare = F.transform("rank", lambda r: r["x"])
    # a class of one attribute meets the nodes of two that have it
    key = F.when(F.size("rank") > 1, pair(F.get(rare, F.lit(0)), F.get(rare, F.lit(1)))).otherwise(F.get(rare, F.lit(0)))
    asked = weighed(classes, "class", "have").withColumn("key", key).select("class", "have", "left", "key")
    combos = F.flatten(F.transform("all", lambda x, i: F.transform(F.slice("all", i + 2, F.size("all")), lambda y: pair(x, y))))
    offered = weighed(nodes, "node", "all").withColumn("total", _rarity("all")).withColumn("key", F.explode(F.when(F.size("all") <= 2, F.concat(combos, "all")).otherwise(combos)))
    met = offered.join(asked, "key").where(F.size(F.array_except("have", "all")) == 0).select("class", "left", "node", "total", "idf", F.array_except("all", "have").alias("missing"))
    edges = met.withColumn("weight", 1 - _rarity("missing") / F.col("total")).drop("idf")
    # every missing attribute must stand against words of its own
    edges = edges.where((F.size("missing") > 0) & (F.size("missing") <= F.size(F.split("left", " "))))
    top = edges.groupBy("class").agg(F.max("weight").alias("top"))
    return edges.join(top, "class").where(F.col("weight") >= F.col("top") / 2).drop("top", "total")


def propagate(edges: DataFrame, forms: DataFrame, seen: DataFrame, scratch: Scratch, near: float, enough: float, several: int = 4, agreed: float = 0.9) -> DataFrame:
    """(class, node, similarity) of the classes that go to a node: similarities of neighbours are passed on until nothing changes."""
    alike = F.pandas_udf(_nearest, "double")
    spelled = forms.groupBy("attribute").agg(F.collect_set("form").alias("forms"))
    stands = edges.select("left", F.explode("missing").alias("attribute")).distinct().join(spelled, "attribute", "left")
    stands = scratch.cut(stands.withColumn("alike", alike("left", F.coalesce("forms", F.array("attribute")))).select("left", "attribute", "alike"))
    each = edges.select("class", "left", "node", "weight", F.size("missing").alias("gaps"), F.explode("missing").alias("attribute")).join(seen, "attribute")
    open_edges, found = scratch.cut(each), None
    while True:
        # how many classes with these words left over could lack nothing but this attribute
        classes = open_edges.where("gaps = 1").groupBy("left").agg(F.count_distinct("class").alias("all"))
        lacking = open_edges.where("gaps = 1").groupBy("left", "attribute").agg(F.count_distinct("class").alias("n")).join(classes, "left")
        best = lacking.groupBy("left").agg(F.max_by("attribute", "n").alias("attribute"), F.max("n").alias("n"), F.max("all").alias("all"), F.count_if(F.col("n") >= agreed * F.col("all")).alias("rivals"))
        told = best.where((F.col("all") >= several) & (F.col("n") >= agreed * F.col("all")) & (F.col("rivals") == 1)).select("left", "attribute", (F.lit(near) * F.col("n") / F.col("all")).alias("told"))
        judged = open_edges.join(stands, ["left", "attribute"]).join(told, ["left", "attribute"], "left").withColumn("like", F.greatest("alike", F.coalesce("told", F.lit(0.0))))
        fill = F.sum(F.col("like") * F.col("idf")) / F.sum("idf")  # how much of what is missing is there after all
        sims = judged.groupBy("class", "node").agg((F.first("weight") + (1 - F.first("weight")) * fill).alias("similarity"), F.min("like").alias("least"))
        sure = sims.where((F.col("similarity") >= enough) & (F.col("least") >= near * agreed))
        new = scratch.cut(sure.groupBy("class").agg(F.max_by(F.struct("node", "similarity"), F.struct("similarity", "node")).alias("b")).select("class", "b.node", "b.similarity"))
        if new.isEmpty():
            return new if found is None else found
        found = new if found is None else found.unionByName(new)
        rest = scratch.cut(open_edges.join(new.select("class"), "class", "left_anti"))
        scratch.drop(open_edges)
        open_edges = rest


def named(described: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, node): of the nodes whose attributes are all in ``have``, the one with most of them.

    Of several, the one whose attributes are named first, then the one with the rarest.
    Nodes are met by their two rarest attributes together.  Where another attribute of a record goes with each of the
    node's, the record is about something narrower than the node and has none.  Where an earlier named one goes with all
    of them but one, it takes the place of that one.
    """
    parts = nodes.select("node", F.split("node", "\\|").alias("all"))
    each = parts.select("node", "all", F.explode("all").alias("x"))
    seen = each.groupBy("x").agg(F.count("*").alias("n"))
    ranked = each.join(seen, "x").groupBy("node", "all").agg(F.slice(F.array_sort(F.collect_list(F.struct("n", "x"))), 1, 2).alias("two"), F.sum(-F.log("n")).alias("rarity"), F.count("*").alias("size"))
    keyed = ranked.crossJoin(nodes.agg(F.log(F.count("*") + 1.0).alias("most"))).select("node", "all", (F.col("rarity") + F.col("size") * F.col("most")).alias("weight"), F.array_join(F.array_sort(F.transform("two", lambda t: t["x"])), "|").alias("key"))
    pairs = F.expr("flatten(transform(have, (x, i) -> transform(slice(have, i + 2, size(have)), y -> array_join(array_sort(array(x, y)), '|'))))")
    late = F.aggregate("all", F.lit(0).cast("long"), lambda at, x: at + F.array_position("have", x))
    met = described.select("id", "have", F.explode(F.concat("have", pairs)).alias("key")).join(keyed, "key").where(F.size(F.array_except("all", "have")) == 0)
    best = Scratch(nodes.sparkSession, "named").cut(met.groupBy("id", "have").agg(F.max_by(F.struct("node", "all"), F.struct(F.size("all"), -late, "weight", "node")).alias("b")).select("id", "b.node", "b.all", "have", F.array_except("have", "b.all").alias("more")))
    together = each.select("x", F.explode("all").alias("other")).distinct()
    goes = best.select("id", "all", "have", F.explode("more").alias("other")).select("*", F.explode("all").alias("x")).join(together, ["x", "other"]).groupBy("id", "all", "have", "other").agg(F.collect_set("x").alias("with"))
    narrower = goes.where(F.size("with") == F.size("all")).select("id").distinct()
    # an attribute named before one of the node's that it never goes with stands in its place
    swap = goes.where(F.size("with") == F.size("all") - 1).withColumn("out", F.get(F.array_except("all", "with"), F.lit(0))).where(F.array_position("have", F.col("other")) < F.array_position("have", F.col("out")))
    swap = swap.groupBy("id").agg(F.min_by(F.array_join(F.array_sort(F.concat("with", F.array("other"))), "|"), F.struct(F.array_position("have", F.col("other")), "out")).alias("own"))
    return best.join(narrower, "id", "left_anti").join(swap, "id", "left").select("id", F.coalesce("own", "node").alias("node"))


def link(records: DataFrame, near: float = 0.7, enough: float = 0.85, support: int = 8) -> DataFrame:
    """(id, source, code, node, closeness, rarity): what every record describes; records of one ``node`` describe the same.

    ``records`` has id, source, label, described (its description), other (all its other text) and code.  ``closeness``
    is the similarity of a record to its node, ``rarity`` one over one plus the number of records that would have all
    attributes of the node by chance.
    """
    spark = records.sparkSession
    scratch = Scratch(spark, "entities")
    told = records.select("id", "source", "label", "described", "other", "code").where("id is not null and source is not null")
    told = told.withColumns({c: F.when(bare(c) != "", F.col(c)) for c in ("label", "described")})
    once = scratch.cut(tokenised(spread(told.dropDuplicates(["id"]))))
    attribute, frequent = learn(once, support)
    reader = Reader(attribute, frequent)
    raw = scratch.cut(attributes(once.where("label_words is not null or described_words is not null"), reader))
    read = scratch.cut(without_decoration(raw, scratch, support=support).where("size(have) > 0 or left <> ''"))
    labelled = read.where("labelled")
    whole_ones = labelled.where("left = ''").select("id", "source", "code", F.array_join("have", "|").alias("node"), F.lit(1.0).alias("closeness"))
    nodes = scratch.cut(whole_ones.select("node").distinct().withColumn("all", F.split("node", "\\|")))
    total = labelled.agg(F.count("*").alias("total"))
    seen = labelled.select(F.explode("have").alias("attribute")).groupBy("attribute").agg(F.count("*").alias("n")).crossJoin(total)  # one row
    seen = scratch.cut(seen.select("attribute", F.log(1 + F.col("total") / F.col("n")).alias("idf"), "n", "total"))
    astray = labelled.where("left <> '' and size(have) > 0").withColumn("class", F.concat_ws("~", F.array_join("have", "|"), "left"))
    classes = astray.groupBy("class").agg(F.first("have").alias("have"), F.first("left").alias("left"))
    forms = spark.createDataFrame([(a, p) for p, a in attribute.items()] or [("", "")], "attribute string, form string")
    edges = scratch.cut(candidates(classes, nodes, seen.select("attribute", "idf")))
    placed = propagate(edges, forms, seen.select("attribute", "idf"), scratch, near, enough)
    drawn = astray.join(placed, "class").select("id", "source", "code", "node", F.round("similarity", 4).alias("closeness"))
    about = read.where("not labelled and size(have) > 0")
    chosen = about.join(named(about, nodes.select("node")), "id", "left").select("id", "source", "code", F.coalesce("node", F.array_join(F.array_sort("have"), "|")).alias("node"), F.lit(1.0).alias("closeness"))
    lost = astray.join(placed.select("class"), "class", "left_anti").select("id", "source", "code", "have", "left")
    lost = lost.unionByName(read.where("left <> '' and size(have) = 0").select(*lost.columns))
    said = F.concat(F.lit("~"), F.array_join(F.array_sort(F.array_distinct(F.split("left", " "))), " "))
    lone = lost.select("id", "source", "code", F.concat_ws("|", F.when(F.size("have") > 0, F.array_join("have", "|")), said).alias("node"), F.lit(1.0).alias("closeness"))
    found = scratch.cut(whole_ones.unionByName(drawn).unionByName(chosen).unionByName(lone))
    chance = found.select("node").distinct().select("node", F.explode(F.split("node", "\\|")).alias("attribute")).join(seen, "attribute", "left")
    chance = chance.groupBy("node").agg((F.coalesce(F.max("total"), F.lit(0)) * F.exp(F.sum(F.coalesce(F.log(F.col("n") / F.col("total")), F.lit(-20.0))))).alias("by_chance"))
    return found.join(chance, "node").select("id", "source", "code", "node", "closeness", F.round(1 / (1 + F.col("by_chance")), 4).alias("rarity"))


def classes_of(linked: DataFrame) -> DataFrame:
    """(entity_id, class_id, links): one row per record with the smallest id of its class and the number of records of other sources in it."""
    sizes = linked.groupBy("node").agg(F.min("id").alias("class_id"), F.count("*").alias("all"))
    own = linked.groupBy("node", "source").agg(F.count("*").alias("own"))
    return linked.join(sizes, "node").join(own, ["node", "source"]).select(F.col("id").alias("entity_id"), "class_id", (F.col("all") - F.col("own")).alias("links"))


def matched_pairs(linked: DataFrame) -> DataFrame:
    """(entity_id_a, entity_id_b, confidence): records of different sources at one node, smaller id first.

    The confidence is the closeness of both records to the node times the node's rarity, a little less where their codes,
    shortened to three digits, disagree.
    """
    digits = F.substring(F.regexp_replace(F.coalesce("code", F.lit("")), "[^0-9]", ""), 1, 3)
    rows = linked.withColumn("code", digits)
    a, b = rows.alias("a"), rows.alias("b")
    met = a.join(b, (F.col("a.node") == F.col("b.node")) & (F.col("a.id") < F.col("b.id")) & (F.col("a.source") != F.col("b.source")))
    known = (F.length("a.code") == 3) & (F.length("b.code") == 3)
    agree = F.when(~known, 0.95).when(F.col("a.code") == F.col("b.code"), 1.0).otherwise(0.9)
    return met.select(F.col("a.id").alias("entity_id_a"), F.col("b.id").alias("entity_id_b"), F.round(F.col("a.closeness") * F.col("b.closeness") * F.col("a.rarity") * agree, 4).alias("confidence"))
