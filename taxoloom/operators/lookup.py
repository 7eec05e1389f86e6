"""Look-ups by label and code: dictionary joins, ordered probes, n-gram matches, referential pruning.

A dictionary is one row per key.  Its joins carry no hint: where a dictionary is small the planner broadcasts it, where
it isn't both sides are shuffled on the key.  Texts are read against a dictionary of phrases where they are, so their
runs of words are never shuffled, unless the dictionary is too large for every worker to hold.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoloom.session import Scratch, spread
from taxoloom.functions.text import TECH_TOKEN, let, match_key, ngrams_to, tech_tokens

# Up to so many phrases and bytes of keys and entities, a dictionary is sent to every worker.
MAX_PHRASES, MAX_BYTES = 1_000_000, 32_000_000


def first_by(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key: a combinable aggregate over a struct, so no key's rows meet in one task unreduced."""
    value = F.struct(*[F.col(c) for c in rows.columns])
    ranked = rows.groupBy(*keys).agg(F.min_by(value, F.struct(*order)).alias("_first"))
    return ranked.select("_first.*")


def label_index(rows: DataFrame, entity: str, order: str, fields: list[Column], key=match_key) -> DataFrame:
    """(key, entity): each field's labels in turn; the first row, then the first field, wins a key."""
    def ranked(labels: Column, n: int) -> Column:
        return F.transform(labels, lambda x: F.struct(F.lit(n).alias("f"), x.alias("label")))

    parts = [ranked(f, n) for n, f in enumerate(fields)]
    long = rows.select(F.col(entity).alias("entity"), F.col(order).alias("o"), F.explode(F.concat(*parts)).alias("x"))
    keyed = long.select("entity", "o", "x.f", key("x.label").alias("key")).where("key <> ''")
    return keyed.groupBy("key").agg(F.min_by("entity", F.struct("o", "f", "entity")).alias("entity"))


def key_join(rows: DataFrame, label: str, index: DataFrame, key=match_key) -> DataFrame:
    """The rows whose label is in the index, with its entity."""
    return rows.withColumn("key", key(label)).join(index, "key").drop("key")


def variants(label: str, prefixes: tuple[str, ...] = (), suffixes: tuple[str, ...] = ()) -> Column:
    """Keys under which a label may be listed: its own, each parenthesis, without vendor words in front or behind."""
    base = match_key(label)
    inner = F.transform(F.regexp_extract_all(F.coalesce(F.col(label), F.lit("")), F.lit("\\(([^)]*)\\)"), 1), lambda x: match_key(x))
    forms = [F.array(base), inner]
    for words, pattern in ((prefixes, "^(({})\\s+)+"), (suffixes, "(\\s+({}))+$")):
        if words:
            forms.append(F.array(F.regexp_replace(base, pattern.format("|".join(words)), "")))
    return F.filter(F.array_distinct(F.concat(*forms)), lambda k: k != "")


def variant_index(rows: DataFrame, entity: str, order: str, label: str, prefixes: tuple[str, ...], suffixes: tuple[str, ...]) -> DataFrame:
    long = rows.select(F.col(entity).alias("entity"), F.col(order).alias("o"), F.posexplode(variants(label, prefixes, suffixes)).alias("p", "key"))
    return long.groupBy("key").agg(F.min_by("entity", F.struct("o", "p", "entity")).alias("entity"))


def first_probe(rows: DataFrame, owner: str, probes: str, index: DataFrame) -> DataFrame:
    """(owner, probe, entity) of the first phrase in an ordered list that is in the index."""
    tried = rows.select(F.col(owner).alias("owner"), F.posexplode(probes).alias("p", "probe")).withColumn("key", match_key("probe"))
    hit = tried.join(index, "key")
    return hit.groupBy("owner").agg(F.min_by(F.struct("probe", "entity"), "p").alias("x")).select("owner", "x.probe", "x.entity")


def pattern_or_key(title: Column, patterns: tuple[tuple[str, str], ...], fallback: Column) -> Column:
    """The role of the first pattern a title holds, else the looked-up one."""
    picked = None
    for role, pattern in patterns:
        hit = title.rlike("(?iu)" + pattern)
        picked = F.when(hit, role) if picked is None else picked.when(hit, role)
    return F.coalesce(picked, fallback)


def dictionary_hits(docs: DataFrame, doc_id: str, text: str, phrases: DataFrame, most: int = 4) -> DataFrame:
    """(doc_id, entity): every dictionary phrase of up to ``most`` words in each text, once an id."""
    held, kept = _held(phrases)
    if held is None:
        grams = spread(docs.select(doc_id, text)).select(doc_id, F.explode(F.array_distinct(ngrams_to(tech_tokens(text), most))).alias("key"))
        return grams.hint("merge").join(kept, "key").select(doc_id, "entity").distinct()  # else the planner may take the runs for small and broadcast them

    def every(words: list[str], tree: dict[str, tuple[int, ...]]) -> set[int]:
        return {e for _, _, entities in _places(words, tree, most) for e in entities}

    kinds = f"`{doc_id}` {dict(docs.dtypes)[doc_id]}, entity {dict(phrases.dtypes)['entity']}"
    return _once(_read(docs, doc_id, text, held, kinds, most, every), docs, doc_id)


def _held(phrases: DataFrame) -> tuple[pa.Table | None, DataFrame | None]:
    """The rows of a dictionary that every worker can hold, else the dictionary as a table."""
    scratch = Scratch(phrases.sparkSession, "phrases")
    kept = scratch.cut(phrases.select("key", "entity").where("key is not null"))
    size = F.octet_length("key") + F.coalesce(F.octet_length(F.col("entity").cast("string")), F.lit(0))
    n, size = kept.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    if n > MAX_PHRASES or size > MAX_BYTES:
        return None, kept
    held = kept.toArrow()
    scratch.drop(kept)
    return held, None


def _once(found: DataFrame, docs: DataFrame, doc_id: str) -> DataFrame:
    """Each row once. A text gives an entity once, so rows are compared only if an id has several texts."""
    return found if docs.groupBy(doc_id).agg(F.count("*").alias("n")).where("n > 1").isEmpty() else found.distinct()


_TREES: dict[str, tuple[dict[str, tuple[int, ...]], pa.Array]] = {}


def _tree(name: str, held: pa.Table, most: int, deny: tuple[str, ...]) -> tuple[dict[str, tuple[int, ...]], pa.Array]:
    """The entities of each phrase, as places in the sorted array of all, none for what only begins one. A worker keeps it from task to task."""
    if name not in _TREES:
        _TREES.clear()
        every = pc.unique(held["entity"])
        every = every.take(pc.array_sort_indices(every, null_placement="at_start"))
        tree: dict[str, tuple[int, ...]] = {}
        for key, at in zip(held["key"].to_pylist(), pc.index_in(held["entity"], every).to_pylist()):
            words = key.split(" ")
            if len(words) <= most and not (len(words) == 1 and key in deny):
                for n in range(1, len(words)):
                    tree.setdefault(" ".join(words[:n]), ())
                tree[key] = tuple(sorted({*tree.get(key, ()), at}))
        _TREES[name] = tree, every
    return _TREES[name]


def _places(words: list[str], tree: dict[str, tuple[int, ...]], most: int) -> Iterator[tuple[int, int, tuple[int, ...]]]:
    """(place, number of words, entities) of every phrase in a text."""
    get, end = tree.get, len(words)
    for i, key in enumerate(words):
        n = 1
        while (entities := get(key)) is not None:
            if entities:
                yield i, n, entities
            if n == most or i + n == end:
                break
            key = f"{key} {words[i + n]}"
            n += 1


def _read(docs: DataFrame, doc_id: str, text: str, held: pa.Table, kinds: str, most: int, pick: Callable, deny: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, entity): what ``pick`` finds in the words of each text."""
    name, sent, batch_rows = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(held), 500_000

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, every = _tree(name, sent.value, most, deny)
        words = re.compile(TECH_TOKEN).findall
        for batch in batches:
            at, entities = [], []
            for row, t in enumerate(batch.column(1)):
                got = pick(words(t.as_py()), tree)
                at += [row] * len(got)
                entities += got
                if entities and (len(entities) > batch_rows or row == batch.num_rows - 1):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), every.take(pa.array(entities, pa.int32()))], [doc_id, "entity"])
                    at, entities = [], []

    return spread(docs.select(doc_id, text)).select(doc_id, F.lower(F.coalesce(text, F.lit(""))).alias("_text")).mapInArrow(found, kinds)


def longest_hits(docs: DataFrame, doc_id: str, text: str, phrases: DataFrame, most: int = 3, deny: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, entity): longest phrases first, left to right, no word of a text used twice; once an id.

    Which places of phrases stand depends on those before, so it is decided text by text. Where the dictionary is too
    large for every worker, a join finds the places and only these are read in Arrow batches.
    """
    kinds = f"`{doc_id}` {dict(docs.dtypes)[doc_id]}, entity {dict(phrases.dtypes)['entity']}"
    held, kept = _held(phrases)
    if held is None:
        return _covered(docs, doc_id, text, kept, kinds, most, deny)

    def longest(words: list[str], tree: dict[str, tuple[int, ...]]) -> set[int]:
        found, used = set(), bytearray(len(words))
        for i, n, entities in sorted(_places(words, tree, most), key=lambda p: -p[1]):  # stable: left to right
            if used.find(1, i, i + n) < 0:
                used[i : i + n] = b"\1" * n
                found.add(entities[0])
        return found

    return _once(_read(docs, doc_id, text, held, kinds, most, longest, deny), docs, doc_id)


def _covered(docs: DataFrame, doc_id: str, text: str, phrases: DataFrame, kinds: str, most: int, deny: tuple[str, ...]) -> DataFrame:
    """``longest_hits`` by a join of all runs of words with the dictionary."""
    def runs(ts: Column, n: int) -> Column:
        heads = F.slice(ts, F.lit(1), F.greatest(F.size(ts) - (n - 1), F.lit(0)))
        return F.transform(heads, lambda w, i: F.struct((i + 1).alias("at"), F.lit(n).alias("n"), F.concat_ws(" ", w, *[F.get(ts, i + k) for k in range(1, n)]).alias("key")))

    every = let(tech_tokens(text), lambda ts: F.concat(*[runs(ts, n) for n in range(most, 0, -1)]))
    places = spread(docs.select(doc_id, text)).select(doc_id, F.xxhash64(text).alias("_text"), F.explode(every).alias("x")).select(doc_id, "_text", "x.*")
    cand = places.hint("merge").join(phrases, "key")
    if deny:
        cand = cand.where((F.col("n") > 1) | ~F.col("key").isin(*deny))
    per_text = cand.groupBy(doc_id, "_text").agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("order"), "at", "n", "entity"))).alias("c"))

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, found = [], []
            for row, cs in enumerate(batch.column(1)):
                used, got = set(), {}
                for c in cs.as_py():
                    span = range(c["at"], c["at"] + c["n"])
                    if used.isdisjoint(span):
                        used.update(span)
                        got[c["entity"]] = None
                at += [row] * len(got)
                found += got
            kind = batch.schema.field(1).type.value_type.field("entity").type
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), pa.array(found, kind)], [doc_id, "entity"])

    return per_text.drop("_text").mapInArrow(cover, kinds).distinct()


def star_edges(rows: DataFrame, entity: str, keys: list[str], order: str) -> DataFrame:
    """(a, b): in every group of two or more with one key, the first entity with each of the others."""
    anchor = rows.groupBy(*keys).agg(F.min_by(entity, F.struct(order, entity)).alias("a"), F.count("*").alias("n")).where("n > 1")
    return rows.join(anchor, keys).where(F.col(entity) != F.col("a")).select("a", F.col(entity).alias("b"), *keys)


def attach_all(core: DataFrame, targets: DataFrame, most: int = 100_000) -> DataFrame:
    """Every core row with every target: a product by definition, for a core list whose size is checked."""
    few = core.limit(most + 1)
    if few.count() > most:
        raise ValueError(f"a transversal list has at most {most} rows")
    return targets.crossJoin(F.broadcast(core))


def keep_referring(rows: DataFrame, references: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows of which every reference exists."""
    for column, (table, key) in references.items():
        rows = rows.join(table.select(F.col(key).alias(column)).distinct(), column, "left_semi")
    return rows


def dangling(rows: DataFrame, references: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(row columns, missing): rows with a reference that doesn't exist, once per such reference."""
    out = None
    for column, (table, key) in references.items():
        part = rows.join(table.select(F.col(key).alias(column)).distinct(), column, "left_anti").select(*rows.columns).withColumn("missing", F.lit(column))
        out = part if out is None else out.unionByName(part)
    return out


def refill(rows: DataFrame, key: str, column: str, earlier: DataFrame) -> DataFrame:
    """Blank values of a column from an earlier state of the table."""
    old = earlier.where(F.trim(F.coalesce(F.col(column), F.lit(""))) != "").groupBy(key).agg(F.min(column).alias("_old"))
    joined = rows.join(old, key, "left")
    return joined.withColumn(column, F.coalesce(F.nullif(F.trim(F.coalesce(F.col(column), F.lit(""))), F.lit("")), F.col("_old"))).drop("_old")


def not_covered(rows: DataFrame, label: str, index: DataFrame) -> DataFrame:
    """Rows whose label no other source has."""
    return rows.withColumn("key", match_key(label)).join(index.select("key"), "key", "left_anti").drop("key")


def resolve_or_harvest(tokens: DataFrame, token: str, index: DataFrame, harvested: DataFrame) -> DataFrame:
    """Each token's entity: by its key in the index, else the id harvested for the token itself."""
    known = index.select(F.col("key"), F.col("entity").alias("_known"))
    fresh = harvested.select(F.col("token").alias(token), F.col("entity").alias("_fresh"))
    out = tokens.withColumn("key", match_key(token)).join(known, "key", "left").join(fresh, token, "left")
    return out.withColumn("entity", F.coalesce("_known", "_fresh")).drop("_known", "_fresh", "key")


def label_rows(rows: DataFrame, entity: str, source: str, fields: dict[tuple[str, str], Column]) -> DataFrame:
    """Long labels: (entity, label, label_norm, label_type, language, source); the first of equal folded labels stays.

    ``fields`` maps (type, language) to an array of labels.
    """
    from taxoloom.functions.text import normalize_label

    def typed(labels: Column, kind: str, language: str) -> Column:
        return F.transform(labels, lambda x: F.struct(F.trim(x).alias("label"), F.lit(kind).alias("label_type"), F.lit(language).alias("language")))

    parts = [typed(a, t, g) for (t, g), a in fields.items()]
    long = rows.select(F.col(entity).alias("entity_id"), F.col(source).alias("source"), F.posexplode(F.concat(*parts)).alias("at", "x")).select("entity_id", "source", "at", "x.*").where("label <> ''")
    long = long.withColumn("label_norm", normalize_label("label")).where("label_norm <> ''")
    return first_by(long, ["entity_id", "source", "label_norm", "label_type", "language"], [F.col("at")]).drop("at")
