"""Shapes in which taxonomies come, turned into entities and relations.

Each function is one shape: levels in columns, scoped concepts with descriptions, rated elements in several files, texts
in positions, codes with a map, predicates in triples, category paths, spellings of one skill.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoloom.functions.text import match_key, normalize_label, spelling_key, to_float
from taxoloom.operators.lookup import first_by


def levels(rows: DataFrame, pairs: list[tuple[str, str]], scope: Column | None = None, order: str | None = None, definitions: DataFrame | None = None) -> DataFrame:
    """(code, label, level, description): codes and labels of several levels in columns, the first label of a code stays.

    ``definitions`` (code, title, definition) overrides labels.
    """
    parts = F.array(*[F.struct(F.lit(n).alias("level"), F.col(c).cast("string").alias("code"), F.col(lab).alias("label")) for n, (c, lab) in enumerate(pairs, 1)])
    o = F.col(order) if order else F.lit(0)
    long = rows.select(o.alias("o"), F.inline(parts)).where("coalesce(code, '') <> ''")
    if scope is not None:
        long = long.where(scope)
    first = long.groupBy("code").agg(F.min_by(F.struct("label", "level"), F.struct("o", "label")).alias("x")).select("code", "x.label", "x.level")
    if definitions is None:
        return first.withColumn("description", F.lit(""))
    d = definitions.groupBy(F.col("code").cast("string").alias("code")).agg(F.min("title").alias("title"), F.min("definition").alias("definition"))
    return first.join(d, "code", "left").select("code", F.coalesce(F.nullif(F.trim("title"), F.lit("")), "label").alias("label"), "level", F.coalesce("definition", F.lit("")).alias("description"))


def scoped(concepts: DataFrame, code: str, prefixes: tuple[str, ...]) -> DataFrame:
    """Concepts whose code starts with one of the prefixes."""
    test = reduce(lambda a, b: a | b, [F.col(code).startswith(p) for p in prefixes])
    return concepts.where(test)


def needed_skills(relations: DataFrame, occupations: DataFrame, master: DataFrame, collections: DataFrame, occ: str, skill: str) -> DataFrame:
    """Skills linked to the occupations at hand or in a collection; the master's record goes before the collection's."""
    linked = relations.join(occupations.select(occ).distinct(), occ, "left_semi").select(skill)
    wanted = linked.unionByName(collections.select(skill)).distinct()
    both = master.withColumn("_o", F.lit(0)).unionByName(collections.withColumn("_o", F.lit(1)), allowMissingColumns=True)
    return first_by(both.join(wanted, skill, "left_semi"), [skill], [F.col("_o")]).drop("_o")


def rated(rows: DataFrame, scale: str, value: str, wanted: str, least: float) -> DataFrame:
    """Rows of one scale whose rating is at least ``least``; unreadable ratings are none."""
    return rows.where((F.col(scale) == wanted) & (to_float(value) >= least))


def pooled_skills(files: list[tuple[DataFrame, str, str]]) -> tuple[DataFrame, DataFrame]:
    """(skills, relations) of several files (rows, occupation, label): one skill a folded label, from the first file.

    Every occurrence is a relation.
    """
    every = None
    for n, (rows, occ, label) in enumerate(files):
        part = rows.select(F.lit(n).alias("file"), F.col(occ).cast("string").alias("occupation"), F.col(label).alias("label")).withColumn("norm", normalize_label("label")).where("norm <> ''")
        every = part if every is None else every.unionByName(part)
    skills = every.groupBy("norm").agg(F.min_by("label", F.struct("file", "label")).alias("label"), F.min("file").alias("file"))
    return skills, every.select("occupation", "norm", "file")


def texts_in_order(rows: DataFrame, keys: list[str], text: str, position: str, sep: str = " ") -> DataFrame:
    """(keys, text): texts of a key joined in the numeric order of their positions."""
    parts = rows.where(F.trim(F.coalesce(F.col(text), F.lit(""))) != "").select(*keys, to_float(F.col(position).cast("string")).alias("_p"), F.trim(text).alias("_t"))
    return parts.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_p", "_t"))), lambda x: x["_t"]), sep).alias("text"))


def mapped_codes(rows: DataFrame, code: str, table: dict[str, str], out: str, status: Column | None = None) -> DataFrame:
    """Rows whose code is in a map, with its value; ``status`` leaves rows out."""
    values = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    kept = rows if status is None else rows.where(status)
    return kept.withColumn(out, F.try_element_at(values, F.col(code))).where(F.col(out).isNotNull())


def routed(rows: DataFrame, route: str, tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Rows with the label of the table their route names."""
    out = rows
    label = None
    for name, table in tables.items():
        out = out.join(table.groupBy(key).agg(F.min("label").alias(f"_{name}")), key, "left")
        pick = F.when(F.col(route) == name, F.col(f"_{name}"))
        label = pick if label is None else F.coalesce(label, pick)
    return out.withColumn("label", label).drop(*[f"_{n}" for n in tables]).where("label is not null")


def predicates(triples: DataFrame, label: str, broader: str, same: str, related: str) -> dict[str, DataFrame]:
    """Triples (s, p, o) by predicate: labels, parent links, canonical ids, and related pairs both ways."""
    pick = lambda p: triples.where(F.col("p") == p)
    near = pick(related).select(F.col("s").alias("a"), F.col("o").alias("b"))
    return {
        "labels": first_by(pick(label).select("s", F.col("o").alias("label")), ["s"], [F.col("label")]),
        "edges": pick(broader).select(F.col("s").alias("u"), F.col("o").alias("v")).distinct(),
        "canonical": pick(same).groupBy("s").agg(F.min("o").alias("canonical")),
        "related": near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
    }


def first_path(rows: DataFrame, paths: str, root: str) -> DataFrame:
    """Rows with ``path``: the first of the paths, given as a list literal, that opens with ``root``."""
    parsed = F.from_json(F.col(paths), "array<array<string>>", {"allowSingleQuotes": "true"})
    return rows.withColumn("path", F.get(F.filter(parsed, lambda p: F.get(p, F.lit(0)) == root), F.lit(0))).where("path is not null")


def spellings(files: list[tuple[DataFrame, str]], drop: tuple[str, ...] = ()) -> DataFrame:
    """(key, label, alts): one skill for all its spellings, named by the first, with the others beside it."""
    every = None
    for n, (rows, label) in enumerate(files):
        part = rows.select(F.lit(n).alias("file"), F.trim(label).alias("label")).where("label <> ''")
        every = part if every is None else every.unionByName(part)
    for word in drop:
        every = every.where(~F.lower("label").contains(word))
    every = every.withColumn("key", spelling_key("label")).where("key <> ''")
    return every.groupBy("key").agg(F.min_by("label", F.struct("file", "label")).alias("label"), F.array_sort(F.collect_set("label")).alias("alts")).withColumn("alts", F.array_remove("alts", F.col("label")))


def harvested(tokens: DataFrame, prefix: str, source: str, floor: int, index: DataFrame) -> DataFrame:
    """(token, entity): ids for tokens in enough documents that no label has."""
    from taxoloom.functions.text import mint_id
    from taxoloom.operators.demand import frequent_absent

    fresh = frequent_absent(tokens, "doc", "token", index, floor, match_key("token"))
    return fresh.select("token", mint_id(prefix, F.lit(source), "token").alias("entity"))
