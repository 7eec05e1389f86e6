"""Sources as plug-ins: what they are, what they give, in which order they are read.

Order matters: a later source resolves its labels against the earlier ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxoloom.functions.text import is_noise, mint_id, split_multi, status_of_languages
from taxoloom.operators import lookup, tables


@dataclass(frozen=True)
class Source:
    """A source's name and how its rows are treated."""

    name: str
    contributes_occupations: bool = False
    needs_attach: bool = False
    builtin: bool = True
    screened: bool = False


@dataclass(frozen=True)
class StructuredSource(Source):
    """A source that gives records: functions from a session to frames of source_id, labels, descriptions."""

    occupations: Callable[[SparkSession], DataFrame] | None = None
    skills: Callable[[SparkSession], DataFrame] | None = None
    relations: Callable[[SparkSession], DataFrame] | None = None

    def entities(self, spark: SparkSession, kind: str) -> DataFrame | None:
        """The records with ids and language status; of screened sources without malformed labels."""
        make = getattr(self, kind)
        if make is None:
            return None
        rows = make(spark)
        out = rows.withColumns({"source": F.lit(self.name), "entity_id": mint_id("OCC_" if kind == "occupations" else "SKL_", F.lit(self.name), "source_id"), "label_language_status": status_of_languages("pref_label_en", "pref_label_fr")})
        return out.where(~is_noise("pref_label_en") | (F.trim(F.coalesce("pref_label_fr", F.lit(""))) != "")) if self.screened else out

    def blocked(self, spark: SparkSession, kind: str) -> DataFrame | None:
        """What the screen keeps out, with the reason."""
        make = getattr(self, kind)
        if make is None or not self.screened:
            return None
        bad = is_noise("pref_label_en") & (F.trim(F.coalesce("pref_label_fr", F.lit(""))) == "")
        return make(spark).where(bad).select(F.lit(self.name).alias("source"), "source_id", F.lit("malformed").alias("reason"))


@dataclass(frozen=True)
class ExtractionSource(Source):
    """A source that reads texts: ``extract`` gives any number of (kind, label) for one text, in Arrow batches."""

    documents: Callable[[SparkSession], DataFrame] | None = None
    extract: Callable[[str], list[tuple[str, str]]] | None = None

    def mentions(self, spark: SparkSession) -> DataFrame:
        rows = self.documents(spark).select("doc_id", "text")
        extract = self.extract

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield pd.DataFrame([(d, k, v) for d, t in zip(frame["doc_id"], frame["text"]) if t for k, v in extract(t)], columns=["doc_id", "kind", "label"])

        return rows.mapInPandas(run, f"doc_id {dict(rows.dtypes)['doc_id']}, kind string, label string")


@dataclass
class Registry:
    """The sources in their order."""

    sources: list[Source] = field(default_factory=list)

    def register(self, source: Source) -> Source:
        if any(s.name == source.name for s in self.sources):
            raise ValueError(f"{source.name} is registered already")
        self.sources.append(source)
        return source

    def get(self, name: str) -> Source:
        for s in self.sources:
            if s.name == name:
                return s
        raise KeyError(name)

    def builtin(self) -> list[Source]:
        return [s for s in self.sources if s.builtin]

    def attaching(self) -> list[str]:
        return [s.name for s in self.sources if s.needs_attach]


def ingest(spark: SparkSession, source: StructuredSource, kb: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with a source's rows replaced by what it gives now."""
    out = dict(kb)
    for kind in ("occupations", "skills"):
        rows = source.entities(spark, kind)
        if rows is not None:
            fields = kb[kind].columns
            out[kind] = tables.replace_source(kb[kind], tables.project(rows, fields).select(*[F.nullif(F.col(f), F.lit("")).try_cast(t).alias(f) for f, t in kb[kind].dtypes]), "source", source.name)
    if source.relations is not None:
        rel = source.relations(spark).withColumn("source", F.lit(source.name))
        fields = kb["occupation_skill_relations"]
        shaped = rel.select(*[(F.col(f) if f in rel.columns else F.lit(None)).cast(t).alias(f) for f, t in fields.dtypes])
        out["occupation_skill_relations"] = tables.replace_source(fields, shaped, "source", source.name)
    return out


def ingest_mentions(spark: SparkSession, source: ExtractionSource, kb: dict[str, DataFrame], floor: int = 2) -> dict[str, DataFrame]:
    """The relations replaced by what a source's texts mention together: roles and skills of one text, counted by text.

    Mentions are resolved by the label indices of all other sources, so reading a source again gives the same.
    """
    found = source.mentions(spark)
    index = lambda t: lookup.label_index(kb[t].where(~F.col("source").eqNullSafe(source.name) & ~F.col("source").eqNullSafe("TAXONOMY")), "entity_id", "entity_id", [F.array("pref_label_en"), F.array("pref_label_fr"), split_multi("alt_labels_en"), split_multi("alt_labels_fr")])
    said = lambda kind, t, name: lookup.key_join(found.where(F.col("kind") == kind), "label", index(t)).select("doc_id", F.col("entity").alias(name)).distinct()
    met = said("occupation", "occupations", "occupation_entity_id").join(said("skill", "skills", "skill_entity_id"), "doc_id")
    counted = met.groupBy("occupation_entity_id", "skill_entity_id").agg(F.count("*").alias("n")).where(F.col("n") >= floor)
    rel = counted.select("occupation_entity_id", "skill_entity_id", F.lit("demand").alias("relation_type"), F.lit(source.name).alias("source"), F.col("n").cast("string").alias("weight"))
    old = kb["occupation_skill_relations"]
    shaped = rel.select(*[(F.col(f) if f in rel.columns else F.lit(None)).cast(t).alias(f) for f, t in old.dtypes])
    return kb | {"occupation_skill_relations": tables.replace_source(old, shaped, "source", source.name)}


def labels_of(rows: DataFrame) -> DataFrame:
    """The long label table of occupations or skills."""
    fields = {("preferred", "en"): split_multi("pref_label_en"), ("preferred", "fr"): split_multi("pref_label_fr"), ("alt", "en"): split_multi("alt_labels_en"), ("alt", "fr"): split_multi("alt_labels_fr")}
    return lookup.label_rows(rows, "entity_id", "source", fields)
