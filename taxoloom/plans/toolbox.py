"""What a propose-and-verify loop asks for: shortlists, cosines, labels and the log of what was committed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxoloom.functions.text import now_iso
from taxoloom.operators import similarity, tables
from taxoloom.session import Scratch


@dataclass
class Toolbox:
    """Over skills with (entity_id, label, vec); the vectors are written once and read by every call."""

    skills: DataFrame

    def __post_init__(self) -> None:
        self.index = Scratch(self.skills.sparkSession, "toolbox").cut(self.skills.select("entity_id", "label", "vec").where("vec is not null"))

    def shortlist(self, owners: DataFrame, start: int = 0, size: int = 25) -> DataFrame:
        """(a, b, sim): for each owner (id, vec) the page of its nearest skills from place ``start`` on."""
        asked = owners.select("id", F.lit("owner").alias("grp"), "vec")
        found = similarity.cosine_pairs(asked, self.index.select(F.col("entity_id").alias("id"), F.lit("skill").alias("grp"), "vec"), -1.0, start + size)
        return similarity.top_per(found, ["a"], [-F.col("sim"), F.col("b")], start + size, start).select("a", "b", "sim")

    def by_label(self, labels: DataFrame, order: str = "entity_id") -> DataFrame:
        """(label, entity_id): the last skill of each label."""
        last = self.index.groupBy("label").agg(F.max_by("entity_id", order).alias("entity_id"))
        return labels.select("label").distinct().join(last, "label")

    def cosine(self, pairs: DataFrame, owners: DataFrame) -> DataFrame:
        """The pairs (owner, entity_id) with ``sim``."""
        met = pairs.join(self.index.select("entity_id", "vec"), "entity_id").join(owners.select(F.col("id").alias("owner"), F.col("vec").alias("_o")), "owner")
        return met.withColumn("sim", similarity.dot(F.col("vec"), F.col("_o"))).drop("vec", "_o")


def committed(log: DataFrame, results: DataFrame, task: str) -> DataFrame:
    """The log of generated results (task, key, output, created_at) with new ones; of a key the last write counts."""
    new = results.select(F.lit(task).alias("task"), "key", "output", now_iso().alias("created_at"))
    return tables.last_write(log.unionByName(new), ["task", "key"], [F.col("created_at"), F.col("output")])
