"""Similarity joins over vectors, and what is decided by them.

``cosine_pairs`` is exact.  Both sides are dealt into blocks of bounded size by a hash of the id; every block of one side
meets every block of the other in a join on the block's number, and each meeting multiplies two matrices and keeps the
best of each row.  Its work is the product of the sizes, as it must be for an exact answer; what is shuffled is that
divided by the block size, its memory is two blocks, and nothing passes through the driver.

``sparse_cosine`` above a floor meets only rows that share one of their rarest terms: what a row's other terms can add up
to is below the floor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _blocks(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """((block, ids, grps, flat), number of blocks): the vectors of a block as one row."""
    known = rows.where("vec is not null and id is not null").select("id", "grp", "vec")
    n = max(1, -(-known.count() // size))
    part = known.groupBy(F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("block")).agg(F.collect_list(F.struct("id", "grp", "vec")).alias("x"))
    return part.select("block", F.col("x.id").alias("ids"), F.col("x.grp").alias("grps"), F.flatten(F.transform("x.vec", lambda v: v.cast("array<double>"))).alias("flat")), n


def cosine_pairs(left: DataFrame, right: DataFrame, floor: float, top: int, block: int = 4096) -> DataFrame:
    """(a, a_group, b, b_group, sim): for each left row and right group, its ``top`` right rows at or above ``floor``.

    Both sides have (id, grp, vec); rows of one group are no pairs.  Equal similarities go to the smaller id.  Rows
    without a vector or an id are left out.
    """
    kinds = dict(left.dtypes)["id"], dict(left.dtypes)["grp"]
    schema = f"a {kinds[0]}, a_group {kinds[1]}, b {kinds[0]}, b_group {kinds[1]}, sim double"
    (rows, _), (others, n) = _blocks(left, block), _blocks(right, block)
    asked = rows.select("ids", "grps", "flat", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block"))
    met = asked.join(others.toDF("block", "ids2", "grps2", "flat2"), "block").repartition(max(1, rows.sparkSession.sparkContext.defaultParallelism), "block", F.xxhash64("ids"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                ids, others = np.asarray(r.ids), np.asarray(r.ids2)
                mine, theirs = (_unit(np.asarray(f, np.float64).reshape(len(i), -1)) for f, i in ((r.flat, ids), (r.flat2, others)))
                yield _best(ids, np.asarray(r.grps), mine, others, np.asarray(r.grps2), theirs, floor, top)

    found = met.select("ids", "grps", "flat", "ids2", "grps2", "flat2").mapInPandas(run, schema)
    return found if n == 1 else top_per(found, ["a", "b_group"], [-F.col("sim"), F.col("b")], top)


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12) if len(m) else m


def _best(ids: np.ndarray, own: np.ndarray, m: np.ndarray, others: np.ndarray, groups: np.ndarray, n: np.ndarray, floor: float, top: int) -> pd.DataFrame:
    sims = np.round(m @ n.T, 9)
    i, j = np.nonzero((sims >= floor) & (own[:, None] != groups[None, :]))
    out = pd.DataFrame({"a": ids[i], "a_group": own[i], "b": others[j], "b_group": groups[j], "sim": sims[i, j]})
    return out.sort_values(["a", "b_group", "sim", "b"], ascending=[True, True, False, True]).groupby(["a", "b_group"]).head(top)


def top_per(rows: DataFrame, keys: list[str], order: list[Column], most: int, after: int = 0) -> DataFrame:
    """The first rows of each key by an order, up to place ``most``, those up to ``after`` left out."""
    from pyspark.sql import Window as W

    return rows.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where((F.col("_n") <= most) & (F.col("_n") > after)).drop("_n")


def mutual_top(rows: DataFrame, floor: float = 0.50, top: int = 5) -> DataFrame:
    """(a, b, sim): the best pairs of both directions, the smaller id first, each pair once."""
    both = cosine_pairs(rows, rows, floor, top)
    return both.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("sim").alias("sim"))


def nearest(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """(a, b, sim): the nearest anchor of every row."""
    one = rows.withColumn("grp", F.lit(0)), anchors.withColumn("grp", F.lit(1))
    return cosine_pairs(*one, -1.0, 1).select("a", "b", "sim")


def centroids(rows: DataFrame) -> DataFrame:
    """(id, vec): the mean vector of every group."""
    parts = rows.select("grp", F.posexplode("vec").alias("at", "x")).groupBy("grp", "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return parts.groupBy(F.col("grp").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("vec"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def rerank(shortlist: DataFrame, key: str, sim: str, entail: str, weight: float = 0.5, low: float = 0.60, curated: DataFrame | None = None) -> DataFrame:
    """Each key's best by similarity and ``weight`` times entailment (none counts 0); curated choices win.

    ``doubtful`` tells a best similarity under ``low``.
    """
    score = F.col(sim) + weight * F.coalesce(F.col(entail), F.lit(0.0))
    best = shortlist.groupBy(key).agg(F.min_by(F.struct("b", sim), F.struct(-score, -F.col(sim), F.col("b"))).alias("x")).select(key, F.col("x.b").alias("target"), F.col(f"x.{sim}").alias(sim))
    best = best.withColumn("doubtful", F.col(sim) < low)
    if curated is None:
        return best
    return best.join(curated.select(key, F.col("target").alias("_c")), key, "left").withColumn("target", F.coalesce("_c", "target")).withColumn("doubtful", F.col("doubtful") & F.col("_c").isNull()).drop("_c")


def merge_decision(pref: Column, any_label: Column, sim: Column, nli: Column, occupation: Column, defined: Column, sim_occ: float = 0.72, sim_skill: float = 0.90, entail: float = 0.60) -> tuple[Column, Column, Column]:
    """(relation, confidence, flag) of a candidate pair.

    Equal preferred keys are exactMatch and merge by label; any equal label is closeMatch; else the similarity decides.
    The confidence is the larger of similarity and 0.60 + 0.30 times entailment, with floors for equal labels.
    """
    raw = F.greatest(sim, F.coalesce(0.60 + 0.30 * nli, sim))
    confidence = F.round(F.when(pref, F.greatest(raw, F.lit(0.95))).when(any_label, F.greatest(raw, F.lit(0.85))).otherwise(raw), 4)
    relation = F.when(pref, "exactMatch").when(any_label, "closeMatch").when(confidence >= 0.70, "closeMatch").otherwise("relatedMatch")
    enough = F.when(occupation, sim >= sim_occ).otherwise(sim >= sim_skill)
    needs = occupation & defined & nli.isNotNull()
    flag = F.when(pref, "label").when(enough & (~needs | (nli >= entail)), "semantic").otherwise("")
    return relation, confidence, flag


def gate(sim_in: Column, sim_out: Column, nli: Column, malformed: Column, sim_non: float = 0.65, margin: float = 0.05, entail: float = 0.15) -> Column:
    """malformed, nli or keep: a row nearer to what is out of scope is blocked only if entailment says so."""
    suspect = (sim_out >= sim_non) & (sim_out - sim_in >= margin)
    return F.when(malformed, "malformed").when(suspect & (nli < entail), "nli").otherwise("keep")


def audit_verdict(nli_pass: Column, exact: Column, near: Column) -> Column:
    """strong, corroborated, nli_only or weak."""
    backed = exact | near
    return F.when(nli_pass & backed, "strong").when(backed, "corroborated").when(nli_pass, "nli_only").otherwise("weak")


def char_grams(text: Column, sizes: tuple[int, ...] = (3, 4, 5)) -> Column:
    """Character n-grams inside words, a blank on both sides of each word."""
    ws = F.transform(F.split(F.trim(F.lower(text)), "\\s+"), lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def runs(w: Column, n: int) -> Column:
        last = F.length(w) - n + 1
        return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(w, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(ws, lambda w: F.flatten(F.array(*[runs(w, n) for n in sizes]))))


def tfidf(rows: DataFrame, row_id: str, text: str, sizes: tuple[int, ...] = (3, 4, 5)) -> DataFrame:
    """(id, term, weight): smoothed idf times count, each row's weights of length one."""
    terms = rows.select(F.col(row_id).alias("id"), F.explode(char_grams(F.col(text), sizes)).alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))
    n = rows.select(row_id).distinct().count()
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    raw = terms.join(df, "term").select("id", "term", (F.col("tf") * (F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0)).alias("w"))
    norm = raw.groupBy("id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return raw.join(norm, "id").select("id", "term", (F.col("w") / F.col("norm")).alias("weight"))


def sparse_cosine(left: DataFrame, right: DataFrame, floor: float | None = None) -> DataFrame:
    """(a, b, sim) of all rows that share a term; with a ``floor`` above 0 those whose similarity reaches it.

    Weights of a row are of length one.  With a floor a row is met by its rarest terms only, as many as it takes until
    the length of the rest is below the floor; the rest of either row alone can't bring the product up to it.
    """
    if not floor:
        a, b = left.select(F.col("id").alias("a"), "term", F.col("weight").alias("wa")), right.select(F.col("id").alias("b"), "term", F.col("weight").alias("wb"))
        return a.join(b, "term").groupBy("a", "b").agg(F.sum(F.col("wa") * F.col("wb")).alias("sim"))
    df = left.select("term").unionByName(right.select("term")).groupBy("term").agg(F.count("*").alias("df"))

    def profile(rows: DataFrame, name: str) -> DataFrame:
        one = rows.join(df, "term").groupBy(F.col("id").alias(name)).agg(F.array_sort(F.collect_list(F.struct("df", "term", "weight"))).alias("ts"))
        start = F.struct(F.lit(0.0).alias("before"), F.array().cast("array<string>").alias("terms"))

        def step(acc, t):
            more = F.sqrt(F.greatest(1 - acc["before"], F.lit(0.0))) >= floor - 1e-9
            return F.struct((acc["before"] + t["weight"] * t["weight"]).alias("before"), F.when(more, F.concat(acc["terms"], F.array(t["term"]))).otherwise(acc["terms"]).alias("terms"))

        return one.select(name, F.map_from_entries(F.transform("ts", lambda t: F.struct(t["term"], t["weight"]))).alias(f"w{name}"), F.aggregate("ts", start, step)["terms"].alias("head"))

    a, b = profile(left, "a"), profile(right, "b")
    met = a.select("a", F.explode("head").alias("term")).join(b.select("b", F.explode("head").alias("term")), "term").select("a", "b").distinct()
    both = met.join(a.drop("head"), "a").join(b.drop("head"), "b")
    shared = F.aggregate(F.map_keys("wa"), F.lit(0.0), lambda t, k: t + F.try_element_at("wa", k) * F.coalesce(F.try_element_at("wb", k), F.lit(0.0)))
    return both.select("a", "b", shared.alias("sim")).where(F.col("sim") >= floor)
