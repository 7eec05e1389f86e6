"""One surviving record for each group of duplicate records, field by field.

The fields are unpivoted to long rows.  Every row votes for its value with the trust of its most trusted source times a
decay by age; the votes are added up per normalised value, winners are taken by ``max_by`` and pivoted back to one record
a group.  ``consensus`` lets many rows outvote a trusted one: trust falls by ``TRUST_STEP`` a rank and the decay has a
half-life.  ``best_row`` lets the most trusted row win however many others disagree, and the latest of equal trust: a
rank, and a tick of age, divide a vote by more than there are rows in any group (2 to the power of ``bits``).  Its votes
are counted from the best of the group, whose vote is one, so sums never under- or overflow where it matters.

A value competes only if it tells something: blanks, values without any letter or digit, stand-ins for "no value" and
bare ids do not, and a field without any such value has no winner.  Rows without a time are the oldest.  Values of equal
sums are decided by the smallest id of their best rows.  Repeated rows count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoloom.llm.groups import members
from taxoloom.session import bare

#: Spellings that stand for "no value", in lower case.
NO_VALUE = (
    "n/a", "na", "n.a.", "#n/a", "none", "null", "nil", "nan", "unknown", "undefined", "not available", "not applicable", "missing", "empty", "(empty)",
    "blank", "(blank)", "tbd", "tbc", "to be defined", "to be determined", "to be confirmed", "sans objet", "inconnu", "inconnue", "non renseigné",
    "non renseigne", "non défini", "à définir", "a definir", "vide", "aucun", "aucune", "néant",
)
BARE_ID = r"^(?:U?(?:OCC|SKL)|SKT|SKD|SKC)_[0-9A-Fa-f]{12}$"
TRUST_STEP = 4.0


def telling(value: Column) -> Column:
    """Whether a string says something."""
    text = F.lower(bare(value))
    return text.rlike("[\\p{L}\\p{N}]") & ~text.isin(*NO_VALUE) & ~F.upper(text).rlike(BARE_ID.upper().replace("(?:U?", "(?:U?"))


def named_sources(column: str) -> Column:
    """Distinct sources a list names, parted by bars, commas or semicolons, in upper case, without stand-ins for "no value"."""
    return F.array_distinct(F.transform(F.filter(members(column, "[|,;]"), lambda s: telling(s)), lambda s: F.upper(s)))


def long_votes(rows: DataFrame, trust: DataFrame, fields: tuple[str, ...], row_id: str, sources: str, built: str, half_life_days: float = 365.0) -> DataFrame:
    """(group_id, row_id, field_name, value, norm, rank, trust, decay, n_sources, at) of all telling values; an unranked row has no rank.

    ``rows`` has group_id; ``trust`` has (source, trust_rank) and is joined per named source.
    """
    kept = rows.select("group_id", F.col(row_id).alias("row_id"), F.col(built).alias("built"), named_sources(sources).alias("named"), *[F.col(f).alias(f"f_{f}") for f in fields]).dropDuplicates(
        ["group_id", "row_id", "built", *[f"f_{f}" for f in fields]]
    )
    ranks = trust.where("source is not null and trust_rank is not null").groupBy(F.upper(bare("source")).alias("source")).agg(F.min("trust_rank").alias("rank"))
    best = (
        kept.select("row_id", "built", F.explode("named").alias("source"))
        .join(ranks, "source")
        .groupBy("row_id", F.coalesce("built", F.lit(0).cast("timestamp").cast("timestamp_ntz")).alias("at"))
        .agg(F.min("rank").alias("rank"))
    )
    ranked = kept.withColumn("at", F.coalesce("built", F.lit(0).cast("timestamp").cast("timestamp_ntz"))).join(best, ["row_id", "at"], "left")
    age = F.unix_timestamp(F.col("at").cast("timestamp")) / 86400.0
    ranked = ranked.withColumns({"trust": F.coalesce(F.pow(F.lit(TRUST_STEP), -F.col("rank")), F.lit(0.0)), "decay": 1 / (1 + F.pow(F.lit(2.0), -age / half_life_days))})
    parts = [F.struct(F.lit(f).alias("field_name"), F.col(f"f_{f}").alias("value")) for f in fields]
    long = ranked.select("group_id", "row_id", "at", "rank", "trust", "decay", F.size("named").alias("n_sources"), F.inline(F.array(*parts)))
    return long.where(telling(F.col("value"))).withColumn("norm", F.lower(F.regexp_replace(bare("value"), "\\s+", " ")))


def _smaller(text: str) -> Column:
    """Sorts texts the other way round in ``max_by``."""
    return F.transform(F.split(text, ""), lambda ch: -F.ascii(ch))


def tally(votes: DataFrame, vote: Column, preferred: Column) -> DataFrame:
    """(group_id, field_name, row_id, value, votes): per field the normalised value with the largest sum of votes, as its preferred row spells it."""
    sums = votes.withColumn("vote", vote).groupBy("group_id", "field_name", "norm").agg(F.round(F.sum("vote"), 9).alias("votes"), F.max_by(F.struct("row_id", "value"), preferred).alias("pick"))
    return sums.groupBy("group_id", "field_name").agg(F.max_by(F.struct("pick", "votes"), F.struct(F.col("votes"), _smaller("pick.row_id"))).alias("won")).select("group_id", "field_name", "won.pick.row_id", "won.pick.value", "won.votes")


def consensus(votes: DataFrame) -> DataFrame:
    """(group_id, field_name, row_id, value, votes): the value with the largest sum of trust times decay."""
    return tally(votes, F.col("trust") * F.col("decay"), F.struct("trust", "at", _smaller("row_id")))


def best_row(votes: DataFrame, by_breadth: tuple[str, ...] = (), bits: int = 40) -> DataFrame:
    """(group_id, field_name, row_id, value) of the largest sum, where a rank or a microsecond outweighs 2 ** ``bits`` rows.

    For fields ``by_breadth`` the number of named sources takes the place of the rank.
    """
    broad = F.col("field_name").isin(*by_breadth) if by_breadth else F.lit(False)
    level = F.when(broad, F.col("n_sources")).otherwise(-F.coalesce("rank", F.lit(2**31 - 1))).cast("long")
    rated = votes.withColumns({"level": level, "tick": F.unix_micros(F.col("at").cast("timestamp"))})
    top = rated.groupBy("group_id", "field_name").agg(F.max(F.struct("level", "tick")).alias("top"))
    rated = rated.join(top, ["group_id", "field_name"])
    trust = F.pow(F.lit(2.0), -bits * (F.col("top.level") - F.col("level")))
    decay = F.pow(F.lit(2.0), -bits * F.greatest(F.col("top.tick") - F.col("tick"), F.lit(0)))
    return tally(rated, trust * decay, F.struct("level", "tick", _smaller("row_id"))).drop("votes")


def wide(winners: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """One record a group again."""
    return winners.groupBy("group_id").pivot("field_name", list(fields)).agg(F.first("value"))
