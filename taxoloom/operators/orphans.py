"""References to records that do not exist.

Both sides of the question are turned into signed change deltas: a record that appears adds one to the existence
count of its key and one that goes takes it away; a row that refers to a key adds one to its reference count.
``merge_state`` adds deltas up to one row per key and period, so a batch of changes is folded into a kept state without
reading the old rows again, in whatever order batches come.  ``orphan_keys`` reads the current orphans off the state: the
keys with references but no existence.  ``orphan_periods`` reads off it in which periods a key had references while its
existence count was zero, or changed; ``orphan_rows`` looks up the rows of just these, and where the count changed within
the period compares the row's own time.

A record is there from its first appearance until it is said to be removed, and again from its next appearance after
that.  A row told after the removal it carries itself is no appearance.

Nulls and blanks: a reference that is null or blank is none.  A record without an appearance time counts as there
from the start; one without a removal time stays.  A row without a time is judged against all of time, so it can be
``missing`` only.  Repeated rows count once.  Empty tables give empty results.  Only the named columns are read, so
further columns of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taxoloom.session import Scratch

ALWAYS = "0001-01-01 00:00:00"
BLANKS = " \t\r\n\u00a0\u2007\u202f\u2002\u2009\u200b\u200c\u200d\u2060\ufeff"


def clean_key(column: str) -> Column:
    """The key a reference names: without blanks, in upper case; null if nothing is left."""
    return F.nullif(F.upper(F.translate(F.col(column), BLANKS, "")), F.lit(""))


def existence_deltas(records: DataFrame, domain: str, key: str, appeared: str, removed: str | None = None) -> DataFrame:
    """(domain, key, at, n): +1 where a record appears, -1 where it is removed; 0 marks the removal of what never appeared."""
    gone = F.col(removed) if removed else F.lit(None).cast("timestamp_ntz")
    told = records.select(clean_key(key).alias("key"), F.coalesce(F.col(appeared), F.to_timestamp_ntz(F.lit(ALWAYS))).alias("at"), gone.alias("gone")).where("key is not null")
    # one row per key and removal is enough for all but keys that are removed and told again
    ends = told.where("gone is not null").groupBy("key").agg(F.array_sort(F.collect_set("gone")).alias("ends"))
    spans = (
        told.where("gone is null or at < gone")
        .join(ends, "key", "left")
        .withColumn("ends", F.coalesce("ends", F.array().cast("array<timestamp_ntz>")))
        .groupBy("key", F.size(F.filter("ends", lambda g: g <= F.col("at"))).alias("nth"), "ends")
        .agg(F.min("at").alias("born"))
    )
    known = spans.select("key", F.inline(F.array(F.struct(F.col("born").alias("at"), F.lit(1).alias("n")), F.struct(F.get("ends", F.col("nth")).alias("at"), F.lit(-1).alias("n"))))).where("at is not null")
    never = ends.join(spans.where("nth = 0").select("key"), "key", "left_anti").select("key", F.get("ends", F.lit(0)).alias("at"), F.lit(0).alias("n"))
    return known.unionByName(never).select(F.lit(domain).alias("domain"), "key", "at", "n")


def period_of(at: str | Column) -> Column:
    """The month of a time as a number; -1 for none."""
    return F.coalesce(F.year(at) * 12 + F.month(at), F.lit(-1))


def reference_rows(rows: DataFrame, table: str, row_id: str, at: str, fields: dict[str, str]) -> DataFrame:
    """(table_name, row_id, field_name, domain, key, at) of every reference; ``fields`` maps a field to its domain."""
    parts = [F.struct(F.lit(f).alias("field_name"), F.lit(d).alias("domain"), clean_key(f).alias("key")) for f, d in fields.items()]
    return rows.select(
        F.lit(table).alias("table_name"), F.col(row_id).alias("row_id"), F.col(at).alias("at"), F.inline(F.array(*parts))
    ).where("key is not null")


def merge_state(existence: DataFrame, references: DataFrame, state: DataFrame | None = None, by: tuple[str, ...] = ("domain", "key")) -> DataFrame:
    """(domain, key, period, refs, exists, changes): signed counts per key and month, with an earlier state folded in.

    ``references`` needs (domain, key), may have a time ``at`` and carry a signed ``n`` (-1 for a row that was withdrawn);
    ``changes`` counts the existence deltas.
    """
    n = F.col("n") if "n" in references.columns else F.lit(1)
    at = F.col("at") if "at" in references.columns else F.lit(None).cast("timestamp_ntz")
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    parts = existence.select(*by, period_of("at").alias("period"), none.alias("refs"), F.col("n").cast("long").alias("exists"), one.alias("changes")).unionByName(
        references.select(*by, period_of(at).alias("period"), n.cast("long").alias("refs"), none.alias("exists"), none.alias("changes"))
    )
    if state is not None:
        parts = parts.unionByName(state.select(*by, "period", "refs", "exists", "changes"))
    return parts.groupBy(*by, "period").agg(*[F.sum(c).alias(c) for c in ("refs", "exists", "changes")])


def orphan_keys(state: DataFrame) -> DataFrame:
    """(domain, key, refs, exists) of the keys that are referred to and do not exist, all periods added up."""
    return state.groupBy("domain", "key").agg(F.sum("refs").alias("refs"), F.sum("exists").alias("exists")).where("refs > 0 and exists <= 0")


def orphan_periods(state: DataFrame, by: tuple[str, ...] = ("domain", "key")) -> DataFrame:
    """(domain, key, period) with references in which the existence count was not positive at the start, or changed."""
    # a window holds the months of one key, whatever its number of references
    before = Window.partitionBy(*by).orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    opened = state.withColumn("opened", F.coalesce(F.sum("exists").over(before), F.lit(0)))
    return opened.where((F.col("refs") > 0) & ((F.col("opened") <= 0) | (F.col("changes") > 0))).select(*by, "period")


def _packed(df: DataFrame) -> DataFrame:
    """The key in two parts: a well-formed id's 48 bits as a number, any other spelling as text."""
    formed = F.col("key").rlike("^[A-Z]{3}_[0-9A-F]{12}$")
    return df.withColumns(
        {
            "k_num": F.when(formed, F.conv(F.substring("key", 5, 12), 16, 10).cast("long")).otherwise(F.lit(-1).cast("long")),
            "k_text": F.when(formed, F.substring("key", 1, 3)).otherwise(F.col("key")),
        }
    ).drop("key")


def orphan_rows(references: DataFrame, existence: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """(table_name, row_id, field_name, at, reason) of the references whose existence count was not positive then.

    The orphan periods are read off the counts, which are combinable, so hot keys shrink before they are shuffled; they
    come with the timeline of their key and are a written table, which the planner broadcasts if it is small.  The rows
    are the side that adaptive execution splits.
    """
    by = ("domain", "k_num", "k_text")
    scratch = Scratch(references.sparkSession, "orphans")
    changes, refs = _packed(existence), _packed(references)
    kept = scratch.cut(merge_state(changes, refs, None if state is None else _packed(state), by))
    timeline = changes.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("at", F.col("n").cast("int").alias("n")))).alias("steps"))
    periods = scratch.cut(orphan_periods(kept, by).join(timeline, list(by), "left"))
    known = refs.withColumn("period", period_of("at")).join(periods, [*by, "period"]).select("table_name", "row_id", "field_name", "at", "steps")
    seen = F.filter("steps", lambda s: F.col("at").isNull() | (s["at"] <= F.col("at")))
    alive = F.aggregate(seen, F.lit(0), lambda n, s: n + s["n"])
    reason = (
        F.when(F.col("steps").isNull(), "missing")
        .when(F.col("at").isNull() | (alive > 0), None)
        .when(F.exists(seen, lambda s: s["n"] < 1), "deleted")
        .otherwise("late")
    )
    return known.withColumn("reason", reason).where("reason is not null").select("table_name", "row_id", "field_name", "at", "reason")
