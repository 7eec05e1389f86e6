"""Mapping freely typed values to the entries of a reference list, by token repair and soft TF-IDF.

The reference list is read as a grid: entries that start alike (or end alike, in the second language) share a role, the
rest of the entry is its field, and the two languages are lined up through the entries that have both.  An entry can
then be spelled by any known form of its role with any known form of its field, so an entry without a second-language
text is found all the same.

Every distinct token typed is joined once with the vocabulary of these forms: by equality of deletion keys (all ways of
leaving out up to two letters), after which the edit distance with swaps decides; by shortening, with or without a dot;
as initials of a phrase.  A title meets the spellings whose rarest token it may stand for, so common tokens make no
candidates.  Spellings are ranked by soft TF-IDF: the cosine of the idf weights, every product times the closeness of the
typed token to the listed one.  An exact check follows: a spelling counts only if each of its telling tokens is found, so
a listed role in an unlisted field, and any other text, is unmatched.

All of this is done in joins; nothing of the list or of the titles passes through the driver.  Null, empty and blank
values are unmatched; values of any length are read whole; repeated values are ranked once and come out with each of
their rows.  Equal scores go to the smaller id.  Ids may be of any type that can be ordered.  An empty list matches
nothing.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from taxoloom.session import Scratch

#: Words of either language that carry no meaning of their own.
FUNCTION_WORDS = frozenset(("a", "au", "aux", "d", "de", "des", "du", "e", "en", "et", "l", "la", "le", "les", "of", "the", "and", "for", "in", "se", "on", "or", "ou", "un", "une", "us", "es"))
#: How agent nouns of French are put in the feminine.
FEMININE = (("ateur", "atrice"), ("teur", "teuse"), ("teur", "trice"), ("eur", "euse"), ("eur", "eure"), ("ien", "ienne"), ("ant", "ante"), ("ef", "effe"), ("ier", "iere"), ("if", "ive"))
_INCLUSIVE = re.compile(r"·\w+|\((?:e|ne|fe|se|te|trice|rice|euse|eure|ienne)\)", re.I)
_TOKEN = re.compile(r"[a-z0-9]+\.?")


def fold(text: str) -> str:
    """Lower case without accents."""
    flat = unicodedata.normalize("NFKD", text).casefold()
    return "".join(ch for ch in flat if not unicodedata.combining(ch))


def tokens(text: str | None) -> list[str]:
    """Distinct tokens of a value; a final dot stays, as it tells a shortening."""
    return list(dict.fromkeys(_TOKEN.findall(fold(_INCLUSIVE.sub("", text))))) if text else []


def osa(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours; anything above ``most`` is most + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


def reach(word: str) -> int:
    """Edits a word of this length may have."""
    return 0 if len(word) < 4 else 1 if len(word) < 8 else 2


def short_reach(word: str) -> int:
    """As ``reach``, but a word of three letters may have one edit: for lists whose entries must be found whole."""
    return max(reach(word), int(len(word) == 3))


def deletions(word: str, most: int) -> set[str]:
    """The word and all it becomes by leaving out up to ``most`` letters."""
    found = layer = {word}
    for _ in range(most):
        layer = {w[:i] + w[i + 1 :] for w in layer for i in range(len(w))}
        found = found | layer
    return found


_KEYS = ArrayType(StringType())


@F.pandas_udf(_KEYS)
def _tokens(column: pd.Series) -> pd.Series:
    return column.map(tokens)


@F.pandas_udf(_KEYS)
def _plain_tokens(column: pd.Series) -> pd.Series:
    return column.map(lambda t: re.findall("[a-z0-9]+", fold(t)) if t else [])


@F.pandas_udf(_KEYS)
def _form_keys(form: pd.Series, known: pd.Series) -> pd.Series:
    return pd.Series([[f"d{k}" for k in deletions(f, short_reach(f) if c == 1.0 else 0)] + [f"p{f[:n]}" for n in range(2, len(f) + 1)] for f, c in zip(form, known)])


@F.pandas_udf(_KEYS)
def _deletion_keys(column: pd.Series) -> pd.Series:
    return column.map(lambda w: sorted({f"d{k}" for k in deletions(w.rstrip("."), short_reach(w.rstrip(".")))} | {f"p{w.rstrip('.')}"}))


def _closeness(typed: pd.Series, form: pd.Series, known: pd.Series) -> pd.Series:
    def one(t: str, f: str, c: float) -> float:
        word = t.rstrip(".")
        if word == f:
            return c
        if f.startswith(word) and (len(word) > 1 and t != word or len(word) > 2 and len(f) - len(word) > 1) and c == 1.0:
            return 0.9
        most = min(short_reach(word), short_reach(f)) if c == 1.0 else 0  # initials are never misspelled
        d = osa(word, f, most)
        return c * (1 - d / max(len(word), len(f))) if d <= most else 0.0

    return pd.Series([one(*x) for x in zip(typed, form, known)])


def parted(titles: DataFrame, end: bool) -> DataFrame:
    """Adds ``role`` and ``field`` to distinct titles in ``words``: the role is what all with the same first (or last) word share."""
    turned = titles.withColumn("_w", F.reverse("words") if end else F.col("words")).withColumn("_lead", F.get("_w", F.lit(0)))
    heads = turned.where("size(_w) > 1").select("_lead", "_w", F.explode(F.sequence(F.lit(1), F.size("_w") - 1)).alias("_k"))
    alike = heads.groupBy("_lead", "_k").agg(F.count("*").alias("n"), F.min(F.slice("_w", 1, F.col("_k"))).alias("low"), F.max(F.slice("_w", 1, F.col("_k"))).alias("high"))
    sizes = turned.groupBy("_lead").agg(F.count("*").alias("all"))
    shared = alike.join(sizes, "_lead").where((F.col("n") == F.col("all")) & (F.col("all") > 1) & (F.col("low") == F.col("high"))).groupBy("_lead").agg(F.max("_k").alias("_shared"))
    at = F.coalesce("_shared", F.lit(1))
    role, field = F.slice("_w", F.lit(1), at), F.slice("_w", at + 1, F.size("_w"))
    if end:
        role, field = F.reverse(role), F.reverse(field)
    return turned.join(shared, "_lead", "left").select(*titles.columns, role.alias("role"), field.alias("field"))


def grid(listed: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """((entry, words) of every spelling of every entry, (words) of roles and fields of several words) of (entry, first, second)."""
    told = scratch.cut(listed.select("entry", _plain_tokens(F.coalesce("first", F.lit(""))).alias("first"), _plain_tokens(F.coalesce("second", F.lit(""))).alias("second")))
    front = scratch.cut(parted(told.select(F.col("first").alias("words")).where("size(words) > 0").distinct(), False))
    back = scratch.cut(parted(told.select(F.col("second").alias("words")).where("size(words) > 0").distinct(), True))
    both = told.where("size(first) > 0").join(front.select(F.col("words").alias("first"), "role", "field"), "first")
    lined = both.where("size(second) > 0").join(back.select(F.col("words").alias("second"), F.col("role").alias("role2"), F.col("field").alias("field2")), "second")
    roles = front.select("role", F.col("role").alias("as_role")).unionByName(lined.select("role", F.col("role2").alias("as_role"))).distinct()
    fields = front.select("field", F.col("field").alias("as_field")).unionByName(lined.select("field", F.col("field2").alias("as_field"))).distinct()
    cells = both.join(roles, "role").join(fields, "field").select("entry", F.concat("as_role", "as_field").alias("words"))
    whole = told.where("size(second) > 0").select("entry", F.col("second").alias("words"))
    parts = front.select(F.explode(F.array("role", "field")).alias("words")).unionByName(back.select(F.explode(F.array("role", "field")).alias("words")))
    return scratch.cut(cells.unionByName(whole).distinct()), scratch.cut(parts.where("size(words) > 1").distinct())


def vocabulary(spellings: DataFrame, phrases: DataFrame) -> DataFrame:
    """(form, token, known): every form that stands for a token of the list; initials stand for several."""
    empty = F.array(*[F.lit(w) for w in sorted(FUNCTION_WORDS)])
    base = spellings.select(F.explode(F.array_except("words", empty)).alias("token")).distinct()
    endings = F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.lit(f).alias("f")) for m, f in FEMININE]))
    women = base.select("token", endings.alias("e")).where(F.col("token").endswith(F.col("e.m")))
    women = women.select(F.concat(F.expr("substring(token, 1, length(token) - length(e.m))"), "e.f").alias("form"), "token", F.lit(1.0).alias("known"))
    initials = lambda words: F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")
    short = phrases.select(F.array_except("words", empty).alias("telling"), F.explode(F.array(initials(F.col("words")), initials(F.array_except("words", empty)))).alias("form"))
    short = short.where((F.length("form") > 1) & ~F.col("form").isin(*FUNCTION_WORDS)).join(base.select(F.col("token").alias("form")), "form", "left_anti")
    short = short.select("form", F.explode("telling").alias("token"), F.lit(0.95).alias("known"))
    return base.select(F.col("token").alias("form"), "token", F.lit(1.0).alias("known")).unionByName(women).unionByName(short).distinct()


def repair(typed: DataFrame, vocab: DataFrame) -> DataFrame:
    """(typed, token, closeness) of all tokens of the list that a typed token may stand for.

    A typed token that is a form itself stands for that only; else the closest forms and those nearly as close are taken.
    """
    table = vocab.select("form", "token", "known", F.explode(_form_keys("form", "known")).alias("k")).distinct()
    measure = F.pandas_udf(_closeness, DoubleType())
    met = typed.select("typed", F.explode(_deletion_keys("typed")).alias("k")).join(table, "k").drop("k").distinct()
    near = met.withColumn("closeness", measure("typed", "form", "known")).where("closeness > 0")
    best = near.groupBy("typed").agg(F.max("closeness").alias("top"))
    return near.join(best, "typed").where("closeness >= top - 0.03").groupBy("typed", "token").agg(F.max("closeness").alias("closeness"))


def match(rows: DataFrame, value: str, entries: DataFrame, entry_id: str, first: str, second: str) -> DataFrame:
    """The rows with (entry_id, score) of the entry their value names; both null where it names none.

    Columns of the rows that have these names already are replaced.
    """
    scratch = Scratch(rows.sparkSession, "entries")
    listed = entries.select(F.col(entry_id).alias("entry"), F.col(first).alias("first"), F.col(second).alias("second")).where("entry is not null").distinct()
    spellings, parts = grid(listed, scratch)
    empty = F.array(*[F.lit(w) for w in sorted(FUNCTION_WORDS)])
    keyed = spellings.select("entry", F.array_sort(F.array_distinct(F.array_except("words", empty))).alias("words")).where("size(words) > 0").distinct()
    total = keyed.agg(F.count("*").alias("all"))
    idf = keyed.select(F.explode("words").alias("token")).groupBy("token").agg(F.count("*").alias("n")).crossJoin(total)  # one row
    idf = scratch.cut(idf.select("token", F.log(1 + F.col("all") / F.col("n")).alias("idf")))
    each = keyed.select("entry", "words", F.explode("words").alias("token")).join(idf, "token")
    # each spelling is met by its rarest token
    spelled = scratch.cut(each.groupBy("entry", "words").agg(F.max_by("token", F.struct("idf", "token")).alias("token"), F.sqrt(F.sum(F.col("idf") * F.col("idf"))).alias("length")))
    said = scratch.cut(rows.select(F.col(value).alias("said")).where(F.col(value).isNotNull()).distinct().withColumn("typed", _tokens("said")))
    typed = said.select("said", F.explode("typed").alias("typed"))
    repaired = repair(typed.select("typed").distinct(), vocabulary(spellings, parts)).join(idf, "token")
    heard = (
        typed.join(repaired, "typed")
        .groupBy("said", "token")
        .agg(F.max("closeness").alias("closeness"), F.first("idf").alias("idf"))
        .groupBy("said")
        .agg(F.array_sort(F.collect_list(F.struct("token", "closeness", "idf"))).alias("heard"))
    )
    heard = scratch.cut(heard)
    asked = heard.select("heard").distinct()
    met = asked.select("heard", F.explode("heard.token").alias("token")).join(spelled, "token").where(F.size(F.array_except("words", F.col("heard.token"))) == 0)
    shared = F.aggregate(F.filter("heard", lambda h: F.array_contains("words", h["token"])), F.lit(0.0), lambda t, h: t + h["idf"] * h["idf"] * h["closeness"])
    said_length = F.sqrt(F.aggregate("heard", F.lit(0.0), lambda t, h: t + h["idf"] * h["idf"]))
    scored = met.select("heard", "entry", F.round(shared / (F.col("length") * said_length), 6).alias("score"))
    ranked = scored.groupBy("heard").agg(F.min(F.struct((-F.col("score")).alias("score"), "entry")).alias("best"))
    named = heard.join(ranked, "heard").select(F.col("said").alias(value), F.col("best.entry").alias(entry_id), F.round(-F.col("best.score"), 4).alias("score"))
    return rows.drop(entry_id, "score").join(named, value, "left")
