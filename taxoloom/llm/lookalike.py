"""One consistent form for text that looks the same and differs in its characters.

A label is cut into tokens at blanks.  Every letter belongs to the scripts in which a letter of the same shape exists;
these sets are intersected along a token.  A token whose own letters come from several scripts is mixed, and is spelled
in the one script in which all its letters exist; a token of one script whose every letter has a look-alike in another
is a whole-script confusable, and takes the script that the unmistakable letters of the label call for.  What remains is
brought to composed form, full and half width to the common width, ligatures to letters, blanks of any width to the plain
space, hyphens to the plain one; characters without shape go, as do blanks at the ends.  Case, accents, spacing inside
and order stay.  Null stays null; texts of any length are read whole.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from taxoloom.session import Scratch

#: Fixed values (Unicode Technical Standard 39): letters of other scripts that print as the Latin letter beside them.
LATIN_OF = {
    "CYRILLIC": dict(zip("АВЕКМНОРСТУХЅІЈԚԜҮЗаеорсухѕіјԛԝһӏ", "ABEKMHOPCTYXSIJQWY3aeopcyxsijqwhl")),
    "GREEK": dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορικγυχ", "ABEZHIKMNOPTYXavopikyux")),
    "ARMENIAN": dict(zip("ՕՏԼօոսհցզ", "OSLonuhgq")),
}
_TO_LATIN = {ch: latin for table in LATIN_OF.values() for ch, latin in table.items() if latin.isalpha()}
_FROM_LATIN = {script: {latin: ch for ch, latin in table.items()} for script, table in LATIN_OF.items()}
#: Latin letters that print as others.
_SAME_LATIN = {"ɑ": "a", "ɡ": "g", "ⅼ": "l"}
_SHAPELESS = frozenset("\u00ad\u034f\u061c\u180e\u200b\u200c\u200d\u200e\u200f\u2060\u2061\u2062\u2063\u2064\ufeff\ufe0e\ufe0f")
_HYPHENS = frozenset("\u2010\u2011\ufe63")


@lru_cache(maxsize=65536)
def script(ch: str) -> str:
    """The script of a letter by its character name; '' for anything shared between scripts."""
    if not ch.isalpha():
        return ""
    return unicodedata.name(ch, " ").split(" ")[0]


@lru_cache(maxsize=65536)
def scripts_of(ch: str) -> frozenset[str]:
    """All scripts in which a letter of this shape exists; empty for anything shared between scripts."""
    own = script(ch)
    if not own:
        return frozenset()
    latin = ch if own == "LATIN" else _TO_LATIN.get(ch)
    if latin is None:
        return frozenset({own})
    return frozenset({own, "LATIN"} | {s for s, back in _FROM_LATIN.items() if latin in back})


def spell(token: str, target: str) -> str:
    """The token with every letter that can be in the target script."""
    if target == "LATIN":
        return "".join(_TO_LATIN.get(ch, ch) for ch in token)
    back = _FROM_LATIN.get(target, {})
    return "".join(ch if script(ch) == target else back.get(_TO_LATIN.get(ch, ch), ch) for ch in token)


def resolved(token: str) -> frozenset[str] | None:
    """The scripts in which the whole token can be spelled; None if it has no letters."""
    sets = [s for s in map(scripts_of, token) if s]
    return frozenset.intersection(*sets) if sets else None


def consistent(text: str) -> str:
    """Each token in one script."""
    if text.isascii():
        return text
    tokens = text.split(" ")
    if not any(script(ch) not in ("", "LATIN") for ch in text):
        return text
    sure: dict[str, int] = {}
    for ch in text:
        kinds = scripts_of(ch)
        if len(kinds) == 1:
            (kind,) = kinds
            sure[kind] = sure.get(kind, 0) + 1
    main = max(sure, key=lambda s: (sure[s], s == "LATIN")) if sure else "LATIN"
    out = []
    for token in tokens:
        kinds = resolved(token)
        own = {script(ch) for ch in token} - {""}
        if not kinds or own == {main}:
            out.append(token)
        elif main in kinds:
            out.append(spell(token, main))
        elif len(own) > 1:
            out.append(spell(token, "LATIN" if "LATIN" in kinds else min(kinds)))
        else:
            out.append(token)
    return " ".join(out)


def _plain(ch: str) -> str:
    if ch in _SHAPELESS:
        return ""
    if ch in _HYPHENS:
        return "-"
    if unicodedata.category(ch) == "Zs":
        return " "
    kind = unicodedata.decomposition(ch)
    # full and half width, mathematical letters, ligatures, Roman numerals
    if kind.startswith(("<wide>", "<narrow>", "<font>")) or "ﬀ" <= ch <= "ﬆ" or "Ⅰ" <= ch <= "ⅿ":
        return unicodedata.normalize("NFKC", ch)
    return _SAME_LATIN.get(ch, ch)


def canonical(text: str | None) -> str | None:
    """The one form of all texts that look like this one."""
    if text is None:
        return None
    if text.isascii():
        return text.strip()
    flat = unicodedata.normalize("NFD", text)
    odd = {ch: _plain(ch) for ch in set(flat) if not ch.isascii()}
    changed = {ord(ch): plain for ch, plain in odd.items() if plain != ch}
    if changed:
        flat = flat.translate(changed)
    if any(script(ch) not in ("", "LATIN") for plain in odd.values() for ch in plain):
        flat = unicodedata.normalize("NFD", consistent(flat))
    return unicodedata.normalize("NFC", flat).strip()


@F.pandas_udf(StringType())
def _canonical(texts: pd.Series) -> pd.Series:
    return texts.map(canonical, na_action="ignore").astype(object).where(texts.notna(), None)


def canonical_text(column: str | Column) -> Column:
    """Column form of ``canonical``."""
    return _canonical(F.col(column) if isinstance(column, str) else column)


def forms(rows: DataFrame, row_id: str, label: str) -> DataFrame:
    """(id, raw, form) of the records whose form has several spellings; a written table, so every label is brought to its form once."""
    spelled = rows.select(F.col(row_id).alias("id"), F.col(label).alias("raw")).where("id is not null and raw is not null").distinct().withColumn("form", canonical_text("raw"))
    spelled = Scratch(rows.sparkSession, "forms").cut(spelled.where("form <> ''"))
    several = spelled.groupBy("form").agg(F.min("raw").alias("low"), F.max("raw").alias("high")).where("low <> high").select("form")
    return spelled.join(several, "form", "left_semi")


def alike_pairs(rows: DataFrame, row_id: str, label: str) -> DataFrame:
    """(entity_id_a, entity_id_b): different records whose labels have one form and different characters, smaller id first.

    Only forms with several spellings enter the join, and it pairs records of different spellings only.
    """
    kept = forms(rows, row_id, label)
    a, b = kept.alias("a"), kept.alias("b")
    met = a.join(b, (F.col("a.form") == F.col("b.form")) & (F.col("a.id") < F.col("b.id")) & (F.col("a.raw") != F.col("b.raw")))
    return met.select(F.col("a.id").alias("entity_id_a"), F.col("b.id").alias("entity_id_b")).distinct()


def alike_classes(rows: DataFrame, row_id: str, label: str) -> DataFrame:
    """(entity_id, class_id, links): one row per record and form, with the form's smallest id and how many records spell it otherwise."""
    kept = forms(rows, row_id, label)
    sizes = kept.groupBy("form").agg(F.min("id").alias("class_id"), F.count("*").alias("all"))
    own = kept.groupBy("form", "raw").agg(F.count("*").alias("own"))
    return kept.join(sizes, "form").join(own, ["form", "raw"]).select(F.col("id").alias("entity_id"), "class_id", (F.col("all") - F.col("own")).alias("links")).distinct()
