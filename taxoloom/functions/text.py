"""Text functions as column expressions: folding, keys, tokens, cleaning, decoding.

All of them but the resolution of relative links stay inside the JVM.  Null input counts as the empty text unless a function says otherwise.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Characters that are folded before accents are dropped.
QUOTES = "’‘`´"
DASHES = "‑–—−"
LIGATURES = (("œ", "oe"), ("Œ", "OE"), ("æ", "ae"), ("Æ", "AE"), ("ﬁ", "fi"), ("ﬂ", "fl"))
# Words at the end of a topic that add nothing to it.
GENERIC_TAIL = ("approach", "approaches", "method", "methods", "methodology", "methodologies", "technique", "techniques")
# The entities that are decoded in markup.
ENTITIES = (("&nbsp;", " "), ("&amp;", "&"), ("&#39;", "'"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&eacute;", "é"))


# What is a token, and how the parts of a posting's title are told apart.
TECH_TOKEN = "[a-z0-9+.#]+"
PROSE_TOKEN = "[A-Za-z0-9][A-Za-z0-9+.#-]*"
TITLE_PARTS = "(?i)\\s+[-–—|/]\\s+|\\s+(?:chez|at|@)\\s+"
GENDER_MARK = "(?i)\\b[hfmw]\\s*/\\s*[hfmw]\\b"
EDGE_SIGNS = " \\t,.;:·•!?\"'()\\[\\]{}"


def _col(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


@lru_cache(maxsize=1)
def fold_table() -> tuple[str, str]:
    """(from, to): every character of one ASCII character after compatibility decomposition, by rule."""
    src, dst = [], []
    for code in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2070), *range(0x2100, 0x2150), 0x3000, *range(0xFF01, 0xFF5F)):
        flat = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(flat) == 1:
            src.append(chr(code))
            dst.append(flat)
    return "".join(src), "".join(dst)


def normalize_label(c: Column | str) -> Column:
    """A label as it is compared: plain quotes, no dashes, ligatures, accents or case, single blanks, ASCII only."""
    x = F.translate(_col(c), QUOTES + DASHES, "'" * len(QUOTES) + " " * len(DASHES))
    for mark, letters in LIGATURES:
        x = F.replace(x, F.lit(mark), F.lit(letters))
    x = F.regexp_replace(F.translate(x, *fold_table()), "[^\\x00-\\x7F]", "")
    return F.trim(F.regexp_replace(F.lower(x), "\\s+", " "))


def match_key(c: Column | str) -> Column:
    """The key by which labels are looked up: no text in parentheses, a plural s off every word of over three letters."""
    ws = F.split(normalize_label(F.regexp_replace(_col(c), "\\([^)]*\\)", " ")), " ")
    return F.array_join(F.transform(ws, lambda w: F.regexp_replace(w, "^(.{2,}[^s])s$", "$1")), " ")


def verify_key(c: Column | str) -> Column:
    """The key by which matches are verified: no parenthesis at the end, a final s off every word."""
    ws = F.split(normalize_label(F.regexp_replace(_col(c), "\\s*\\([^)]*\\)\\s*$", "")), " ")
    return F.array_join(F.transform(ws, lambda w: F.regexp_replace(w, "s$", "")), " ")


def topic_key(c: Column | str) -> Column:
    """The key of a topic: generic last words off, the last word in the singular."""
    x = F.regexp_replace(normalize_label(c), f"(\\s+({'|'.join(GENERIC_TAIL)}))+$", "")
    return (
        F.when(x.rlike("[^ ]{2,}ies$"), F.regexp_replace(x, "ies$", "y"))
        .when(x.rlike("(ses|xes|ches|shes)$"), F.regexp_replace(x, "es$", ""))
        .when(x.rlike("[^ s]{3,}s$") | x.rlike("[^ ]{2,}[^s]s$"), F.regexp_replace(x, "s$", ""))
        .otherwise(x)
    )


def spelling_key(c: Column | str) -> Column:
    """British spelling of -ize and -yze words."""
    x = F.regexp_replace(normalize_label(c), "iz(e|ed|es|ing|ation|ations)\\b", "is$1")
    return F.regexp_replace(x, "yz(e|ed|es|ing)\\b", "ys$1")


def mint_id(prefix: str, source: Column | str, key: Column | str) -> Column:
    """prefix and the first 12 hex digits of the SHA-1 of ``source|key``."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat(_col(source), F.lit("|"), _col(key))), 1, 12))


def short_hash(c: Column | str, digits: int = 12) -> Column:
    return F.substring(F.sha1(_col(c)), 1, digits)


def split_multi(c: Column | str) -> Column:
    """Distinct, trimmed, non-blank parts between line breaks or bars."""
    return F.array_distinct(F.filter(F.transform(F.split(_col(c), "[\\n\\r|]"), lambda x: F.trim(x)), lambda x: x != ""))


def uri_tail(c: Column | str) -> Column:
    return F.element_at(F.split(F.regexp_replace(_col(c), "/+$", ""), "/"), -1)


def url_decoded(c: Column | str) -> Column:
    """Percent signs decoded; a plus stays one, and text that can't be decoded stays as it is."""
    x = _col(c)
    return F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x)


def humanize(c: Column | str) -> Column:
    """A slug as a title: underscores to blanks, first letter large."""
    x = F.trim(F.replace(url_decoded(c), F.lit("_"), F.lit(" ")))
    return F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 100000))


def literal_label(c: Column | str) -> Column:
    """The text of an RDF literal: no final dot, language tag or quotes."""
    x = F.regexp_replace(F.trim(_col(c)), "\\s+\\.$", "")
    return F.trim(url_decoded(F.regexp_replace(F.regexp_replace(x, "@[^@]*$", ""), '^"+|"+$', "")))


def to_float(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).try_cast("double")


def whole_at_least_one(c: Column | str) -> Column:
    """A count given as text: whole, at least one; anything unreadable counts one."""
    return F.greatest(F.coalesce((F.col(c) if isinstance(c, str) else c).try_cast("double").cast("long"), F.lit(1)), F.lit(1))


def tech_tokens(c: Column | str) -> Column:
    """Tokens of lower-case letters, digits and + . #, in order."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(TECH_TOKEN), 0)


def prose_tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(PROSE_TOKEN), 0)


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of n tokens, joined by blanks."""

    def runs(ts: Column) -> Column:
        heads = F.slice(ts, F.lit(1), F.greatest(F.size(ts) - (n - 1), F.lit(0)))
        return F.transform(heads, lambda w, i: F.concat_ws(" ", w, *[F.get(ts, i + k) for k in range(1, n)]))

    return let(tokens, runs)


def ngrams_to(tokens: Column, most: int) -> Column:
    return let(tokens, lambda ts: F.concat(*[ngrams(ts, n) for n in range(1, most + 1)]))


def clean_title(c: Column | str, stop_words: tuple[str, ...]) -> Column:
    """A posting's title as a bare role: the first segment with a word that is no marker, those words only."""
    x = F.regexp_replace(_col(c), "\\([^)]*\\)", " ")
    x = F.regexp_replace(x, GENDER_MARK, " ")
    segments = F.split(x, TITLE_PARTS)
    edge = f"^[{EDGE_SIGNS}]+|[{EDGE_SIGNS}]+$"
    words = F.transform(segments, lambda s: F.filter(F.transform(F.split(F.trim(s), "\\s+"), lambda w: F.regexp_replace(w, edge, "")), lambda w: (w != "") & ~normalize_label(w).isin(*stop_words)))
    return F.coalesce(F.array_join(F.get(F.filter(words, lambda ws: F.size(ws) > 0), F.lit(0)), " "), F.lit(""))


# Markers of seniority in a title.
SENIORITY = "(?i)\\b(senior|sr|junior|jr|lead|principal|staff|mid|middle|entry[- ]?level|intern|i{1,3}|iv|v)\\b\\.?"


def without_seniority(c: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(_col(c), SENIORITY, " "), "\\s+", " "), "^[ \\-/,]+|[ \\-/,]+$", "")


def html_text(c: Column | str) -> Column:
    """Readable text of markup: scripts and tags gone, breaks and block ends as new lines, entities decoded."""
    x = F.regexp_replace(_col(c), "(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<noscript[^>]*>.*?</noscript>", " ")
    x = F.regexp_replace(x, "(?i)<br\\s*/?>|</(p|div|li|h[1-6]|tr)>", "\n")
    x = F.regexp_replace(x, "<[^>]+>", " ")
    for mark, ch in ENTITIES:
        x = F.replace(x, F.lit(mark), F.lit(ch))
    x = F.regexp_replace(F.regexp_replace(x, "[ \\t\\r\\f\\x0B]+", " "), " *\\n *", "\n")
    return F.regexp_replace(F.regexp_replace(x, "\\n{3,}", "\n\n"), "^\\s+|\\s+$", "")


def json_ld(c: Column | str) -> Column:
    """The JSON-LD blocks of a page, as variants; unreadable ones are left out."""
    blocks = F.regexp_extract_all(_col(c), F.lit("(?is)<script[^>]*application/ld\\+json[^>]*>(.*?)</script>"), 1)
    read = F.filter(F.transform(blocks, lambda b: F.try_parse_json(b)), lambda v: v.isNotNull())
    # a block may be a list, or hold its parts under @graph
    listed = lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))
    inner = lambda v: F.coalesce(F.try_variant_get(v, "$['@graph']", "array<variant>"), F.array(v))
    return F.flatten(F.transform(F.flatten(F.transform(read, listed)), inner))


@F.pandas_udf(ArrayType(StringType()))
def _absolute(bases: pd.Series, links: pd.Series) -> pd.Series:
    return pd.Series([list(dict.fromkeys(urljoin(b or "", h) for h in hs)) for b, hs in zip(bases, links)])


def page_links(c: Column | str, base: Column | str | None = None) -> Column:
    """Distinct targets of links, without fragments, in order; absolute where the page's own address is given."""
    if base is not None:
        return _absolute(_col(base), page_links(c))
    return F.array_distinct(F.filter(F.transform(F.regexp_extract_all(_col(c), F.lit("(?i)href\\s*=\\s*[\"']([^\"']+)[\"']"), 1), lambda h: F.regexp_replace(h, "#.*$", "")), lambda h: h != ""))


def unmangled(c: Column | str) -> Column:
    """UTF-8 that was read as Latin-1, repaired; text that isn't such stays."""
    x = _col(c)
    again = F.try_validate_utf8(F.encode(x, "ISO-8859-1").cast("string"))
    fits = ~x.rlike("[^\\x00-\\xFF]")
    return F.when(x.rlike("[ÃÂ]") & fits, F.coalesce(again, x)).otherwise(x)


def is_noise(c: Column | str) -> Column:
    """Labels that can't be one: blank, without a letter, opening with a bracket, or with a stray comma."""
    x = F.trim(_col(c))
    return ~x.rlike("[A-Za-z]") | x.rlike("^[(\\[{]") | x.contains(" ,")


# What stands for a name that was taken out of a corpus.
ANONYMISED = "^<[A-Z_]+>$"


def bio_spans(tokens: Column, tags: Column) -> Column:
    """Spans of BIO-tagged tokens: B opens, I goes on if one is open, anything else closes; anonymised tokens say nothing."""
    pairs = F.arrays_zip(tokens.alias("t"), tags.alias("g"))
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))

    def step(acc: Column, p: Column) -> Column:
        tag = F.coalesce(p["g"], F.lit("O"))
        closed = F.when(acc["open"] != "", F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"])
        begins, goes = tag.startswith("B"), tag.startswith("I") & (acc["open"] != "")
        word = F.regexp_replace(F.coalesce(p["t"], F.lit("")), ANONYMISED, "")
        return F.struct(
            F.when(goes, acc["done"]).otherwise(closed).alias("done"),
            F.when(begins, word).when(goes, F.trim(F.concat_ws(" ", acc["open"], word))).otherwise(F.lit("")).alias("open"),
        )

    end = F.aggregate(pairs, start, step)
    return F.when(end["open"] != "", F.concat(end["done"], F.array(end["open"]))).otherwise(end["done"])


def is_protected(token: Column, lexicon: tuple[str, ...] = ()) -> Column:
    """Whether a token is a technical name: in the lexicon, an acronym, in camel case, with a digit, plus, hash or inner dot."""
    core = F.regexp_replace(token, "^[ ,.;:()\\[\\]{}\"'/’]+|[ ,.;:()\\[\\]{}\"'/’]+$", "")
    listed = F.lower(core).isin(*lexicon) if lexicon else F.lit(False)
    acronym = core.rlike("^[^a-zà-öø-ÿ]{2,}$") & core.rlike("[A-ZÀ-ÖØ-Þ]")
    return (core != "") & (listed | acronym | core.rlike("[a-z][A-Z]") | core.rlike("[0-9+#]") | core.rlike("\\.[^.]"))


def fully_protected(label: Column | str, lexicon: tuple[str, ...] = ()) -> Column:
    """Whether a label is a technical name as a whole."""
    x = F.trim(_col(label))
    ws = F.filter(F.split(x, "\\s+"), lambda w: w.rlike("[\\p{L}\\p{N}]"))
    listed = F.lower(x).isin(*lexicon) if lexicon else F.lit(False)
    return (x != "") & ((F.length(x) <= 2) | listed | ((F.size(ws) > 0) & F.forall(ws, lambda w: is_protected(w, lexicon))))


# How sentences open that describe a term where its name was wanted.
SENTENCE_STARTS = ("je ", "j'", "nous ", "vous ", "il s'agit", "c'est ", "cela ")


def translation_verdict(source: Column | str, output: Column | str, kept: Column | None = None, low: float = 0.30, high: float = 3.50) -> Column:
    """Why a translated label is unfit: empty, lost_protected_token, len_ratio, sentence_not_label; verbatim or '' if it is fit."""
    s, o = _col(source), _col(output)
    ratio = F.length(o) / F.greatest(F.length(s), F.lit(1))
    start = F.ltrim(F.lower(o))
    opens = F.lit(False)
    for words in SENTENCE_STARTS:
        opens = opens | start.startswith(words)
    clause = (F.size(F.split(F.trim(s), "\\s+")) <= 3) & F.rtrim(o).endswith(".") & (F.length(o) > 2 * F.length(s)) & ~s.contains(".")
    lost = o.rlike("Zt\\d+z") if kept is None else (~kept | o.rlike("Zt\\d+z"))
    return (
        F.when(F.trim(o) == "", "empty")
        .when(lost, "lost_protected_token")
        .when((ratio < low) | (ratio > high), "len_ratio")
        .when(opens | clause, "sentence_not_label")
        .when(normalize_label(o) == normalize_label(s), "verbatim")
        .otherwise("")
    )


def first_sentence(c: Column | str, most: int) -> Column:
    """The text up to ``most`` characters, cut after its last full sentence if that leaves over 40."""
    t = F.trim(F.regexp_replace(_col(c), "\\s+", " "))
    cut = F.substring(t, 1, most)
    dot = F.length(cut) - F.locate(" .", F.reverse(cut)) - 1
    has = F.locate(" .", F.reverse(cut)) > 0
    return F.when(F.length(t) <= most, t).when(has & (dot > 40), F.trim(F.substring(cut, F.lit(1), dot + 1))).otherwise(F.trim(cut))


def without_echo(label: Column | str, text: Column | str) -> Column:
    """A definition without quotes around it and without its label in front."""
    d = F.trim(F.regexp_replace(F.trim(_col(text)), '^"+|"+$', ""))
    lab = _col(label)
    rest = F.substring(d, F.length(lab) + 1, F.length(d))
    echoed = (lab != "") & F.lower(d).startswith(F.lower(lab)) & rest.rlike("^\\s*[:\\-–]")
    return F.when(echoed, F.trim(F.regexp_replace(rest, "^\\s*[:\\-–]\\s*", ""))).otherwise(d)


def numbered_picks(c: Column | str, n: Column | int, most: int = 15) -> Column:
    """The numbers from 1 to n that a text names, sorted, at most ``most``."""
    limit = F.lit(n) if isinstance(n, int) else n
    found = F.transform(F.regexp_extract_all(_col(c), F.lit("\\d+"), 0), lambda x: x.try_cast("int"))
    return F.slice(F.array_sort(F.array_distinct(F.filter(found, lambda x: (x >= 1) & (x <= limit)))), 1, most)


def tolerant_json(c: Column | str) -> Column:
    """A text as JSON, or the first braces in it; null if neither can be read."""
    x = _col(c)
    return F.coalesce(F.try_parse_json(x), F.try_parse_json(F.regexp_extract(x, "(?s)\\{.*\\}", 0)))


def clean_aliases(raw: Column | str, existing: Column, most_tokens: int = 4, most_chars: int = 40, most: int = 8) -> Column:
    """Aliases worth adding to the ``existing`` folded labels, in order, without repeats, variants and noise."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.array().cast("array<string>").alias("seen"))

    def step(acc: Column, a: Column) -> Column:
        n = normalize_label(a)
        bare = normalize_label(F.regexp_replace(a, "\\([^)]*\\)", ""))
        had = F.array_contains(existing, n) | F.array_contains(acc["seen"], n)
        variant = (bare != "") & (bare != n) & (F.array_contains(existing, bare) | F.array_contains(acc["seen"], bare))
        bad = (n == "") | had | variant | (F.size(F.split(a, "\\s+")) > most_tokens) | (F.length(a) > most_chars) | is_noise(a) | (F.size(acc["out"]) >= most)
        return F.when(bad, acc).otherwise(F.struct(F.concat(acc["out"], F.array(a)).alias("out"), F.concat(acc["seen"], F.array(n)).alias("seen")))

    parts = F.transform(F.split(_col(raw), "\\|"), lambda x: F.trim(x))
    return F.aggregate(parts, start, step, lambda acc: acc["out"])


def status_of_languages(en: Column | str, fr: Column | str) -> Column:
    e, f = F.trim(_col(en)) != "", F.trim(_col(fr)) != ""
    return F.when(e & f, "en_plus_fr").when(e, "en_native").when(f, "fr_only").otherwise("en_native")


def first_given(*columns: Column | str) -> Column:
    """The first that isn't blank, else ''."""
    return F.coalesce(*[F.nullif(F.trim(_col(c)), F.lit("")) for c in columns], F.lit(""))


def now_iso() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
