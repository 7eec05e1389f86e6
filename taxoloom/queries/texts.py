"""Queries on text functions and rule classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxoloom.functions import rules, text
from taxoloom.queries import sqltext as S
from taxoloom.session import load

# Words of a posting's title that name no role.
STOP_WORDS = ("cdi", "cdd", "stage", "alternance", "freelance", "interim", "urgent", "senior", "junior", "lead", "jeune", "recherche", "confirme", "h/f", "f/h", "nous", "recrutons", ":")


def _labels(spark: SparkSession, d: str) -> DataFrame:
    occ = load(spark, d, "occupations").select("entity_id", F.col("pref_label_en").alias("en"), F.col("pref_label_fr").alias("fr"))
    skl = load(spark, d, "skills").select("entity_id", F.col("pref_label_en").alias("en"), F.col("pref_label_fr").alias("fr"))
    return occ.unionByName(skl).distinct()


def normalize_labels(spark, d):
    return _labels(spark, d).select("entity_id", text.normalize_label("en").alias("en"), text.normalize_label("fr").alias("fr")).distinct()


def match_keys(spark, d):
    return _labels(spark, d).select("entity_id", text.match_key("en").alias("key")).distinct()


def verify_keys(spark, d):
    return _labels(spark, d).select("entity_id", text.verify_key("en").alias("key")).distinct()


def spelling_keys(spark, d):
    return _labels(spark, d).select("entity_id", text.spelling_key("en").alias("key")).distinct()


def mint_ids(spark, d):
    return load(spark, d, "skills").select("source", "source_id", text.mint_id("SKL_", "source", "source_id").alias("minted")).distinct()


def split_lists(spark, d):
    return load(spark, d, "skills").select("entity_id", F.explode(text.split_multi("alt_labels_en")).alias("label")).distinct()


def uri_parts(spark, d):
    return load(spark, d, "unified_skills").where("wikidata_url is not null").select("unified_id", text.uri_tail("wikidata_url").alias("qid")).distinct()


def weights_as_numbers(spark, d):
    rows = load(spark, d, "occupation_skill_relations").select("weight")
    return rows.groupBy("weight").agg(F.first(text.to_float("weight")).alias("number"), F.first(text.whole_at_least_one("weight")).alias("positions"), F.count("*").alias("n"))


def title_tokens(spark, d):
    return load(spark, d, "hellowork").select(F.explode(text.tech_tokens(text.normalize_label("title"))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def title_bigrams(spark, d):
    grams = text.ngrams(text.tech_tokens(text.normalize_label("title")), 2)
    return load(spark, d, "hellowork").select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))


def clean_titles(spark, d):
    return load(spark, d, "hellowork").select("url", text.clean_title("title", STOP_WORDS).alias("role")).distinct()


def strip_seniority(spark, d):
    return load(spark, d, "hellowork").select("url", text.without_seniority("title").alias("role")).distinct()


def html_to_text(spark, d):
    return load(spark, d, "documents").select("doc_id", F.sha1(text.html_text("text")).alias("digest"), F.length(text.html_text("text")).alias("chars"))


def noise_labels(spark, d):
    return load(spark, d, "unified_skills").select("unified_id", text.is_noise("primary_label_en").alias("noise")).distinct()


def protected_tokens(spark, d):
    ws = F.explode(F.split(F.coalesce("text", F.lit("")), " "))
    return load(spark, d, "documents").select(ws.alias("w")).where("w <> ''").groupBy("w").agg(F.count("*").alias("n")).where("n >= 5").select("w", "n", text.is_protected(F.col("w"), ("python", "java")).alias("protected"))


def mt_sanity(spark, d):
    rows = load(spark, d, "skills").select("entity_id", "pref_label_fr", "pref_label_en").distinct()
    return rows.select("entity_id", text.translation_verdict("pref_label_fr", "pref_label_en").alias("verdict")).distinct()


def first_sentences(spark, d):
    return load(spark, d, "documents").select("doc_id", text.first_sentence("text", 200).alias("opening"))


def language_status(spark, d):
    return _labels(spark, d).groupBy(text.status_of_languages("en", "fr").alias("status")).agg(F.count("*").alias("n"))


def first_given_label(spark, d):
    return _labels(spark, d).select("entity_id", text.first_given("en", "fr").alias("label")).distinct()


def bio_spans(spark, d):
    """Words of descriptions, tagged by a rule, as spans."""
    ws = F.filter(F.split(F.coalesce("description_en", F.lit("")), " "), lambda w: w != "")
    rows = load(spark, d, "skills").select("entity_id", ws.alias("ws")).distinct()
    tags = F.transform("ws", lambda w, i: F.when(w.rlike("^[A-Z]"), "B").when(F.length(w) > 6, "I").otherwise("O"))
    return rows.select("entity_id", F.explode(text.bio_spans(F.col("ws"), tags)).alias("span")).distinct()


def classify_skills(spark, d):
    rows = load(spark, d, "skills").where("coalesce(source, '') <> 'TAXONOMY'")
    return rows.groupBy(rules.category("pref_label_en", "hard_soft_provisional", "esco_skill_type").alias("category")).agg(F.count("*").alias("n"))


def classify_each(spark, d):
    rows = load(spark, d, "skills")
    return rows.select("entity_id", rules.category("pref_label_en", "hard_soft_provisional", "esco_skill_type").alias("category")).distinct()


def domain_facet(spark, d):
    return load(spark, d, "occupations").select("entity_id", rules.role_domain(text.first_given("pref_label_en", "pref_label_fr", "alt_labels_en"), "isco_code").alias("domain")).distinct()


def domain_histogram(spark, d):
    cat = rules.category("pref_label_en", "hard_soft_provisional", "esco_skill_type")
    return load(spark, d, "skills").groupBy(rules.domain_of_category(cat).alias("domain")).agg(F.count("*").alias("n"))


QUERIES = {
    f.__name__: f
    for f in (
        normalize_labels, match_keys, verify_keys, spelling_keys, mint_ids, split_lists, uri_parts, weights_as_numbers, title_tokens, title_bigrams, clean_titles, strip_seniority, html_to_text,
        noise_labels, protected_tokens, mt_sanity, first_sentences, language_status, first_given_label, bio_spans, classify_skills, classify_each, domain_facet, domain_histogram,
    )
}

_LAB = "(select entity_id, pref_label_en as en, pref_label_fr as fr from occupations union select entity_id, pref_label_en, pref_label_fr from skills)"
_PAD = f"(' ' || {S.norm('pref_label_en')} || ' ')"
_CATEGORY = f"""case when coalesce(hard_soft_provisional, '') = 'soft' then {S.rule_case(_PAD, rules.SOFT, "'soft_transversal'")}
  else coalesce({S.rule_case(_PAD, rules.FINE, 'null')}, {S.rule_case(_PAD, rules.COARSE, "case when coalesce(esco_skill_type, '') = 'knowledge' then 'knowledge_general' else 'other_hard' end")}) end"""
_TOKENS = f"regexp_extract_all({S.norm('title')}, '[a-z0-9+.#]+')"
_CODES = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in rules.CODE_DOMAINS.items()) + "}"
_CATS = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in rules.CATEGORY_DOMAINS.items()) + "}"
_HTML = "regexp_replace(coalesce(text, ''), '(?i)<br\\s*/?>|</(p|div|li|h[1-6]|tr)>', chr(10), 'g')"
_HTML = f"regexp_replace({_HTML}, '<[^>]+>', ' ', 'g')"
for _mark, _ch in text.ENTITIES:
    _HTML = f"replace({_HTML}, {S.q(_mark)}, {S.q(_ch)})"
_HTML = f"regexp_replace(regexp_replace(regexp_replace({_HTML}, '[ \\t\\r\\f\\v]+', ' ', 'g'), ' *\\n *', chr(10), 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')"
_HTML = f"regexp_replace({_HTML}, '^\\s+|\\s+$', '', 'g')"
_FLAT = "trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))"
_CORE = "regexp_replace(w, '^[ ,.;:()\\[\\]{}\"''/’]+|[ ,.;:()\\[\\]{}\"''/’]+$', '', 'g')"
SQL = {
    "normalize_labels": f"select distinct entity_id, {S.norm('en')} as en, {S.norm('fr')} as fr from {_LAB}",
    "match_keys": f"select distinct entity_id, {S.match_key('en')} as key from {_LAB}",
    "verify_keys": f"select distinct entity_id, {S.verify_key('en')} as key from {_LAB}",
    "spelling_keys": f"select distinct entity_id, regexp_replace(regexp_replace({S.norm('en')}, 'iz(e|ed|es|ing|ation|ations)\\b', 'is\\1', 'g'), 'yz(e|ed|es|ing)\\b', 'ys\\1', 'g') as key from {_LAB}",
    "mint_ids": f"select distinct source, source_id, {S.mint('SKL_', 'source', 'source_id')} as minted from skills",
    "split_lists": "select distinct entity_id, trim(p) as label from (select entity_id, unnest(regexp_split_to_array(coalesce(alt_labels_en, ''), '[\\n\\r|]')) as p from skills) where trim(p) <> ''",
    "uri_parts": "select distinct unified_id, string_split(regexp_replace(wikidata_url, '/+$', ''), '/')[-1] as qid from unified_skills where wikidata_url is not null",
    "weights_as_numbers": "select weight, any_value(try_cast(weight as double)) as number, any_value(greatest(coalesce(cast(trunc(try_cast(weight as double)) as bigint), 1), 1)) as positions, count(*) as n from occupation_skill_relations group by weight",
    "title_tokens": f"select token, count(*) as n from (select unnest({_TOKENS}) as token from hellowork) group by 1",
    "title_bigrams": f"select ts[i] || ' ' || ts[i + 1] as gram, count(*) as n from (select ts, unnest(range(1, len(ts))) as i from (select {_TOKENS} as ts from hellowork)) group by 1",
    "html_to_text": f"select doc_id, sha1({_HTML}) as digest, cast(length({_HTML}) as int) as chars from documents",
    "noise_labels": "select distinct unified_id, (not regexp_matches(coalesce(primary_label_en, ''), '[A-Za-z]') or regexp_matches(trim(coalesce(primary_label_en, '')), '^[(\\[{]') or contains(trim(coalesce(primary_label_en, '')), ' ,')) as noise from unified_skills",
    "protected_tokens": f"""select w, n, (core <> '' and (lower(core) in ('python', 'java') or (regexp_matches(core, '^[^a-zà-öø-ÿ]{{2,}}$') and regexp_matches(core, '[A-ZÀ-ÖØ-Þ]')) or regexp_matches(core, '[a-z][A-Z]') or regexp_matches(core, '[0-9+#]') or regexp_matches(core, '\\.[^.]'))) as protected
      from (select w, {_CORE} as core, count(*) as n from (select unnest(string_split(coalesce(text, ''), ' ')) as w from documents) where w <> '' group by 1, 2 having count(*) >= 5)""",
    "mt_sanity": f"""select distinct entity_id, case when trim(o) = '' then 'empty' when regexp_matches(o, 'Zt\\d+z') then 'lost_protected_token'
        when length(o) / greatest(length(s), 1) < 0.30 or length(o) / greatest(length(s), 1) > 3.50 then 'len_ratio'
        when {' or '.join(f"starts_with(ltrim(lower(o)), {S.q(w)})" for w in text.SENTENCE_STARTS)} or (len(regexp_split_to_array(regexp_replace(s, '^ +| +$', '', 'g'), '\\s+')) <= 3 and ends_with(rtrim(o), '.') and length(o) > 2 * length(s) and not contains(s, '.')) then 'sentence_not_label'
        when {S.norm('o')} = {S.norm('s')} then 'verbatim' else '' end as verdict
      from (select entity_id, coalesce(pref_label_fr, '') as s, coalesce(pref_label_en, '') as o from skills)""",
    "first_sentences": f"""select doc_id, case when length(t) <= 200 then t when dot > 40 then trim(substr(t, 1, dot)) else trim(substr(t, 1, 200)) end as opening
      from (select doc_id, t, 200 - nullif(instr(reverse(substr(t, 1, 200)), ' .'), 0) as dot from (select doc_id, {_FLAT} as t from documents))""",
    "language_status": f"select case when trim(coalesce(en, '')) <> '' and trim(coalesce(fr, '')) <> '' then 'en_plus_fr' when trim(coalesce(en, '')) <> '' then 'en_native' when trim(coalesce(fr, '')) <> '' then 'fr_only' else 'en_native' end as status, count(*) as n from {_LAB} group by 1",
    "first_given_label": f"select distinct entity_id, coalesce({S.blank_null('en')}, {S.blank_null('fr')}, '') as label from {_LAB}",
    "bio_spans": """with w as (select entity_id, ws, unnest(range(1, len(ws) + 1)) as i from (select distinct entity_id, list_filter(string_split(coalesce(description_en, ''), ' '), lambda x: x <> '') as ws from skills)),
      t as (select entity_id, i, ws, ws[i] as word, case when regexp_matches(ws[i], '^[A-Z]') then 'B' when length(ws[i]) > 6 then 'I' else 'O' end as tag from w),
      g as (select *, sum(case when tag <> 'I' then 1 else 0 end) over (partition by entity_id, ws order by i) as run from t)
      select distinct entity_id, string_agg(word, ' ' order by i) as span from g group by entity_id, ws, run having bool_or(tag = 'B')""",
    "classify_skills": f"select {_CATEGORY} as category, count(*) as n from skills where coalesce(source, '') <> 'TAXONOMY' group by 1",
    "classify_each": f"select distinct entity_id, {_CATEGORY} as category from skills",
    "domain_facet": f"""select distinct entity_id, coalesce({S.rule_case(S.norm('lab'), rules.ROLE_DOMAINS, 'null')}, {_CODES}[c], {_CODES}[substr(c, 1, 3)], {_CODES}[substr(c, 1, 2)], 'dom_cross') as domain
      from (select entity_id, trim(coalesce(isco_code, '')) as c, coalesce({S.blank_null('pref_label_en')}, {S.blank_null('pref_label_fr')}, {S.blank_null('alt_labels_en')}, '') as lab from occupations)""",
    "domain_histogram": f"select coalesce({_CATS}[category], 'dom_cross') as domain, count(*) as n from (select {_CATEGORY} as category from skills) group by 1",
}

_EDGE = f"^[{text.EDGE_SIGNS}]+|[{text.EDGE_SIGNS}]+$"


def clean_title_sql(c: str) -> str:
    """The bare role of a title, in SQL."""
    bare_title = f"regexp_replace(regexp_replace(coalesce({c}, ''), '\\([^)]*\\)', ' ', 'g'), {S.q(text.GENDER_MARK)}, ' ', 'g')"
    word = f"regexp_replace(w, {S.q(_EDGE)}, '', 'g')"
    stop = ", ".join(S.q(w) for w in STOP_WORDS)
    words = f"list_filter(list_transform(regexp_split_to_array(regexp_replace(s, '^ +| +$', '', 'g'), '\\s+'), lambda w: {word}), lambda v: v <> '' and {S.norm('v')} not in ({stop}))"
    return f"coalesce(array_to_string(list_filter(list_transform(regexp_split_to_array({bare_title}, {S.q(text.TITLE_PARTS)}), lambda s: {words}), lambda ws: len(ws) > 0)[1], ' '), '')"


SQL |= {
    "clean_titles": f"select distinct url, {clean_title_sql('title')} as role from hellowork",
}
