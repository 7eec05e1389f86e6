"""Queries on the shapes taxonomies come in, and on streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from taxoloom.functions import text
from taxoloom.plans.providers import best_candidates
from taxoloom.queries import sqltext as S
from taxoloom.session import load
from taxoloom.sources import loaders, readers
from taxoloom.streaming import postings


def level_codes(spark, d):
    """Regions and nations as two levels of one tree."""
    rows = load(spark, d, "nation").join(load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = rows.withColumns({"a": F.concat(F.lit("R"), "r_regionkey"), "b": F.concat(F.lit("N"), "n_nationkey")})
    return loaders.levels(rows, [("a", "r_name"), ("b", "n_name")]).select("code", "label", F.col("level").cast("long").alias("level"))


def scoped_codes(spark, d):
    return loaders.scoped(load(spark, d, "occupations"), "isco_code", ("25", "35", "133")).select("entity_id", "isco_code").distinct()


def needed_skills(spark, d):
    rel = load(spark, d, "occupation_skill_relations").select("occupation_entity_id", F.col("skill_entity_id").alias("entity_id"))
    occ = load(spark, d, "occupations").where("source = 'ESCO'").select(F.col("entity_id").alias("occupation_entity_id"))
    master = load(spark, d, "skills").where("source = 'ESCO'").select("entity_id", F.lit("master").alias("origin")).distinct()
    coll = load(spark, d, "skills").where("source in ('ESCO', 'ECF')").select("entity_id", F.lit("collection").alias("origin")).distinct()
    return loaders.needed_skills(rel, occ, master, coll, "occupation_entity_id", "entity_id")


def rated_rows(spark, d):
    rows = load(spark, d, "occupation_skill_relations").dropDuplicates(["rel_id"])
    return loaders.rated(rows, "relation_type", "weight", "demand", 3.0).groupBy("source").agg(F.count("*").alias("n"))


def pooled_skills(spark, d):
    files = [(load(spark, d, "skills").where(F.col("source") == s), "source_id", "pref_label_en") for s in ("ESCO", "ONET", "ROME")]
    return loaders.pooled_skills(files)[0].select("norm", F.col("file").cast("long").alias("file"))


def texts_in_order(spark, d):
    rows = load(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("string").alias("p"), "l_returnflag")
    return loaders.texts_in_order(rows, ["l_orderkey"], "l_returnflag", "p")


def mapped_codes(spark, d):
    table = {"2511": "analyst", "2512": "developer", "3511": "operator"}
    return loaders.mapped_codes(load(spark, d, "occupations"), "isco_code", table, "role").groupBy("role").agg(F.countDistinct("entity_id").alias("n"))


def spelling_groups(spark, d):
    files = [(load(spark, d, "skills").where(F.col("source") == s), "pref_label_en") for s in ("ESCO", "KAGGLE")]
    return loaders.spellings(files).select("key", F.size("alts").cast("long").alias("others"))


def json_counts(spark, d):
    """A number out of the events' JSON."""
    return load(spark, d, "events").groupBy("event_type").agg(F.sum(F.try_variant_get(text.tolerant_json("props"), "$.k", "long")).alias("total"))


def alias_keys(spark, d):
    rows = load(spark, d, "skills").where("source = 'KAGGLE'").select("entity_id", "pref_label_en", F.regexp_replace(F.coalesce("alt_labels_en", F.lit("")), " \\| ", ",").alias("aliases"))
    return readers.alias_index(rows, "pref_label_en", "aliases", "entity_id").select("key")


def best_candidate(spark, d):
    """Events as candidates of users: exact ones first, then by value, then by time."""
    rows = load(spark, d, "events").select("user_id", F.col("event_id").alias("cand"), (F.col("event_type") == "purchase").alias("exact"), F.col("value").alias("sitelinks"), F.col("event_id").alias("ord"))
    return best_candidates(rows, "user_id").select("user_id", "cand")


def stream_last_postings(spark, d):
    """Postings read as a stream, each url once within the watermark."""
    schema = load(spark, d, "hellowork").schema
    import os

    path = f"{d}/hellowork.parquet"
    folder = path if os.path.isdir(path) else d
    glob = "*.parquet" if os.path.isdir(path) else "hellowork.parquet"
    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder).withColumn("at", F.col("retrieved_at").cast("timestamp"))
    name = f"postings_{uuid.uuid4().hex}"
    postings.run_to_end(postings.once_each(stream.where("url is not null"), ["url"], "at", "4000 days").select("url"), name)
    return spark.table(name).distinct()


def stream_daily_events(spark, d):
    """Events per day and type, as a stream that has ended."""
    import os

    path = f"{d}/events.parquet"
    folder, glob = (path, "*.parquet") if os.path.isdir(path) else (d, "events.parquet")
    stream = spark.readStream.schema(load(spark, d, "events").schema).option("pathGlobFilter", glob).parquet(folder).withColumn("at", F.col("ts").cast("timestamp"))
    name = f"daily_{uuid.uuid4().hex}"
    postings.run_to_end(postings.windowed_demand(stream, "at", ["event_type"]), name, "complete")
    return spark.table(name).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


QUERIES = {
    f.__name__: f
    for f in (level_codes, scoped_codes, needed_skills, rated_rows, pooled_skills, texts_in_order, mapped_codes, spelling_groups, json_counts, alias_keys, best_candidate, stream_last_postings, stream_daily_events)
}
_SPELL = f"regexp_replace(regexp_replace({S.norm('label')}, 'iz(e|ed|es|ing|ation|ations)\\b', 'is\\1', 'g'), 'yz(e|ed|es|ing)\\b', 'ys\\1', 'g')"
SQL = {
    "level_codes": "select 'R' || r_regionkey as code, r_name as label, 1::bigint as level from region union all select 'N' || n_nationkey, n_name, 2 from nation",
    "scoped_codes": "select distinct entity_id, isco_code from occupations where starts_with(isco_code, '25') or starts_with(isco_code, '35') or starts_with(isco_code, '133')",
    "needed_skills": """with l as (select skill_entity_id as e from occupation_skill_relations where occupation_entity_id in (select entity_id from occupations where source = 'ESCO')), c as (select entity_id from skills where source in ('ESCO', 'ECF')), m as (select entity_id from skills where source = 'ESCO')
      select distinct entity_id, case when entity_id in (select entity_id from m) then 'master' else 'collection' end as origin from c where entity_id in (select e from l) or entity_id in (select entity_id from c)""",
    "rated_rows": "select source, count(*) as n from (select distinct on (rel_id) * from occupation_skill_relations) where relation_type = 'demand' and try_cast(weight as double) >= 3 group by 1",
    "pooled_skills": f"select norm, cast(min(file) as bigint) as file from (select {S.norm('pref_label_en')} as norm, case source when 'ESCO' then 0 when 'ONET' then 1 else 2 end as file from skills where source in ('ESCO', 'ONET', 'ROME')) where norm <> '' group by 1",
    "texts_in_order": "select l_orderkey, string_agg(trim(l_returnflag), ' ' order by l_linenumber, trim(l_returnflag)) as text from lineitem where trim(coalesce(l_returnflag, '')) <> '' group by 1",
    "mapped_codes": "select case isco_code when '2511' then 'analyst' when '2512' then 'developer' else 'operator' end as role, count(distinct entity_id) as n from occupations where isco_code in ('2511', '2512', '3511') group by 1",
    "spelling_groups": f"select key, cast(count(distinct label) - 1 as bigint) as others from (select label, {_SPELL} as key from (select trim(pref_label_en) as label from skills where source in ('ESCO', 'KAGGLE')) where label <> '') where key <> '' group by 1",
    "json_counts": "select event_type, cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as total from events group by 1",
    "alias_keys": f"select distinct {S.norm('a')} as key from (select pref_label_en as a from skills where source = 'KAGGLE' union all select unnest(string_split(replace(coalesce(alt_labels_en, ''), ' | ', ','), ',')) from skills where source = 'KAGGLE') where {S.norm('a')} <> ''",
    "best_candidate": "select user_id, cand from (select user_id, event_id as cand, row_number() over (partition by user_id order by event_type = 'purchase' desc, value desc, event_id) as r from events) where r = 1",
    "stream_last_postings": "select distinct url from hellowork where url is not null",
    "stream_daily_events": "select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) as n from events group by 1, 2",
}
