"""Command line: builds or changes a knowledge base kept as Parquet tables in a folder."""

from __future__ import annotations

import argparse
import importlib
import os

from taxoloom.plans import pipeline
from taxoloom.session import session, ship
from taxoloom.sources.registry import Registry
from taxoloom.sources.sinks import report


def settings(path: str) -> dict[str, str]:
    """NAME=VALUE lines of a file; names that the environment has already keep their value there."""
    found = {}
    if os.path.isfile(path):
        with open(path, encoding="utf-8") as lines:
            for line in lines:
                name, sep, value = line.strip().partition("=")
                if sep and not name.startswith("#"):
                    found[name.strip()] = os.environ.get(name.strip(), value.strip().strip("\"'"))
    return found


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="taxoloom", description=__doc__)
    p.add_argument("--kb", required=True, help="folder with one Parquet table each")
    p.add_argument("--out", required=True, help="folder the stages write to")
    p.add_argument("--sources", help="module with a function registry() -> Registry")
    p.add_argument("--only", nargs="*", help="run these stages only")
    p.add_argument("--from", dest="start", help="first stage")
    p.add_argument("--to", dest="end", help="last stage")
    p.add_argument("--add", help="read one source and derive again what depends on it")
    p.add_argument("--remove", help="take one source out")
    p.add_argument("--list", action="store_true", help="list sources and stages and end")
    p.add_argument("--certificate", action="store_true", help="print the invariants")
    p.add_argument("--master", default=None, help="Spark master; that of the environment if left out")
    p.add_argument("--env", default=".env", help="file of settings for spark, NAME=VALUE")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    registry = importlib.import_module(args.sources).registry() if args.sources else Registry()
    if args.list:
        print("sources:", *[s.name for s in registry.sources])
        print("stages:", *pipeline.ORDER, *pipeline.ENRICHMENT)
        return 0
    conf = {k.removeprefix("SPARK_CONF_").lower(): v for k, v in settings(args.env).items() if k.startswith("SPARK_CONF_")}
    spark = session("taxoloom", **conf) if args.master is None else session("taxoloom", **conf, spark__master=args.master)
    ship(spark)
    kb = {t: spark.read.parquet(f"{args.kb}/{t}.parquet") for t in ("occupations", "skills", "hierarchy", "occupation_skill_relations", "concept_alignments", "unified_skills")}
    ctx = pipeline.Context(spark, registry, args.out)
    if args.add:
        kb = pipeline.add_source(ctx, kb, args.add)
    elif args.remove:
        kb = pipeline.remove_source(ctx, kb, args.remove)
    else:
        kb = pipeline.run(ctx, kb, pipeline.chosen(args.only, args.start, args.end))
    for note in ctx.notes:
        print(note)
    if args.certificate:
        print(report(pipeline.stage_qa(ctx, kb)["qa"], "Certificate"))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
