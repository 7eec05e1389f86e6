"""What comes from outside: vectors, entailment, generated and translated text, web pages.

Each is an interface with a default that gives nothing, so every plan runs without models and network.  All who use a
provider take null for an answer: a missing entailment keeps a row, a missing text leaves a field blank.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
import urllib.robotparser
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import urljoin, urlparse

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoloom.functions.text import json_ld


class Embedding:
    """Vectors for texts.  The default has none; see ``similarity.tfidf`` for sparse ones that need no model."""

    def vectors(self, rows: DataFrame, text: str) -> DataFrame:
        return rows.withColumn("vec", F.lit(None).cast("array<float>"))


@dataclass
class KeptVectors(Embedding):
    """Vectors kept by text in a table; only texts that aren't kept go to ``make``."""

    kept: DataFrame
    make: Callable[[DataFrame], DataFrame] | None = None

    def vectors(self, rows: DataFrame, text: str) -> DataFrame:
        table = self.kept
        if self.make is not None:
            fresh = rows.select(F.col(text).alias("text")).distinct().join(self.kept.select("text"), "text", "left_anti")
            table = table.unionByName(self.make(fresh))
        return rows.join(table.select(F.col("text").alias(text), "vec"), text, "left")


class Entailment:
    """Scores for pairs of texts; the default gives null."""

    most_chars = 600

    def score(self, premise: Column, hypothesis: Column) -> Column:
        return F.lit(None).cast("double")

    def mutual(self, a: Column, b: Column) -> Column:
        """The smaller of both directions; null if either is."""
        x, y = F.substring(a, 1, self.most_chars), F.substring(b, 1, self.most_chars)
        one, two = self.score(x, y), self.score(y, x)
        return F.when(one.isNotNull() & two.isNotNull(), F.least(one, two))


@dataclass
class BatchEntailment(Entailment):
    """Scores from a function over batches of pairs."""

    model: Callable[[list[tuple[str, str]]], list[float]]

    def score(self, premise: Column, hypothesis: Column) -> Column:
        model = self.model

        @F.pandas_udf("double")
        def run(p: pd.Series, h: pd.Series) -> pd.Series:
            return pd.Series(model(list(zip(p.fillna(""), h.fillna("")))), dtype="float64")

        return run(premise, hypothesis)


@dataclass
class TextMaker:
    """Texts from a function over batches of prompts, tried again, and given up for good after an error that will stay.

    Once given up, a task asks the ``fallback``, a model at hand, or says nothing.
    """

    model: Callable[[list[str]], list[str]] | None = None
    tries: int = 3
    fallback: Callable[[list[str]], list[str]] | None = None

    def answers(self, prompt: Column) -> Column:
        model, tries, fallback = self.model, self.tries, self.fallback
        if model is None and fallback is None:
            return F.lit(None).cast("string")

        @F.pandas_udf("string")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            dead = model is None
            for prompts in batches:
                said, asked = None, prompts.fillna("").tolist()
                for n in range(0 if dead else tries):
                    try:
                        said = model(asked)
                        break
                    except PermissionError:
                        dead = True
                        break
                    except Exception:
                        time.sleep(min(2**n, 8) if n + 1 < tries else 0)
                if said is None and fallback is not None:
                    said = fallback(asked)
                yield pd.Series([None] * len(prompts) if said is None else said, dtype="object")

        return run(prompt)


@dataclass
class Fetcher:
    """Pages from the web, one by one from the driver; off unless it is asked for, and it never raises."""

    agent: str = "taxoloom"
    tries: int = 3
    wait: float = 1.0
    timeout: float = 20.0
    rules: dict[str, urllib.robotparser.RobotFileParser] = field(default_factory=dict)

    def get(self, url: str) -> str | None:
        for n in range(self.tries):
            try:
                with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": self.agent}), timeout=self.timeout) as r:
                    return r.read().decode("utf-8", "replace")
            except urllib.error.HTTPError as e:
                if e.code not in (429, 500, 502, 503, 504):
                    return None
            except (OSError, ValueError):
                pass
            time.sleep(self.wait * 2**n)
        return None

    def allowed(self, url: str) -> bool:
        parts = urlparse(url)
        site = f"{parts.scheme}://{parts.netloc}"
        if site not in self.rules:  # asked for once a site
            self.rules[site] = urllib.robotparser.RobotFileParser()
            self.rules[site].parse((self.get(f"{site}/robots.txt") or "").splitlines())
        return self.rules[site].can_fetch(self.agent, url)

    def crawl(self, seeds: list[str], links: Callable[[str, str], list[str]], budget: int, keep: Callable[[list[dict]], None], every: int = 20, done: set[str] | None = None, per_site: int | None = None) -> int:
        """Follows links from the seeds; what was read is handed on every few pages, so a break loses little.

        Pages ``done`` by an earlier run are not read again; ``per_site`` bounds the pages of one site.
        """
        seen, queue, batch, n = set(seeds) | set(done or ()), [s for s in seeds if s not in (done or ())], [], 0
        sites: dict[str, int] = {}
        while queue and n < budget:
            url = queue.pop(0)
            site = urlparse(url).netloc
            if per_site is not None and sites.get(site, 0) >= per_site:
                continue
            sites[site] = sites.get(site, 0) + 1
            page = self.get(url) if self.allowed(url) else None
            if page is None:
                continue
            n += 1
            batch.append({"url": url, "html": page})
            for target in links(url, page):
                target = urljoin(url, target)
                if target not in seen:
                    seen.add(target)
                    queue.append(target)
            if len(batch) >= every:
                keep(batch)
                batch = []
        if batch:
            keep(batch)
        return n


def lookup_batches(labels: list[str], ask: Callable[[list[str]], str | None], size: int = 50) -> list[dict]:
    """Answers of a knowledge base to batches of labels, as flat rows; batches without an answer are skipped."""
    rows = []
    for at in range(0, len(labels), size):
        answer = ask(labels[at : at + size])
        for b in json.loads(answer)["results"]["bindings"] if answer else []:
            rows.append({k: v.get("value") for k, v in b.items()})
    return rows


def label_query(labels: list[str], language: str, allowed: tuple[str, ...] = (), denied: tuple[str, ...] = ()) -> str:
    """A query for records named or also named as listed, of allowed classes and of no denied one."""
    names = " ".join(json.dumps(label, ensure_ascii=False) + f"@{language}" for label in labels)
    lines = [f"VALUES ?name {{ {names} }}", "{ ?item rdfs:label ?name . BIND(true AS ?exact) } UNION { ?item skos:altLabel ?name . BIND(false AS ?exact) }", "?item wikibase:sitelinks ?links ."]
    if allowed:
        lines.append(f"VALUES ?class {{ {' '.join(f'wd:{c}' for c in allowed)} }} ?item wdt:P31/wdt:P279* ?class .")
    lines += [f"FILTER NOT EXISTS {{ ?item wdt:P31 wd:{c} . }}" for c in denied]
    return "SELECT ?name ?item ?exact ?links WHERE { " + " ".join(lines) + " }"


def labels_of_ids(ids: list[str], ask: Callable[[list[str]], str | None], known: dict[str, dict], size: int = 180) -> dict[str, dict]:
    """Label, description and aliases of outside records, by id; what was asked before, found or not, is not asked again.

    An answer has one row a record, its aliases joined by bars.
    """
    out = dict(known)
    wanted = sorted(set(ids) - set(known))
    for at in range(0, len(wanted), size):
        part = wanted[at : at + size]
        answer = ask(part)
        if answer is None:
            continue  # not reached: asked again next time
        rows = {b["id"]["value"].rsplit("/", 1)[-1]: {k: v.get("value", "") for k, v in b.items() if k != "id"} for b in json.loads(answer)["results"]["bindings"]}
        out.update({i: rows.get(i, {}) for i in part})
    return out


def best_candidates(rows: DataFrame, key: str) -> DataFrame:
    """Each key's best candidate: an exact label before an alias, then the most linked, then the first."""
    return rows.groupBy(key).agg(F.min_by(F.struct(*[c for c in rows.columns if c != key]), F.struct(~F.col("exact"), -F.col("sitelinks"), F.col("ord"))).alias("x")).select(key, "x.*")


def postings_of(pages: DataFrame, html: str = "html") -> DataFrame:
    """(url, title, text) from pages: their JSON-LD posting, else heading and text if that is long enough."""
    from taxoloom.functions.text import html_text

    posting = F.get(F.filter(json_ld(html), lambda v: F.array_contains(F.coalesce(F.try_variant_get(v, "$['@type']", "array<string>"), F.array(F.try_variant_get(v, "$['@type']", "string"))), "JobPosting")), F.lit(0))
    told = pages.withColumn("_p", posting).withColumn("_t", html_text(html))
    title = F.coalesce(F.try_variant_get("_p", "$.title", "string"), html_text(F.regexp_extract(html, "(?is)<h1[^>]*>(.*?)</h1>", 1)))
    body = F.coalesce(html_text(F.try_variant_get("_p", "$.description", "string")), F.lit(""))
    return told.select("url", title.alias("title"), F.when(body != "", body).when(F.length("_t") > 200, F.col("_t")).alias("text")).where("coalesce(title, '') <> '' and text is not null")
