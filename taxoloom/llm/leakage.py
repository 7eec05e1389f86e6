"""Evaluation texts leaking into training text, by winnowing.

Texts become runs of words: letters and digits, without case, accents, punctuation, spacing and markup.  Of the hashes of
``k`` consecutive words the smallest in every window of ``least - k + 1`` is kept, so any span of at least ``least`` words
that two texts share has a kept hash in both.  The fingerprints of documents and items are two tables that are joined by
their hash; the planner broadcasts the items' if they are few and shuffles both if not.  The hits of a document and an
item are put together per diagonal, so a run of several hits is extended once, word by word to both sides, and counts if
it is long enough; the result is exact whatever the hashes do.  Only documents with hits are read a second time, and a
document that shares fingerprints with many items is extended against each of them as a row of its own.

Null, blank and short texts hold nothing and leak nothing; an item shorter than ``least`` words can't be found.  Items or
documents told twice come out once.  Empty tables give an empty result.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxoloom.session import Scratch, spread

_MARKUP = re.compile(r"</?[A-Za-z!][^<>]*>|&#?[A-Za-z0-9]{1,10};")
_MARKS = re.compile("[\u0300-\u036f\u200b-\u200d\u2060\ufeff\u00ad]+")
_WORD = re.compile(r"[^\W_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    """The words of a text as they are compared."""
    if not text:
        return []
    text = _MARKUP.sub(" ", text)
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
    return _WORD.findall(text.casefold())


def fingerprints(ws: list[str], k: int, least: int, known: dict[str, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) that winnowing keeps."""
    n = len(ws) - k + 1
    window = least - k + 1
    if n < window:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    known = {} if known is None else known
    if len(known) > 1_000_000:
        known.clear()
    codes = np.empty(len(ws), np.uint64)
    for i, w in enumerate(ws):
        code = known.get(w)
        if code is None:
            raw = w.encode()
            code = known[w] = (zlib.crc32(raw) << 32) | zlib.adler32(raw[::-1])
        codes[i] = code
    grams = np.zeros(n, np.uint64)
    for j in range(k):
        grams = (grams ^ codes[j : j + n]) * _STEP
        grams ^= grams >> np.uint64(29)
    at = np.unique(np.lib.stride_tricks.sliding_window_view(grams, window).argmin(axis=1) + np.arange(n - window + 1))
    return grams[at], at


def prints(texts: DataFrame, k: int, least: int) -> DataFrame:
    """(id, own, hash, at) of the fingerprints of (id, own, t)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for frame in frames:
            hashes, places = [], []
            for t in frame["t"]:
                h, at = fingerprints(words(t), k, least, known)
                hashes.append(h)
                places.append(at)
            n = [len(h) for h in hashes]
            out = frame[["id", "own"]].loc[frame.index.repeat(n)]
            yield out.assign(hash=np.concatenate([np.empty(0, np.uint64), *hashes]).view(np.int64), at=np.concatenate([np.empty(0, np.int64), *places]))

    return texts.mapInPandas(run, f"id {dict(texts.dtypes)['id']}, own long, hash long, at int")


def leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = 13, k: int = 5) -> DataFrame:
    """(doc_id, item_id, run_words): the longest common run of words of every document and item that share ``least``."""
    scratch = Scratch(documents.sparkSession, "leaks")

    def told(rows: DataFrame, key: str, body: str) -> DataFrame:
        # texts told under one id are kept apart by their own hash
        return rows.select(F.col(key).alias("id"), F.col(body).alias("t"), F.xxhash64(body).alias("own")).where("id is not null and t is not null")

    tests, source = told(items, item_id, item_text).distinct(), spread(told(documents, doc_id, text))
    listed = scratch.cut(prints(tests, k, least).select(F.col("id").alias("i"), F.col("own").alias("mine"), "hash", F.col("at").alias("there")))
    met = prints(source, k, least).join(listed, "hash").groupBy("id", "own", "i", "mine", (F.col("at") - F.col("there")).alias("shift"))
    hits = scratch.cut(met.agg(F.array_sort(F.collect_set("at")).alias("places")))
    asked = source.withColumnRenamed("t", "said").join(hits, ["id", "own"]).join(tests.select(F.col("id").alias("i"), F.col("own").alias("mine"), F.col("t").alias("test")), ["i", "mine"])
    asked = asked.select("id", "own", "said", F.col("i").alias("item"), "test", "shift", "places")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, ws = None, []
        tests_of: dict[str, list[str]] = {}
        for frame in frames:
            found = []
            for d, own, said, item, test, shift, places in frame.itertuples(index=False):
                if last != (d, own):  # rows of one document mostly come together
                    last, ws = (d, own), words(said)
                if test not in tests_of:
                    if len(tests_of) > 1000:
                        tests_of.clear()
                    tests_of[test] = words(test)
                best, end = 0, -1
                for at in places:
                    if at >= end:
                        n, start = extended(ws, int(at), tests_of[test], int(at - shift))
                        best, end = max(best, n), start + n
                if best >= least:
                    found.append((d, item, best))
            if found:
                yield pd.DataFrame(found, columns=[doc_id, item_id, "run_words"])

    kinds = dict(documents.dtypes)[doc_id], dict(items.dtypes)[item_id]
    out = asked.mapInPandas(run, f"`{doc_id}` {kinds[0]}, `{item_id}` {kinds[1]}, run_words int")
    return out.groupBy(doc_id, item_id).agg(F.max("run_words").alias("run_words"))


def extended(a: list[str], i: int, b: list[str], j: int) -> tuple[int, int]:
    """(words, start in a) of the longest common run of a and b in which a[i] stands beside b[j]; none if these differ."""
    if a[i] != b[j]:
        return 0, i
    x, y = i, j
    while x and y and a[x - 1] == b[y - 1]:
        x, y = x - 1, y - 1
    end, other = i + 1, j + 1
    while end < len(a) and other < len(b) and a[end] == b[other]:
        end, other = end + 1, other + 1
    return end - x, x
