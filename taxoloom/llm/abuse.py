"""Scores for abusive, hateful or sexually explicit language.

The classifier is linear over hashed character n-grams, and every n-gram's feature is scaled by its naive Bayes log-count
ratio before the weights are fitted.  Texts are judged passage by passage, a passage being a sentence with its
neighbouring signs, and the text's score is that of its worst passage, so one sentence in a very long text is seen.
Labels are of whole texts, so the fit goes in rounds: the passage of an abusive text that looks worst stands for it, the
passages of clean texts for the rest, and each round chooses anew.  As annotators err, a text called abusive of which no
passage looks so, and a text called clean of which one surely does, are left out of the last rounds.

Before n-grams are taken, spelling tricks are undone: look-alike letters, letter substitutes (1 for i), letters drawn out
or spaced out, case.  The fit reads at most ``max_labelled`` labelled texts and ``max_chars`` characters of them, those
with the smallest hash of their id; the scoring reads every text whole.  Null and blank texts score 0; labels that are null are left out; a label told twice by
one annotator for one text counts once.  Without labels of both kinds every text scores 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taxoloom.llm.lookalike import canonical
from taxoloom.session import spread

BITS = 17
SIZES = (3, 4)
_CUT = re.compile(r"(?<=[.!?])[\"'»”’)\]]*\s+|\n+|<[^<>]*>")
_SPACED = re.compile(r"(?<!\w)(?:\w ){2,}\w(?!\w)")
_DRAWN = re.compile(r"(.)\1{2,}")
_DIGITS = re.compile(r"\d+")
_BLANKS = re.compile(r"[^\S\n]{2,}|[^\S\n ]")  # all runs of blanks but single spaces
#: Shorter passages are measured as if they had this many n-grams, so that a fragment needs as much evidence as a sentence.
SHORT = 30
#: Not fitted: a passage without evidence is clean, however rare clean passages are among the labelled.
BIAS = -2.0
#: Clean passages that score above this are hard to tell.
HARD = -4.0
_LEET = str.maketrans("013457@$!|", "oieastasil")
_ODD = re.compile(r"[\d@$!|]")
_RUN = re.compile(r"[\w@$!|*]+")
_CHUNK = re.compile(r"\S+")
_LETTER = re.compile(r"[^\W\d_]")


def unleet(text: str) -> str:
    """Letter substitutes inside words turned to letters: of a run with a letter about it, up to its last letter or digit.

    Only the runs around the signs in question are looked at.
    """
    out, last, done = [], 0, 0
    for m in _ODD.finditer(text):
        start = m.start()
        if start < done:
            continue
        while start and (text[start - 1].isalnum() or text[start - 1] in "_@$!|*"):
            start -= 1
        run = _RUN.match(text, start).group()
        done = start + len(run)
        k = len(run)
        while k and not run[k - 1].isalnum():
            k -= 1
        if k and _ODD.search(run, 0, k - 1) and _LETTER.search(_CHUNK.match(text, start).group()):
            out += [text[last:start], run[:k].translate(_LEET)]
            last = start + k
    return "".join(out) + text[last:] if out else text


def plain(text: str) -> str:
    """A text with spelling tricks undone, in lower case."""
    text = _BLANKS.sub(" ", canonical(text).lower())
    text = _SPACED.sub(lambda m: m.group().replace(" ", ""), text)
    text = unleet(text)
    return _DIGITS.sub("0", _DRAWN.sub(r"\1", text))


def passages(text: str | None) -> list[str]:
    """The sentences of a text, plain."""
    if not text:
        return []
    return [p.strip() for p in _CUT.split(plain(text).replace("&nbsp;", " ")) if p.strip()]


def ngram_pairs(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed n-grams of all parts, the part each is of)."""
    joined = "".join(f" {p} " for p in parts)
    ends = np.cumsum([len(p) + 2 for p in parts])
    chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(parts)), np.diff(np.concatenate([[0], ends])))
    codes, whose = [], []
    for n in SIZES:
        if len(chars) < n:
            continue
        h = np.full(len(chars) - n + 1, n, np.uint64)
        for j in range(n):
            h = (h ^ chars[j : len(chars) - n + 1 + j]) * np.uint64(0x100000001B3)
            h ^= h >> np.uint64(31)
        same = owner[: len(h)] == owner[n - 1 :]
        codes.append((h[same] & np.uint64((1 << BITS) - 1)).astype(np.int32))
        whose.append(owner[: len(h)][same])
    return (np.concatenate(codes), np.concatenate(whose)) if codes else (np.empty(0, np.int32), np.empty(0, np.int64))


def ngram_codes(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed n-grams of all parts, where each part begins)."""
    code, own = ngram_pairs(parts)
    order = np.argsort(own, kind="stable")
    return code[order], np.searchsorted(own[order], np.arange(len(parts)))


class Rows:
    """Passages as hashed n-grams, each passage's features of length one over the root of their number."""

    def __init__(self, parts: list[str]):
        step = 4000
        codes, starts, at = [], [], 0
        for i in range(0, len(parts), step):
            c, s = ngram_codes(parts[i : i + step])
            codes.append(c)
            starts.append(s + at)
            at += len(c)
        self.codes = np.concatenate(codes)
        self.starts = np.concatenate(starts)
        self.sizes = np.diff(np.concatenate([self.starts, [len(self.codes)]]))
        self.scale = 1 / np.sqrt(np.maximum(self.sizes, SHORT))

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.add.reduceat(w[self.codes], self.starts) * self.scale

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.codes, weights=np.repeat(g * self.scale, self.sizes), minlength=1 << BITS)


def log_ratio(rows: Rows, yes: np.ndarray, no: np.ndarray) -> np.ndarray:
    """Naive Bayes log-count ratio of every n-gram."""
    p, q = rows.back(yes / rows.scale) + 1, rows.back(no / rows.scale) + 1
    return np.log((p / p.sum()) / (q / q.sum()))


def logistic(rows: Rows, ratio: np.ndarray, target: np.ndarray, weight: np.ndarray, start: np.ndarray | float, l2: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights (ratio included) and the fixed bias, by accelerated gradient descent from ``start`` times the ratio."""
    v = np.full(1 << BITS, start) if np.isscalar(start) else start
    last, mom = v, 1.0
    total = weight.sum()
    rate = 4.0 / (1.0 + float(np.average(np.add.reduceat(ratio[rows.codes] ** 2, rows.starts) * rows.scale**2, weights=weight)))
    for _ in range(steps):
        nxt = (1 + np.sqrt(1 + 4 * mom * mom)) / 2
        y = v + (mom - 1) / nxt * (v - last)
        last, mom = v, nxt
        p = 1 / (1 + np.exp(-np.clip(rows.dot(ratio * y) + BIAS, -30, 30)))
        g = weight * (p - target) / total
        v = y - rate * (ratio * rows.back(g) + l2 * y)
    return ratio * v, BIAS


def fit(texts: list[str], labels: np.ndarray, trust: np.ndarray, rounds: int = 3, l2: float = 1e-6, steps: int = 50) -> tuple[np.ndarray, float]:
    """Weights and bias from whole texts, the share of annotators calling each abusive, and how many there were."""
    bag_of: list[tuple[int, str]] = [(i, p) for i, t in enumerate(texts) for p in passages(t)]
    if not bag_of or not (labels > 0.5).any() or not (labels <= 0.5).any():
        return np.zeros(1 << BITS), -30.0
    index: dict[str, int] = {}
    which = np.array([index.setdefault(p, len(index)) for _, p in bag_of])
    bag = np.array([i for i, _ in bag_of])
    rows = Rows(list(index))
    n, trust = len(index), np.minimum(trust, 3.0)
    bad = labels[bag] > 0.5
    clean = np.bincount(which[~bad], weights=trust[bag[~bad]], minlength=n)  # how often clean texts have the passage
    dirty = np.bincount(which[bad], weights=trust[bag[bad]], minlength=n)
    score = np.log(dirty + 0.1) - np.log(clean + 0.1)
    agreed = (labels > 0.5) & (trust > 1)
    left_out = (labels > 0.5) & ~agreed if agreed.sum() >= 10 else np.zeros(len(texts), bool)  # first those of whom two are sure
    w, b = np.zeros(1 << BITS), 0.0
    for turn in range(rounds):
        worst = np.full(len(texts), -np.inf)
        np.maximum.at(worst, bag, score[which])
        if turn:
            left_out = ((labels > 0.5) & (worst < np.where(trust > 1, -3.0, 0.0))) | ((labels <= 0.5) & (trust <= 1) & (worst > 4.0))
        witness = bad & (score[which] >= worst[bag] - 1e-9) & ~left_out[bag]
        yes = np.bincount(which[witness], weights=trust[bag[witness]], minlength=n)
        sound = ~bad & ~left_out[bag]
        no = np.bincount(which[sound], weights=trust[bag[sound]], minlength=n)
        yes, no = np.where(yes > no, yes, 0), np.where(yes > no, 0, np.maximum(no, yes))  # what clean texts have as often is clean
        target = (yes > 0).astype(float)
        weight = np.sqrt(yes + no)
        weight *= np.where(target > 0.5, 0.5 * weight[target <= 0.5].sum() / max(weight[target > 0.5].sum(), 1e-9), 1.0)  # the rare kind weighs half as much as the other in all
        ratio = log_ratio(rows, np.sqrt(yes), np.sqrt(no))
        w, b = logistic(rows, ratio, target, weight, 0.2, l2, steps)
        score = rows.dot(w) + b
    # the passages that are hard to tell are fitted much longer; whatever gets hard by that joins them
    parts = np.array(list(index), dtype=object)
    hard = np.zeros(n, bool)
    for _ in range(3):
        more = ((target > 0) | (score > HARD)) & ~hard
        if not more.any():
            break
        hard |= more
        w, b = logistic(Rows(parts[hard].tolist()), ratio, target[hard], weight[hard], w / np.where(ratio == 0, 1, ratio), l2, 6 * steps)
        score = rows.dot(w) + b
    return w, b


def scores(texts: list[str | None], w: np.ndarray, b: float, block: int = 500_000) -> np.ndarray:
    """The probability of the worst passage of each text; passages are measured together, about ``block`` characters at a time."""
    out = np.zeros(len(texts))
    parts: list[str] = []
    owner: list[int] = []
    size = 0

    def measure() -> None:
        codes, own = ngram_pairs(parts)
        sizes = np.bincount(own, minlength=len(parts))
        found = np.bincount(own, weights=w[codes], minlength=len(parts)) / np.sqrt(np.maximum(sizes, SHORT))
        np.maximum.at(out, owner, 1 / (1 + np.exp(-np.clip(found + b, -30, 30))))

    for i, t in enumerate(texts):
        mine = passages(t)
        parts += mine
        owner += [i] * len(mine)
        size += sum(map(len, mine))
        if size > block:
            measure()
            parts, owner, size = [], [], 0
    if parts:
        measure()
    return out


def train(documents: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, annotator: str, max_labelled: int = 20000, max_chars: int = 200_000_000) -> tuple[np.ndarray, float]:
    """Fits on labelled texts, at most ``max_labelled`` of them with ``max_chars`` characters in all."""
    told = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(doc_id, annotator).agg(F.max(label).alias("said"))
    votes = told.groupBy(doc_id).agg(F.avg("said").alias("share"), F.count("*").alias("n"))
    few = votes.orderBy(F.xxhash64(doc_id), doc_id).limit(max_labelled)  # at most this many rows of three numbers
    known = documents.where(F.col(text).isNotNull()).select(doc_id, F.col(text).alias("body")).join(F.broadcast(few), doc_id)
    so_far = F.sum(F.length("body")).over(Window.orderBy(F.xxhash64(doc_id), doc_id))  # over the labelled texts only
    rows = known.dropDuplicates([doc_id]).withColumn("_chars", so_far).where(F.col("_chars") <= max_chars).orderBy(doc_id).toPandas()
    return fit(rows["body"].tolist(), rows["share"].to_numpy(float), rows["n"].to_numpy(float))


def score(documents: DataFrame, model: tuple[np.ndarray, float], text: str) -> DataFrame:
    """The documents with their ``score``; the model is a fixed 2**BITS numbers and goes to the tasks as such."""
    w, b = model[0].astype(np.float32), model[1]

    @F.pandas_udf("double")
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(scores(part.tolist(), w, b))

    return spread(documents).withColumn("score", judge(F.coalesce(F.col(text), F.lit(""))))
