"""Protected tokens are put behind placeholders before a text is translated and put back afterwards."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

MASKED = StructType([StructField("text", StringType()), StructField("tokens", ArrayType(StringType()))])
# The spelling of a placeholder, which a translation leaves alone.
_PLACE = re.compile(r"Zt(\d+)z")
_TECH = re.compile(r"[a-z][A-Z]|[0-9+#]|\.[^.]|^[^a-z]{2,}$")


def mask(c: Column | str, lexicon: tuple[str, ...] = ()) -> Column:
    """(text, tokens): numbering needs the order of the text, so this is an Arrow function.

    Phrases of several words are put behind one placeholder, longer ones first.
    """
    known = frozenset(w.lower() for w in lexicon if " " not in w.strip())
    several = sorted((w.strip() for w in lexicon if " " in w.strip()), key=lambda w: (-len(w), w))
    phrase = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, several)) + r")(?!\w)", re.I) if several else None

    @F.pandas_udf(MASKED)
    def run(texts: pd.Series) -> pd.DataFrame:
        out, kept = [], []
        for text in texts.fillna(""):
            tokens, parts = [], []
            if phrase:

                def hide(m: re.Match, tokens: list[str] = tokens) -> str:
                    tokens.append(m.group())
                    return f"Zt{len(tokens) - 1}z"

                text = phrase.sub(hide, text)
            for w in text.split(" "):
                if _PLACE.search(w):
                    parts.append(w)
                    continue
                core = w.strip(" ,.;:()[]{}\"'/’")
                if core and (core.lower() in known or _TECH.search(core) and any(ch.isalpha() for ch in core)):
                    parts.append(w.replace(core, f"Zt{len(tokens)}z", 1))
                    tokens.append(core)
                else:
                    parts.append(w)
            out.append(" ".join(parts))
            kept.append(tokens)
        return pd.DataFrame({"text": out, "tokens": kept})

    return run(F.col(c) if isinstance(c, str) else c)


def unmask(text: Column | str, tokens: Column | str) -> Column:
    """(text, whole): tokens back in place; ``whole`` is false if one was lost."""
    kind = StructType([StructField("text", StringType()), StructField("whole", BooleanType())])

    @F.pandas_udf(kind)
    def run(texts: pd.Series, kept: pd.Series) -> pd.DataFrame:
        out, whole = [], []
        for t, ks in zip(texts.fillna(""), kept):
            ks = list(ks) if ks is not None else []
            found = {int(n) for n in _PLACE.findall(t)}
            out.append(_PLACE.sub(lambda m: ks[int(m[1])] if int(m[1]) < len(ks) else m[0], t))
            whole.append(found >= set(range(len(ks))))
        return pd.DataFrame({"text": out, "whole": whole})

    return run(F.col(text) if isinstance(text, str) else text, F.col(tokens) if isinstance(tokens, str) else tokens)
