"""Filling fixed-capacity containers with items by the sum-of-squares rule.

Sizes are tokens of a public tokenizer.  An item goes where the sum over all fill levels of the squared number of
containers at that level becomes smallest, a new container being one of the choices; the numbers are kept in an array
indexed by level, so placing an item looks at levels, not at containers.  Of equal choices the fullest wins.  A full
container leaves the array.

Items are dealt by a hash of their id into shards of about ``shard_items`` items, each packed by one task, so no task
grows with the data and every shard leaves only its last containers unfilled.  Within a shard larger items come first.
An item larger than the capacity is split into full containers and a rest that is packed as an item; no other is split.
Null texts and texts without a token are put nowhere; repeated ids are packed once; capacities below 1 are left out.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from taxoloom.session import Scratch, spread

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern by which byte-level vocabularies of this family cut a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@lru_cache(maxsize=2)
def encoder(path: str):
    """The tokenizer of a rank file, one a process."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(texts: DataFrame, row_id: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(row_id, n_tokens) of whole texts."""

    @F.pandas_udf(LongType())
    def count(column: pd.Series) -> pd.Series:
        encode = encoder(tokenizer).encode_ordinary
        return column.map(lambda t: len(encode(t)) if t else 0)

    return spread(texts.select(row_id, text)).select(F.col(row_id), count(F.coalesce(F.col(text), F.lit(""))).alias("n_tokens"))


class Levels:
    """The state of one packing: how many containers are at each fill level, and which."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)
        self.at: dict[int, list[int]] = defaultdict(list)
        self.made = 0

    def place(self, size: int) -> int:
        """The container an item of 1 to capacity tokens goes into."""
        cap, count = self.capacity, self.count
        top = cap - size
        cost = 2 * (count[size : cap + 1] - count[: top + 1]) + 2
        cost[top] -= 2 * count[cap] + 1  # a full container counts no more
        cost[1:][count[1 : top + 1] == 0] = np.iinfo(np.int64).max
        cost[0] = 2 * count[size] + 1 if size < cap else 0
        level = top - int(np.argmin(cost[::-1]))
        if level:
            box = self.at[level].pop()
            count[level] -= 1
        else:
            box, self.made = self.made, self.made + 1
        if level + size < cap:
            self.at[level + size].append(box)
            count[level + size] += 1
        return box


def pack(sizes: DataFrame, capacities: DataFrame, row_id: str, size_id: str = "size_id", capacity: str = "capacity_tokens", shard_items: int = 20000, block: int = 200) -> DataFrame:
    """(size_id, shard, container, row_id, piece, n_tokens): what is in every container of every capacity.

    ``sizes`` has (row_id, n_tokens).  Capacities are a list kept by hand, read by the driver and dealt with in blocks.
    """
    spark = sizes.sparkSession
    kinds = dict(sizes.dtypes)[row_id], dict(capacities.dtypes)[size_id]
    items = Scratch(spark, "packing").cut(sizes.where("n_tokens > 0").groupBy(row_id).agg(F.max("n_tokens").alias("n_tokens")))
    shards = max(1, -(-items.count() // shard_items))
    boxes = [tuple(r) for r in capacities.where(F.col(capacity) >= 1).select(size_id, F.col(capacity).cast("int")).distinct().toLocalIterator()]
    dealt = None
    for at in range(0, max(1, len(boxes)), block):
        ids, caps = ([b[k] for b in boxes[at : at + block]] for k in (0, 1))
        each = F.explode(F.arrays_zip(F.lit(ids).cast(f"array<{kinds[1]}>").alias("i"), F.lit(caps).cast("array<int>").alias("c")))
        part = items.withColumn("shard", F.pmod(F.xxhash64(row_id), F.lit(shards)).cast("int")).withColumn("_b", each)
        part = part.select(row_id, "n_tokens", "shard", F.col("_b.i").alias(size_id), F.col("_b.c").alias("capacity"))
        dealt = part if dealt is None else dealt.unionByName(part)

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        cap = int(frame["capacity"].iloc[0])
        state = Levels(cap)
        frame = frame.sort_values(["n_tokens", row_id], ascending=[False, True], kind="stable")
        ids, numbers, piece_no, held = [], [], [], []
        rest = []
        for row, tokens in zip(frame[row_id], frame["n_tokens"]):
            whole, left = divmod(int(tokens), cap)
            for n in range(whole):
                ids.append(row), numbers.append(state.made), piece_no.append(n), held.append(cap)
                state.made += 1
            if left:
                rest.append((left, row, whole))
        rest.sort(key=lambda x: -x[0])
        for left, row, whole in rest:
            ids.append(row), numbers.append(state.place(left)), piece_no.append(whole), held.append(left)
        return pd.DataFrame({size_id: frame[size_id].iloc[0], "shard": int(frame["shard"].iloc[0]), "container": numbers, row_id: ids, "piece": piece_no, "n_tokens": held})

    out = f"`{size_id}` {kinds[1]}, shard int, container long, `{row_id}` {kinds[0]}, piece int, n_tokens long"
    return dealt.groupBy(size_id, "shard").applyInPandas(fill, out)
