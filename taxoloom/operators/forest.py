"""Parent-child links to hierarchies: root, depth, path and descendants of every node, with loops found.

The links of each partition are combined into a weighted forest of disjoint sets: every node points at the furthest
ancestor its partition knows, with the number of links up to it as its weight.  The forests of different partitions are
then merged by joining the roots of one with the offsets of the others; every merge doubles the reach of all pointers,
so a tree of depth d needs log2(d) merges however it is spread.  A merge in which no node reaches a root leaves only
nodes on or under loops; there the nodes that stay in the image of the doubled pointers are the loops' members.

A node hangs under one parent; if links give several, it hangs under the smallest id, and ``resolve_all`` gives the
others as roots of their own unless they have a place.  Links with a null or blank end are
left out, repeated links are one, a self-link is a loop of one.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxoloom.session import Scratch, bare


def directed_links(rows: DataFrame, parent: str, child: str, relation: str, down: str = "broader_than", up: str = "narrower_than") -> DataFrame:
    """(node, parent): one row per child of the links that ``relation`` calls down or up, whatever its case and blanks."""
    kind = F.lower(bare(relation))
    a, b = bare(parent), bare(child)
    return (
        rows.select(kind.alias("kind"), a.alias("a"), b.alias("b"))
        .where(F.col("kind").isin(down, up) & (F.col("a") != "") & (F.col("b") != ""))
        .select(F.when(F.col("kind") == down, F.col("b")).otherwise(F.col("a")).alias("node"), F.when(F.col("kind") == down, F.col("a")).otherwise(F.col("b")).alias("parent"))
        .groupBy("node")
        .agg(F.min("parent").alias("parent"))
    )


def resolve_all(rows: DataFrame, parent: str, child: str, relation: str) -> DataFrame:
    """As ``resolve``, from told links; a node that is only a further parent of others comes out as its own root."""
    links = directed_links(rows, parent, child, relation)
    found = resolve(links)
    kind, a, b = F.lower(bare(relation)), bare(parent), bare(child)
    ends = rows.select(kind.alias("kind"), F.explode(F.array(a, b)).alias("entity_id"), (a != "").alias("x"), (b != "").alias("y")).where(F.col("kind").isin("broader_than", "narrower_than") & F.col("x") & F.col("y"))
    more = ends.select("entity_id").distinct().join(found.select("entity_id"), "entity_id", "left_anti")
    return found.unionByName(more.select("entity_id", F.col("entity_id").alias("root_entity_id"), F.lit(0).alias("depth"), F.lit("none").alias("cycle_state")))


def _contract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Weighted union-find over the links of one partition."""
    up: dict[str, str] = {}
    for frame in frames:
        up.update(zip(frame["node"], frame["parent"]))
    far: dict[str, tuple[str, int]] = {}
    looped: set[str] = set()  # nodes on or under a loop of this partition keep their own link
    for start in up:
        trail, here, node = [], set(), start
        while node in up and node not in far and node not in here:
            trail.append(node)
            here.add(node)
            node = up[node]
        if node in here or node in looped:
            looped.update(trail)
            far.update((n, (up[n], 1)) for n in trail)
            continue
        root, offset = far.get(node, (node, 0))
        for n in reversed(trail):
            offset += 1
            far[n] = (root, offset)
    if far:
        yield pd.DataFrame({"node": list(far), "anc": [a for a, _ in far.values()], "off": [o for _, o in far.values()]})


def resolve(links: DataFrame) -> DataFrame:
    """(entity_id, root_entity_id, depth, cycle_state) of every node of (node, parent) links."""
    spark = links.sparkSession
    scratch = Scratch(spark, "forest")
    base = scratch.cut(links.select("node", "parent"))
    local = base.mapInPandas(_contract, "node string, anc string, off int")
    active = scratch.cut(local)
    done: list[DataFrame] = []
    left = -1
    while True:
        table = active
        for part in done:
            table = table.unionByName(part)
        far = table.select(F.col("node").alias("anc"), F.col("anc").alias("next"), F.col("off").alias("more"))
        step = scratch.cut(active.join(far, "anc", "left").select("node", F.coalesce("next", "anc").alias("anc"), (F.col("off") + F.coalesce("more", F.lit(0))).alias("off"), F.col("next").isNull().alias("end")))
        ended = step.where("end").drop("end")
        rest = step.where("not end").drop("end")
        still = rest.count()
        done.append(ended)
        scratch.drop(active)
        if still == 0 or still == left:
            break
        left, active = still, rest
    settled = done[0]
    for part in done[1:]:
        settled = settled.unionByName(part)
    roots = settled.select(F.col("anc").alias("node")).distinct()
    found = settled.select(F.col("node").alias("entity_id"), F.col("anc").alias("root_entity_id"), F.col("off").cast("int").alias("depth"), F.lit("none").alias("cycle_state")).unionByName(
        roots.select(F.col("node").alias("entity_id"), F.col("node").alias("root_entity_id"), F.lit(0).alias("depth"), F.lit("none").alias("cycle_state"))
    )
    if still == 0:
        return found
    loop = loop_states(scratch, base.join(rest.select("node"), "node", "left_semi"))
    return found.unionByName(loop)


def loop_states(scratch: Scratch, links: DataFrame) -> DataFrame:
    """on/below for nodes of which every one leads into a loop."""
    image = scratch.cut(links.select("node", F.col("parent").alias("anc")))
    size = -1
    while True:
        now = image.select("anc").distinct().count()
        if now == size:
            break
        size = now
        old = image
        far = old.select(F.col("node").alias("anc"), F.col("anc").alias("next"))
        image = scratch.cut(old.join(far, "anc").select("node", F.col("next").alias("anc")))
        scratch.drop(old)
    on = image.select(F.col("anc").alias("node")).distinct().withColumn("on", F.lit(True))
    return image.join(on, "node", "left").select(
        F.col("node").alias("entity_id"),
        F.lit("").alias("root_entity_id"),
        F.lit(-1).alias("depth"),
        F.when(F.col("on"), "on").otherwise("below").alias("cycle_state"),
    )


def paths(links: DataFrame, resolved: DataFrame | None = None) -> DataFrame:
    """(entity_id, root_entity_id, depth, path): ids from the root down to the node, of nodes free of loops.

    Parents are looked up by key; each look-up joins paths of doubled length, so log2(depth) joins make all paths.
    """
    spark = links.sparkSession
    scratch = Scratch(spark, "paths")
    resolved = scratch.cut(resolve(links) if resolved is None else resolved)
    sound = resolved.where("cycle_state = 'none'")
    start = links.join(sound.where("depth > 0").select(F.col("entity_id").alias("node")), "node", "left_semi")
    top = sound.agg(F.max("depth")).first()[0] or 0
    table = scratch.cut(start.select("node", F.col("parent").alias("anc"), F.array("parent").alias("trail")))
    reach = 1
    while reach < top:
        far = table.select(F.col("node").alias("anc"), F.col("anc").alias("next"), F.col("trail").alias("more"))
        new = scratch.cut(table.join(far, "anc", "left").select("node", F.coalesce("next", "anc").alias("anc"), F.when(F.col("more").isNull(), F.col("trail")).otherwise(F.concat("trail", "more")).alias("trail")))
        scratch.drop(table)
        table, reach = new, reach * 2
    trails = table.select(F.col("node").alias("entity_id"), "trail")
    return sound.join(trails, "entity_id", "left").select(
        "entity_id", "root_entity_id", "depth", F.concat(F.reverse(F.coalesce("trail", F.array().cast("array<string>"))), F.array("entity_id")).alias("path")
    )


def descendants(path_rows: DataFrame) -> DataFrame:
    """(entity_id, descendant_id, distance): every node below every node, from the paths."""
    return path_rows.select(F.posexplode("path").alias("at", "ancestor"), F.col("entity_id").alias("descendant_id"), "depth").where("at < depth").select(
        F.col("ancestor").alias("entity_id"), "descendant_id", (F.col("depth") - F.col("at")).cast("int").alias("distance")
    )
