"""Graph operators over edge tables: components, cycles, reach, bounded search, the concept graph.

Iterations write their state to the shared folder and go on from there, so plans stay short and no executor's loss costs
more than a round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxoloom.operators.lookup import first_by
from taxoloom.session import Scratch


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, component): the smallest node of each node's component; edges with an unknown end don't count.

    Every round takes the smallest label among the neighbours and then the label's own label, so labels jump ahead.
    """
    scratch = Scratch(edges.sparkSession, "components")
    known = scratch.cut(nodes.select("node").where("node is not null").distinct())
    sound = edges.select("u", "v").where("u <> v").join(known.withColumnRenamed("node", "u"), "u", "left_semi").join(known.withColumnRenamed("node", "v"), "v", "left_semi")
    both = scratch.cut(sound.unionByName(sound.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = scratch.cut(known.withColumn("component", F.col("node")))
    while True:
        heard = both.join(labels.select(F.col("node").alias("u"), "component"), "u").groupBy(F.col("v").alias("node")).agg(F.min("component").alias("low"))
        hooked = labels.join(heard, "node", "left").select("node", "component", F.least("component", F.coalesce("low", "component")).alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("component").alias("further"))
        moved = scratch.cut(hooked.join(jump, "new").select("node", F.least("new", "further").alias("component"), (F.least("new", "further") < F.col("component")).alias("moved")))
        scratch.drop(labels)
        labels = moved
        if labels.where("moved").isEmpty():
            return labels.select("node", "component")


def cycle_members(edges: DataFrame) -> DataFrame:
    """(node): nodes that stay when nodes without a way in or without a way out are taken off until none is left."""
    scratch = Scratch(edges.sparkSession, "cycles")
    rest = scratch.cut(edges.select("u", "v").where("u is not null and v is not null").distinct())
    size = rest.count()
    while size:
        ins, outs = rest.select(F.col("v").alias("u")).distinct(), rest.select(F.col("u").alias("v")).distinct()
        new = scratch.cut(rest.join(ins, "u", "left_semi").join(outs, "v", "left_semi").select("u", "v"))
        scratch.drop(rest)
        rest, old = new, size
        size = rest.count()
        if size == old:
            break
    return rest.select(F.explode(F.array("u", "v")).alias("node")).distinct()


def reached(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, hops): everything below the roots over any number of parents, with the fewest hops."""
    scratch = Scratch(edges.sparkSession, "reach")
    links = scratch.cut(edges.select("u", "v").where("u is not null and v is not null").distinct())
    seen = scratch.cut(roots.select("node").distinct().withColumn("hops", F.lit(0)))
    front = seen
    while True:
        step = front.select(F.col("node").alias("u"), "hops").join(links, "u").groupBy(F.col("v").alias("node")).agg((F.min("hops") + 1).alias("hops"))
        front = scratch.cut(step.join(seen.select("node"), "node", "left_anti"))
        if front.isEmpty():
            return seen
        seen = seen.unionByName(front)


def search_two_levels(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, branch, depth): children and grandchildren of ordered roots.

    A node belongs to its shallowest branch, of equal ones to the earlier root, then to the smaller parent.  ``roots``
    has (node, ord).
    """
    start = roots.select("node", F.col("node").alias("branch"), "ord", F.lit(0).alias("depth"), F.lit("").alias("via"))
    one = start.select(F.col("node").alias("u"), "branch", "ord").join(edges, "u").select(F.col("v").alias("node"), "branch", "ord", F.lit(1).alias("depth"), F.col("u").cast("string").alias("via"))
    firsts = first_by(start.withColumn("node", F.col("node")).unionByName(one), ["node"], [F.col("depth"), F.col("ord"), F.col("via")])
    two = firsts.where("depth = 1").select(F.col("node").alias("u"), "branch", "ord").join(edges, "u").select(F.col("v").alias("node"), "branch", "ord", F.lit(2).alias("depth"), F.col("u").cast("string").alias("via"))
    return first_by(firsts.unionByName(two), ["node"], [F.col("depth"), F.col("ord"), F.col("via")]).select("node", "branch", "depth")


def prefix_parents(codes: DataFrame, code: str, root: str) -> DataFrame:
    """(code, parent): the code without its last sign if that is a code, else the root."""
    known = codes.select(F.col(code).alias("_p")).distinct()
    rows = codes.select(code).distinct().withColumn("_p", F.expr(f"substring({code}, 1, length({code}) - 1)"))
    joined = rows.join(known.withColumn("_has", F.lit(True)), "_p", "left")
    return joined.select(code, F.when(F.col("_has"), F.col("_p")).otherwise(root).alias("parent"))


def parent_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, parents): how many parents each node has, 0 included."""
    counts = edges.select("u", "v").distinct().groupBy(F.col("v").alias("node")).agg(F.count("*").alias("parents"))
    return nodes.select("node").distinct().join(counts, "node", "left").select("node", F.coalesce("parents", F.lit(0)).alias("parents"))


def remap(edges: DataFrame, members: DataFrame, nodes: DataFrame, columns: tuple[str, ...] = ("s", "t")) -> DataFrame:
    """Edge ends as unified ids: the unified record an entity is in, else itself if it is a node; else the edge goes.

    ``members`` has (entity, unified); an entity in several takes the smallest.
    """
    one = members.groupBy("entity").agg(F.min("unified").alias("unified"))
    ids = nodes.select(F.col("id").alias("_n")).distinct().withColumn("_is", F.lit(True))
    for c in columns:
        joined = edges.join(one.select(F.col("entity").alias(c), F.col("unified").alias("_u")), c, "left").join(ids.withColumnRenamed("_n", c), c, "left")
        edges = joined.withColumn(c, F.coalesce("_u", F.when(F.col("_is"), F.col(c)))).drop("_u", "_is").where(F.col(c).isNotNull())
    return edges


def distinct_edges(edges: DataFrame, keys: list[str], weight: str, order: str) -> DataFrame:
    """One edge a key, with the weight that came first."""
    return edges.groupBy(*keys).agg(F.min_by(weight, order).alias(weight))


def kept_between(edges: DataFrame, nodes: DataFrame, s: str = "s", t: str = "t") -> DataFrame:
    """Edges of which both ends are among the nodes."""
    ids = nodes.select("id").distinct()
    return edges.join(ids.withColumnRenamed("id", s), s, "left_semi").join(ids.withColumnRenamed("id", t), t, "left_semi")


def typed_triples(nodes: DataFrame, edges: DataFrame, base: str, classes: dict[str, str], properties: dict[str, str]) -> DataFrame:
    """(s, p, o): class, label and relation statements of a concept graph."""

    def iri(c: Column) -> Column:
        return F.concat(F.lit(f"<{base}"), c, F.lit(">"))

    kinds = F.create_map(*[F.lit(x) for kv in classes.items() for x in kv])
    props = F.create_map(*[F.lit(x) for kv in properties.items() for x in kv])
    text = F.concat(F.lit('"'), F.replace(F.replace(F.coalesce("label", F.lit("")), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    kind = nodes.select(iri(F.col("id")).alias("s"), F.lit("rdf:type").alias("p"), F.coalesce(F.try_element_at(kinds, F.col("kind")), F.lit("skos:Concept")).alias("o"))
    named = nodes.where("coalesce(label, '') <> ''").select(iri(F.col("id")).alias("s"), F.lit("skos:prefLabel").alias("p"), text.alias("o"))
    linked = edges.select(iri(F.col("s")).alias("s"), F.coalesce(F.try_element_at(props, F.col("type")), F.lit("skos:related")).alias("p"), iri(F.col("t")).alias("o"))
    return kind.unionByName(named).unionByName(linked)


def numbered(rows: DataFrame, order: str) -> DataFrame:
    """The rows with ``n``, their place from 1 on: sorted by ranges, counted by range, and numbered within it."""
    from pyspark.sql import Window as W

    scratch = Scratch(rows.sparkSession, "numbered")
    dealt = scratch.cut(rows.repartitionByRange(order).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.join(sizes.toDF("_p", "_m"), F.col("_p") < F.col("_part"), "left").groupBy("_part").agg(F.coalesce(F.sum("_m"), F.lit(0)).alias("_before"))  # one row a partition
    inner = dealt.join(before, "_part").withColumn("n", F.row_number().over(W.partitionBy("_part").orderBy(order)) + F.col("_before"))
    return inner.drop("_part", "_before")


def sunflower(nodes: DataFrame, order: str, step: float = 1.0) -> DataFrame:
    """(id, x, y): nodes on a spiral of golden angles in the given order."""
    ranked = numbered(nodes.select("id", order) if order != "id" else nodes.select("id"), order)
    angle = F.col("n") * 2.399963229728653
    return ranked.select("id", F.round(step * F.sqrt("n") * F.cos(angle), 4).alias("x"), F.round(step * F.sqrt("n") * F.sin(angle), 4).alias("y"))
