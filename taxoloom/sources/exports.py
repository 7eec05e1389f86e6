"""A concept graph as files: N-Triples and JSON lines written by the executors, GraphML and HTML streamed by the driver.

The first two are for graphs of any size.  GraphML and the page are single documents for tools that read them whole.
"""

from __future__ import annotations

import html
import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_ntriples(triples: DataFrame, path: str, prefixes: dict[str, str]) -> None:
    """(s, p, o) as N-Triples, prefixed names written out."""
    s, p, o = F.col("s"), F.col("p"), F.col("o")
    for name, iri in prefixes.items():
        full = lambda c, name=name, iri=iri: F.when(c.startswith(f"{name}:"), F.concat(F.lit(f"<{iri}"), F.substring(c, F.lit(len(name) + 2), F.length(c)), F.lit(">"))).otherwise(c)
        s, p, o = full(s), full(p), full(o)
    triples.select(F.concat_ws(" ", s, p, o, F.lit(".")).alias("value")).write.mode("overwrite").text(path)


def write_json(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Nodes and edges as JSON lines, each with its kind."""
    rows = nodes.select(F.to_json(F.struct(F.lit("node").alias("is"), *nodes.columns)).alias("value")).unionByName(edges.select(F.to_json(F.struct(F.lit("edge").alias("is"), *edges.columns)).alias("value")))
    rows.write.mode("overwrite").text(path)


def write_graphml(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """One GraphML document; rows are streamed, so the driver holds a partition at a time."""
    esc = lambda v: html.escape("" if v is None else str(v), quote=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write('<?xml version="1.0" encoding="UTF-8"?>\n<graphml xmlns="http://graphml.graphdrawing.org/xmlns">\n')
        for kind, frame in (("node", nodes), ("edge", edges)):
            for c in frame.columns:
                out.write(f'<key id="{kind}_{esc(c)}" for="{kind}" attr.name="{esc(c)}" attr.type="string"/>\n')
        out.write('<graph edgedefault="directed">\n')
        for r in nodes.toLocalIterator():
            out.write(f'<node id="{esc(r["id"])}">' + "".join(f'<data key="node_{esc(c)}">{esc(r[c])}</data>' for c in nodes.columns if r[c] is not None) + "</node>\n")
        for r in edges.toLocalIterator():
            out.write(f'<edge source="{esc(r["s"])}" target="{esc(r["t"])}">' + "".join(f'<data key="edge_{esc(c)}">{esc(r[c])}</data>' for c in edges.columns if r[c] is not None) + "</edge>\n")
        out.write("</graph>\n</graphml>\n")


def write_page(placed: DataFrame, edges: DataFrame, path: str, most: int = 5000) -> None:
    """A backbone of at most ``most`` nodes, placed at (x, y), as one page without outside parts; a larger one is refused."""
    rows, links = placed.limit(most + 1).collect(), edges.limit(4 * most + 1).collect()
    if len(rows) > most or len(links) > 4 * most:
        raise ValueError(f"a page shows at most {most} nodes and {4 * most} edges; choose a backbone")
    nodes = {r["id"]: (r["x"], r["y"]) for r in rows}
    pairs = [(r["s"], r["t"]) for r in links if r["s"] in nodes and r["t"] in nodes]
    span = max([1.0, *(math.hypot(*p) for p in nodes.values())]) * 1.1
    lines = "".join(f'<line x1="{nodes[s][0]}" y1="{nodes[s][1]}" x2="{nodes[t][0]}" y2="{nodes[t][1]}"/>' for s, t in pairs)
    dots = "".join(f'<circle cx="{x}" cy="{y}" r="{span / 150:.4f}"><title>{html.escape(str(n))}</title></circle>' for n, (x, y) in nodes.items())
    style = json.dumps({"nodes": len(nodes), "edges": len(pairs)})
    with open(path, "w", encoding="utf-8") as out:
        out.write(f'<!doctype html><meta charset="utf-8"><title>Graph</title><script type="application/json">{style}</script><svg viewBox="{-span} {-span} {2 * span} {2 * span}" stroke="#999" stroke-width="{span / 1000:.4f}">{lines}{dots}</svg>')
