"""Measures of a graph that a user brings as an edge list.

The graph of this library is one clique per row, so its measures are closed forms
over row counts (``graph``).  An edge list from elsewhere has no such shape.  Here
degrees are aggregated, triangles are closed in degree order, components come from a
distributed union-find.  Betweenness, closeness and risk clusters have closed forms
on cliques only and are refused otherwise.

An edge list is any frame with ``src`` and ``dst`` of one type.  Edges have no
direction, repeated ones count once, an edge from a node to itself is a loop, and
edges with a null end are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veilspark import constants as K
from veilspark.operators.graph import MEASURES
from veilspark.sources.stage import drop_stage, stage_path, staged

# A node is hot when it has more than one part in so many of all rows; hence there are fewer
# hot nodes than the number says, whatever the size of the graph.
HOT_PARTS = 5_000


class NotCliques(ValueError):
    """A measure with a closed form on cliques only was asked of another graph."""


def plain_edges(edges: DataFrame) -> DataFrame:
    """``src, dst`` with ``src <= dst``, each edge once, staged."""
    known = edges.select("src", "dst").dropna()
    return staged(known.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct())


def _ends(plain: DataFrame) -> DataFrame:
    """``node, loop``: every edge seen from each of its ends; a loop once."""
    loop = F.col("src") == F.col("dst")
    ends = F.when(loop, F.array("src")).otherwise(F.array("src", "dst"))
    return plain.select(F.explode(ends).alias("node"), loop.alias("loop"))


def _degrees(plain: DataFrame) -> DataFrame:
    """``node, others, loops``: neighbours besides the node itself, and loops."""
    return _ends(plain).groupBy("node").agg(
        F.count_if(~F.col("loop")).alias("others"), F.count_if("loop").alias("loops")
    )


def _attached(rows: DataFrame, key: str, facts: DataFrame, size: str, n_rows: int) -> DataFrame:
    """``rows`` with the facts ``node, ...`` of the node in ``key``.

    ``size`` says how many rows of a table of ``n_rows`` a node has.  The few hot nodes
    (their number is bounded) are broadcast; the others, none of which has a large
    part of the rows, meet by a shuffle.
    """
    hot = facts.filter(F.col(size) > n_rows / HOT_PARTS)
    cold = facts.filter(F.col(size) <= n_rows / HOT_PARTS)
    spot = F.col(key) == F.col("node")
    few = F.broadcast(hot)
    rest = rows.join(F.broadcast(hot.select("node")), spot, "left_anti")
    return rows.join(few, spot).drop("node").unionByName(rest.join(cold, spot).drop("node"))


def _triangles(plain: DataFrame, degrees: DataFrame, n_edges: int) -> DataFrame:
    """``node, triangles`` of the nodes that have any.

    Every edge points to its end of higher degree (ties by id), so no node points to
    more than the square root of twice the edges.  For each pointer the later ones of
    the same node travel along as one array; what is left of it after the
    intersection with the pointers of the other end closes a triangle.  A node that
    very many edges lead to stands late in the order and has few to offer.
    """
    known = degrees.select("node", F.col("others").alias("n"))
    lines = plain.filter("src != dst")
    at = _attached(lines, "src", known, "n", 2 * n_edges).withColumnRenamed("n", "n_src")
    at = _attached(at, "dst", known, "n", 2 * n_edges).withColumnRenamed("n", "n_dst")
    a = F.struct(F.col("n_src").alias("n"), F.col("src").alias("id"))
    b = F.struct(F.col("n_dst").alias("n"), F.col("dst").alias("id"))
    pointed = at.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high"))
    lists = staged(
        pointed.groupBy(F.col("low.id").alias("u"))
        .agg(F.transform(F.array_sort(F.collect_list("high")), lambda x: x["id"]).alias("to"))
    )
    open_ = (
        lists.select("u", "to", F.posexplode("to").alias("i", "v"))
        .select("u", "v", F.slice("to", F.col("i") + 2, F.size("to")).alias("later"))
        .filter(F.size("later") > 0)
    )
    own = lists.select(F.col("u").alias("v"), "to")
    closed = open_.join(own, "v").select("u", "v", F.array_intersect("later", "to").alias("w"))
    found = closed.filter(F.size("w") > 0)
    n = F.size("w").cast("long")
    corners = found.select(
        F.inline(
            F.concat(
                F.array(F.struct(F.col("u").alias("node"), n.alias("n")), F.struct(F.col("v").alias("node"), n.alias("n"))),
                F.transform("w", lambda x: F.struct(x.alias("node"), F.lit(1).cast("long").alias("n"))),
            )
        )
    )
    return corners.groupBy("node").agg(F.sum("n").alias("triangles"))


def edge_clustering(edges: DataFrame) -> DataFrame:
    """``node, degree, triangles, clustering`` of every node; a loop counts two in the degree
    and nothing elsewhere, and a node of fewer than two neighbours has clustering 0."""
    plain = plain_edges(edges)
    degrees = staged(_degrees(plain))
    closed = _triangles(plain, degrees, plain.count())
    t = F.coalesce("triangles", F.lit(0).cast("long"))
    d = F.col("others")
    return degrees.join(closed, "node", "left").select(
        "node", (d + 2 * F.col("loops")).alias("degree"), t.alias("triangles"),
        F.when(d > 1, 2.0 * t / (d * (d - 1))).otherwise(F.lit(0.0)).alias("clustering"),
    )


def _roots(plain: DataFrame) -> DataFrame:
    """``member, component_id`` by rounds of stars.

    First every node hands its smallest neighbour (or itself) to its larger
    neighbours, then to its smaller ones.  Each round is written and the one before it
    dropped; rounds end when the edges stay as they are.
    """
    spark = plain.sparkSession
    alone = plain.filter("src = dst").select(F.col("src").alias("member"), F.col("src").alias("component_id"))
    now = plain.filter("src != dst").select(F.col("dst").alias("a"), F.col("src").alias("b"))
    seen, last = None, []
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark["n"] == 0 or mark == seen:
            break
        seen = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        paths = [stage_path(spark) for _ in range(3)]  # minima are read three times, so they are staged
        least = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"), F.count("*").alias("n")), paths[0])
        up = _attached(both.filter("b > a"), "a", least, "n", 2 * mark["n"])
        mid = staged(up.select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct(), paths[1])
        least = staged(mid.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"), F.count("*").alias("n")), paths[2])
        down = _attached(mid, "a", least, "n", mark["n"]).filter("b != m")
        own = least.select(F.col("node").alias("a"), F.col("m").alias("b"))
        now = staged(down.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(own).distinct(), path := stage_path(spark))
        for old in [*paths, *last]:
            drop_stage(spark, old)
        last = [path]
    ends = now.select(F.col("a").alias("member"), F.col("b").alias("component_id"))
    heads = now.select(F.col("b").alias("member"), F.col("b").alias("component_id"))
    least = alone.unionByName(ends).unionByName(heads)
    return least.groupBy("member").agg(F.min("component_id").alias("component_id"))


def _components(plain: DataFrame) -> DataFrame:
    nodes = staged(_roots(plain))
    sizes = nodes.groupBy(F.col("component_id").alias("node")).agg(F.count("*").alias("size"))
    return _attached(nodes, "component_id", sizes, "size", nodes.count()).select(
        F.col("member").alias("node"), "component_id", "size"
    )


def edge_components(edges: DataFrame) -> DataFrame:
    """``node, component_id, size``: the smallest node that can be reached, and how many can."""
    return _components(plain_edges(edges))


def edge_stats(edges: DataFrame) -> DataFrame:
    """Nodes, edges, density, average clustering, connectedness: one row.

    A graph without edges has no nodes and is not connected.
    """
    plain = plain_edges(edges)
    clustered = edge_clustering(plain)
    n_edges = plain.count()
    n_parts = _roots(plain).select("component_id").distinct().count()
    n, e = F.col("nodes"), F.lit(n_edges).cast("long")
    return clustered.agg(F.count("*").alias("nodes"), F.avg("clustering").alias("mean")).select(
        n, e.alias("edges"),
        F.when(n > 1, 2.0 * e / (n * (n - 1))).otherwise(F.lit(0.0)).alias("density"),
        F.coalesce("mean", F.lit(0.0)).alias("average_clustering"), F.lit(n_parts == 1).alias("is_connected"),
    )


def uneven_components(edges: DataFrame) -> DataFrame:
    """``component_id, size, n_edges`` of the components that are no cliques."""
    plain = plain_edges(edges)
    parts = staged(_components(plain))
    rows = plain.filter("src != dst").select("src")
    homes = parts.select(F.col("node").alias("at"), "component_id", "size")
    # counted by node first, so a node of many edges moves as one row
    mine = rows.groupBy("src").count().join(homes, F.col("src") == F.col("at"))
    links = mine.groupBy("component_id").agg(F.first("size").alias("size"), F.sum("count").alias("n_edges"))
    return links.filter("n_edges != size * (size - 1) / 2")


def require_cliques(edges: DataFrame, what: str) -> None:
    """Raise ``NotCliques`` when a component of the edge list is no clique."""
    odd = uneven_components(edges).limit(1).collect()
    if odd:
        raise NotCliques(
            f"{what} needs a graph of cliques, but component {odd[0]['component_id']!r} has {odd[0]['size']} nodes "
            f"and {odd[0]['n_edges']} edges; edge_stats, edge_components and the degree take any edge list"
        )


def edge_centrality(edges: DataFrame, measure: str = "degree") -> DataFrame:
    """``node, centrality`` of every node.

    Degree works on any edge list; betweenness and closeness raise ``NotCliques`` where
    their closed forms do not hold.  A single node has degree 1 and the other two 0.
    """
    if measure not in MEASURES:
        raise ValueError(f"measure is one of {MEASURES}")
    plain = plain_edges(edges)
    if measure != "degree":
        require_cliques(plain, measure)
    degrees = staged(_degrees(plain))
    n = degrees.count()
    loops = 2 * F.col("loops") if measure == "degree" else F.lit(0)
    raw = F.lit(0) if measure == "betweenness" else F.col("others") + loops
    alone = F.lit(1.0 if measure == "degree" else 0.0)
    return degrees.select("node", (raw / F.lit(float(n - 1)) if n > 1 else alone).cast("double").alias("centrality"))


def edge_top_central(edges: DataFrame, measure: str = "degree", limit: int = K.TOP_CENTRAL) -> DataFrame:
    """The ``limit`` most central nodes, ties by node."""
    return edge_centrality(edges, measure).orderBy(F.desc("centrality"), "node").limit(limit)


def edge_clusters(edges: DataFrame) -> DataFrame:
    """``cluster_id, size`` of the maximal cliques of two nodes or more; raises ``NotCliques``
    where cliques may overlap."""
    plain = plain_edges(edges)
    require_cliques(plain, "risk clusters")
    parts = _components(plain)
    return parts.filter("size >= 2").select(F.col("component_id").alias("cluster_id"), "size").distinct()
