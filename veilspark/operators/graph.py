"""The co-occurrence graph of a table and its statistics.

Edges never leave a row and all nodes of a row are linked, so the graph is one
clique per row that has entities.  Every statistic is therefore a closed form
over per-row node counts: map-only work on the row's own array and, where a
total is asked for, one global aggregation of a few numbers.  Only the edge list
itself is quadratic in a row's nodes; it is built on demand, in tiles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veilspark import constants as K
from veilspark.functions.arrays import let, lookup
from veilspark.operators.inference import inferred_array
from veilspark.operators.proximity import codes_in, type_code
from veilspark.operators.ranking import ranked

EDGE_TILE = 128
BROADCAST_NODES = 10_000
_EDGE_FIELDS = ("node_id", "kind", "start", "weight", "code", "self_loop", "other_type")


def weight_of(type_: Column) -> Column:
    return lookup(K.RISK_WEIGHTS, type_, K.DEFAULT_WEIGHT)


def _merge_ids(raw: Column) -> Column:
    """One node per id: first place in the list, last attributes given.

    After sorting by (id, place) the first and the last of each run of equal ids
    line up; a run longer than one means the node is linked to itself.
    """

    def merged(items: Column) -> Column:
        last = F.size(items) - 1
        places = F.when(last < 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), last))

        def differs(n: Column, at: Column) -> Column:
            return F.get(items, at)["node_id"] != F.get(items, n)["node_id"]

        firsts = F.filter(places, lambda n: (n == 0) | differs(n, F.greatest(n - 1, F.lit(0))))
        lasts = F.filter(places, lambda n: (n == last) | differs(n, F.least(n + 1, last)))
        zipped = F.arrays_zip(firsts.alias("first"), lasts.alias("last"))
        return F.transform(
            zipped, lambda z: let(F.get(items, z["last"]), lambda x: node(items, z["first"], z["last"], x))
        )

    def node(items: Column, first: Column, last: Column, x: Column) -> Column:
        loop = last > first
        return F.struct(
            x["kind"].alias("kind"),
            F.get(items, first)["ord"].alias("node_ord"),
            x["node_id"].alias("node_id"),
            *[x[f].alias(f) for f in (
                "column", "text", "type", "start", "end", "confidence", "method", "risk_level",
            )],
            loop.alias("self_loop"),
            weight_of(x["type"]).alias("weight"),
            type_code(x["type"]).alias("code"),
            F.when(loop, F.get(items, F.greatest(last - 1, F.lit(0)))["type"])
            .alias("other_type"),
        )

    return F.array_sort(let(F.array_sort(raw), merged))


def _detected(row_id: Column, entities: Column) -> Column:
    def node(e: Column, i: Column) -> Column:
        start, end = e["start"] + e["base"], e["end"] + e["base"]
        return F.struct(
            F.concat_ws("_", row_id, start, end, e["text"]).alias("node_id"),
            i.alias("ord"), F.lit(0).alias("kind"),
            e["column"].alias("column"), e["text"].alias("text"), e["type"].alias("type"),
            start.alias("start"), end.alias("end"),
            e["confidence"].alias("confidence"), e["method"].alias("method"),
            F.lit(None).cast("string").alias("risk_level"),
        )

    return F.transform(entities, node)


def _inferred(row_id: Column, found: Column) -> Column:
    def node(e: Column, i: Column) -> Column:
        return F.struct(
            F.concat_ws("_", F.lit("inf"), row_id, e["start"], e["end"], e["text"])
            .alias("node_id"),
            i.alias("ord"), F.lit(1).alias("kind"),
            F.lit(None).cast("string").alias("column"),
            e["text"].alias("text"), e["type"].alias("type"),
            e["start"].alias("start"), e["end"].alias("end"),
            e["confidence"].alias("confidence"), F.lit(K.PATTERN_METHOD).alias("method"),
            F.coalesce(e["risk_level"], F.lit("medium")).alias("risk_level"),
        )

    return F.transform(found, node)


def node_array(row_id: Column, entities: Column, inferred: Column | None) -> Column:
    """The merged nodes of one row."""
    row = row_id.cast("string")
    raw = _detected(row, entities)
    if inferred is not None:
        raw = F.concat(raw, _inferred(row, inferred))
    return _merge_ids(raw)


def graph_rows(rows: DataFrame, window: int = K.WINDOW, with_proximity: bool = True) -> DataFrame:
    """``row_id, nodes``: the node list of each row, ids merged (map-only).

    ``with_proximity=False`` leaves the inferred entities out.
    """
    found = None
    if with_proximity:
        found = inferred_array(F.col("row_text"), F.col("entities"), window)
    nodes = node_array(F.col("row_id"), F.col("entities"), found).alias("nodes")
    return rows.select("row_id", F.inline(F.array(F.struct(nodes))))


def graph_nodes(graph: DataFrame) -> DataFrame:
    """One row per node."""
    found = graph.select("row_id", F.explode("nodes").alias("n"))
    return found.select(
        "n.node_id", "row_id", "n.column", "n.text", "n.type", "n.start", "n.end",
        "n.confidence", "n.method", "n.risk_level", "n.self_loop", "n.kind", "n.node_ord",
        "n.weight",
    )


def _edge(a: Column, b: Column, window: int, proximity: bool, loop: bool = False) -> Column:
    """The edge between two nodes of one row.

    Every edge starts as a co-occurrence.  A relation between two detected
    entities overwrites its weight.  Ids hold the start, so all relations of a
    node pair have one distance, and the last relation is the one of the last
    attributes given.
    """
    mean = F.sqrt(a["weight"] * b["weight"])
    together = F.when(codes_in(a["code"], b["code"], K.BOOSTED_PAIRS), mean * K.BOOST)
    related = F.sqrt(weight_of(a["other_type"]) * b["weight"]) if loop else mean
    distance = F.abs(a["start"] - b["start"])
    near = F.lit(proximity) & (a["kind"] == 0) & (b["kind"] == 0) & (distance <= window)
    fade = F.greatest(F.lit(0.1), F.lit(1.0) - distance / F.lit(float(window)))
    return F.struct(
        F.least(a["node_id"], b["node_id"]).alias("src"),
        F.greatest(a["node_id"], b["node_id"]).alias("dst"),
        F.when(near, related * fade).otherwise(F.coalesce(together, mean)).alias("weight"),
        F.when(near, F.lit("proximity")).otherwise(F.lit("cooccurrence")).alias("relation_type"),
        F.when(near, distance).alias("distance"),
    )


def graph_edges(
    graph: DataFrame, window: int = K.WINDOW, with_proximity: bool = True
) -> DataFrame:
    """The edge list: every node pair of a row, and a loop for each repeated id.

    A row's nodes are cut into tiles of at most ``EDGE_TILE``; the tile pairs are
    redistributed by (row, tile, tile) before they are expanded, so a row with
    very many nodes is spread over many tasks and no task holds all its edges.
    """

    def tiles(nodes: Column) -> Column:
        last = F.floor((F.size(nodes) - 1) / F.lit(EDGE_TILE)).cast("int")

        def block(i: Column) -> Column:
            return F.slice(nodes, i * EDGE_TILE + 1, F.lit(EDGE_TILE))

        def pair(i: Column, j: Column) -> Column:
            return F.struct(
                i.alias("i"), j.alias("j"), block(i).alias("left"),
                F.when(i != j, block(j)).alias("right"),
            )

        return F.flatten(
            F.transform(
                F.sequence(F.lit(0), last),
                lambda i: F.transform(F.sequence(i, last), lambda j: pair(i, j)),
            )
        )

    # only what an edge is made of is moved
    slim = F.transform("nodes", lambda n: F.struct(*[n[f].alias(f) for f in _EDGE_FIELDS]))
    spread = graph.select("row_id", F.inline(let(slim, tiles))).repartition("row_id", "i", "j")

    def between(a: Column, others: Column) -> Column:
        return F.transform(others, lambda b: _edge(a, b, window, with_proximity))

    left, right = F.col("left"), F.col("right")
    inside = F.concat(
        F.flatten(
            F.transform(
                left, lambda a, k: between(a, F.slice(left, k + 2, F.size(left)))
            )
        ),
        F.transform(
            F.filter(left, lambda a: a["self_loop"]),
            lambda a: _edge(a, a, window, with_proximity, loop=True),
        ),
    )
    across = F.flatten(F.transform(left, lambda a: between(a, right)))
    edges = F.when(F.col("i") == F.col("j"), inside).otherwise(across)
    return spread.select("row_id", F.inline(edges))


def graph_totals(graph: DataFrame) -> DataFrame:
    """The sums all graph statistics are made of, in one global aggregation."""
    types, loops = F.col("nodes.type"), F.col("nodes.self_loop")  # of a staged graph only these are read
    k = F.col("k").cast("long")
    per_row = graph.select(
        F.size(types).alias("k"),
        F.size(F.filter(loops, lambda x: x)).alias("loops"),
        F.size(F.filter(types, lambda t: t.isin(K.HIGH_VALUE_TYPES))).alias("valued"),
    )
    zero = F.lit(0).cast("long")

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), zero)

    return per_row.agg(
        total(k).alias("nodes"),
        total((k * (k - 1) / 2).cast("long") + F.col("loops")).alias("edges"),
        total(F.when(k >= 3, k).otherwise(zero)).alias("clustered"),
        total(F.col("valued")).alias("valued"),
        F.coalesce(F.max(k), zero).alias("largest"),
        F.count("*").alias("components"),
    )


def _pairs_of(n: Column) -> Column:
    return n * (n - 1) / F.lit(2.0)


def stats_struct() -> Column:
    n, e = F.col("nodes"), F.col("edges")
    return F.struct(
        n.alias("nodes"),
        e.alias("edges"),
        F.when(n > 1, e / _pairs_of(n)).otherwise(F.lit(0.0)).alias("density"),
        F.when(n > 0, F.col("clustered") / n).otherwise(F.lit(0.0)).alias("average_clustering"),
        (F.col("components") == 1).alias("is_connected"),
    )


def reid_struct() -> Column:
    n = F.col("nodes")
    connectivity = F.when(n > 1, F.least(F.col("edges") / _pairs_of(n), F.lit(1.0))).otherwise(0.0)
    entity = F.when(n > 0, F.col("valued") / n).otherwise(0.0)
    component = F.when(n > 0, F.col("largest") / n).otherwise(0.0)
    score = connectivity * 0.4 + entity * 0.4 + component * 0.2
    return F.struct(
        F.when(score > 0.7, "high").when(score > 0.4, "medium").otherwise("low")
        .alias("risk_level"),
        score.alias("score"),
        connectivity.alias("connectivity_risk"),
        entity.alias("entity_risk"),
        component.alias("component_risk"),
    )


def graph_stats(graph: DataFrame) -> DataFrame:
    """Nodes, edges, density, average clustering, connectedness."""
    return graph_totals(graph).select(F.inline(F.array(stats_struct())))


def reid_risk(graph: DataFrame) -> DataFrame:
    """Re-identification risk with its three factors."""
    return graph_totals(graph).select(F.inline(F.array(reid_struct())))


def _type_counts(types: Column) -> Column:
    def counted(found: Column) -> Column:
        return let(
            F.array_sort(F.array_distinct(found)),
            lambda names: F.map_from_arrays(
                names,
                F.transform(names, lambda t: F.size(F.filter(found, lambda x: x == t))),
            ),
        )

    return let(types, counted)


def components(graph: DataFrame) -> DataFrame:
    """Connected components: size, types, mean weight, members.  One per row.

    Unordered; ``ranked_components`` adds the place by risk.
    """
    ids, types = F.col("nodes.node_id"), F.col("nodes.type")
    weights = F.aggregate(F.col("nodes.weight"), F.lit(0.0), lambda acc, w: acc + w)
    return graph.select(
        F.col("row_id").alias("component_id"),
        F.size(ids).alias("size"),
        _type_counts(types).alias("entity_types"),
        (weights / F.size(ids)).alias("risk_score"),
        ids.alias("nodes"),
    )


def risk_clusters(graph: DataFrame) -> DataFrame:
    """Maximal cliques of two nodes or more, with their cluster risk."""
    ids = F.col("nodes.node_id")
    types = F.array_sort(F.array_distinct(F.col("nodes.type")))
    valued = F.exists(types, lambda t: t.isin(K.HIGH_VALUE_TYPES))
    return graph.filter(F.size(ids) >= 2).select(
        "row_id",
        ids.alias("nodes"),
        F.size(ids).alias("size"),
        types.alias("entity_types"),
        (F.size(types) * 0.2 + F.when(valued, 0.5).otherwise(0.0)).alias("risk_score"),
        F.lit("clique").alias("cluster_type"),
    )


def _by_risk(df: DataFrame, key: str, path: str | None) -> DataFrame:
    """Highest risk first; sums in another order must not part equal risks, so nine places count."""
    return ranked(df, [F.round("risk_score", 9).desc(), F.col(key).asc()], path=path)


def ranked_components(graph: DataFrame, path: str | None = None) -> DataFrame:
    """``components`` with ``rank``, their place by risk (ties by row)."""
    return _by_risk(components(graph), "component_id", path)


def ranked_clusters(graph: DataFrame, path: str | None = None) -> DataFrame:
    """``risk_clusters`` with ``rank``, their place by risk (ties by row)."""
    return _by_risk(risk_clusters(graph), "row_id", path)


MEASURES = ("degree", "betweenness", "closeness")


def _ranked(graph: DataFrame, measure: str, limit: int) -> DataFrame:
    """The strongest nodes by a raw measure; ties follow insertion order.

    No row can give more than ``limit`` of them, so it offers only its first ones.
    """
    if measure not in MEASURES:
        raise ValueError(f"measure is one of {MEASURES}")

    def read(first: int | None) -> Column:
        """What a rank is made of; of a staged graph no more is read."""
        fields = ((f, F.col(f"nodes.{f}")) for f in ("node_id", "kind", "node_ord", "self_loop"))
        return F.arrays_zip(*[(c if first is None else F.slice(c, 1, first)).alias(f) for f, c in fields])

    nodes = read(None if measure == "degree" else limit)
    if measure == "degree":  # a row's nodes differ by their loops only
        nodes = F.concat(
            F.filter(nodes, lambda n: n["self_loop"]), F.filter(nodes, lambda n: ~n["self_loop"])
        )
    found = graph.select(
        "row_id", F.size("nodes.node_id").alias("k"), F.inline(F.slice(nodes, 1, limit))
    )
    loop = F.when(F.col("self_loop"), 2).otherwise(0)
    raw = {
        "degree": F.col("k") - 1 + loop,
        "betweenness": F.lit(0),
        "closeness": F.col("k") - 1,
    }[measure]
    return (
        found.select("node_id", "row_id", "kind", "node_ord", raw.cast("double").alias("raw"))
        .orderBy(F.desc("raw"), "kind", "row_id", "node_ord")
        .limit(limit)
    )


def top_central(graph: DataFrame, measure: str = "degree", limit: int = K.TOP_CENTRAL) -> DataFrame:
    """The ``limit`` most central nodes: a bounded top-k and one node total."""
    total = graph.agg(F.sum(F.size("nodes.kind").cast("long")).alias("n")).scalar()
    alone = F.lit(1.0 if measure == "degree" else 0.0)
    return _ranked(graph, measure, limit).select(
        "node_id", "row_id",
        F.when(total > 1, F.col("raw") / (total - 1)).otherwise(alone).alias("centrality"),
    )


def top_subgraph(
    graph: DataFrame, max_nodes: int = K.MAX_GRAPH_NODES, window: int = K.WINDOW
) -> tuple[DataFrame, DataFrame]:
    """The ``max_nodes`` nodes of highest degree and the edges among them.

    The chosen ids cut the node arrays first, so at most their own pairs are built.
    """
    top = _ranked(graph, "degree", max_nodes).groupBy(F.col("row_id").alias("_row")).agg(
        F.collect_set("node_id").alias("_ids")
    )
    if max_nodes <= BROADCAST_NODES:  # the limit bounds it
        top = F.broadcast(top)
    chosen = graph.join(top, F.col("row_id") == F.col("_row")).select(
        "row_id",
        F.filter("nodes", lambda n: F.array_contains(F.col("_ids"), n["node_id"])).alias("nodes"),
    )
    return graph_nodes(chosen), graph_edges(chosen, window)


def cliques_hold(edges: DataFrame) -> DataFrame:
    """Rows whose edge list is not a clique (empty when the closed forms apply)."""
    plain = edges.filter("src != dst").select("row_id", "src", "dst").distinct()
    ends = plain.select("row_id", F.explode(F.array("src", "dst")).alias("node_id"))
    sizes = ends.groupBy("row_id").agg(F.countDistinct("node_id").alias("k"))
    counts = plain.groupBy("row_id").agg(F.count("*").alias("n"))
    return counts.join(sizes, "row_id").filter("n != k * (k - 1) / 2")
