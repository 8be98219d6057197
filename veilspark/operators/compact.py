"""The co-occurrence graph without its pairs: one record per row, linear in the row's nodes.

All nodes of a row are linked, and the weight of a plain co-occurrence depends on the two
types alone.  So a row is its member list and, for each pair of types, a count and a sum of
weights.  Only edges with a weight of their own are written out: pairs within the window,
whose number is bounded by how many findings fit into it, and loops.  ``expand`` gives the
full edge list back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veilspark import constants as K
from veilspark.functions.arrays import empty_array, let
from veilspark.operators.graph import _edge, graph_edges, weight_of
from veilspark.operators.proximity import tiled_pairs, type_code

_OWN = (
    "src string, dst string, weight double, relation_type string, distance int, type1 string, type2 string"
)


def _typed(edge: Column, a: Column, b: Column) -> Column:
    fields = [edge[f].alias(f) for f in ("src", "dst", "weight", "relation_type", "distance")]
    return F.struct(
        *fields, F.least(a["type"], b["type"]).alias("type1"), F.greatest(a["type"], b["type"]).alias("type2")
    )


def own_edges(nodes: Column, window: int = K.WINDOW, with_proximity: bool = True) -> Column:
    """The edges of a row that have a weight of their own, with the types of their ends."""

    def slim(n: Column) -> Column:
        names = ("node_id", "kind", "start", "type", "weight", "code")
        return F.struct(n["start"].alias("at"), *[n[f].alias(f) for f in names])

    def pair(a: Column, b: Column) -> Column:
        return let(_edge(a, b, window, True), lambda e: _typed(e, a, b))

    loops = F.transform(
        F.filter(nodes, lambda n: n["self_loop"]),
        lambda n: let(_edge(n, n, window, with_proximity, loop=True), lambda e: _typed(e, n, n)),
    )
    if not with_proximity:
        return loops.cast(f"array<struct<{_ddl(_OWN)}>>")
    found = F.array_sort(F.transform(F.filter(nodes, lambda n: n["kind"] == 0), slim))
    near = let(found, lambda x: F.when(F.size(x) > 1, tiled_pairs(x, window, pair)))
    none = empty_array(f"struct<{_ddl(_OWN)}>")
    return F.concat(F.coalesce(near.cast(f"array<struct<{_ddl(_OWN)}>>"), none), loops.cast(f"array<struct<{_ddl(_OWN)}>>"))


def _ddl(fields: str) -> str:
    return ",".join(f.strip().replace(" ", ":") for f in fields.split(","))


def _type_pairs(nodes: Column, own: Column) -> Column:
    """Counts and sums of weights by unordered pair of types."""

    def of(c1: Column, c2: Column) -> Column:
        here = F.filter(own, lambda e: (e["type1"] == c1["type"]) & (e["type2"] == c2["type"]))

        def counted(e: Column) -> Column:
            pairs = F.when(c1["type"] == c2["type"], c1["n"] * (c1["n"] - 1) / 2).otherwise(c1["n"] * c2["n"])
            plain = F.size(F.filter(e, lambda x: x["src"] != x["dst"]))
            n = pairs.cast("long") - plain
            ends = [F.struct(c["type"].alias("type"), F.lit(1).alias("kind"), F.lit(0).alias("start"), F.lit("").alias("node_id"),
                             c["weight"].alias("weight"), c["code"].alias("code")) for c in (c1, c2)]
            each = let(ends[0], lambda a: let(ends[1], lambda b: _edge(a, b, K.WINDOW, False)["weight"]))
            return F.struct(
                c1["type"].alias("type1"), c2["type"].alias("type2"), n.alias("n_plain"), each.alias("plain_weight"),
                F.size(e).cast("long").alias("n_own"),
                F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x["weight"]).alias("own_weight"),
            )

        return let(here, counted)

    types = F.transform(nodes, lambda n: n["type"])

    def classes(all_: Column) -> Column:
        return F.transform(
            F.array_sort(F.array_distinct(all_)),
            lambda t: F.struct(
                t.alias("type"), F.size(F.filter(all_, lambda x: x == t)).cast("long").alias("n"),
                weight_of(t).alias("weight"), type_code(t).alias("code"),
            ),
        )

    def paired(cs: Column) -> Column:
        both = F.transform(cs, lambda c, i: F.transform(F.slice(cs, i + 1, F.size(cs)), lambda d: of(c, d)))
        return F.filter(F.flatten(both), lambda p: p["n_plain"] + p["n_own"] > 0)

    return let(let(types, classes), paired)


def graph_compact(graph: DataFrame, window: int = K.WINDOW, with_proximity: bool = True) -> DataFrame:
    """``row_id, members, own, links``: one record per row with nodes (map-only).

    ``members``: node_id, type, kind, start.  ``own``: edges with a weight of their own.
    ``links``: by pair of types the number of plain co-occurrences, the weight of each,
    and number and weight sum of the edges in ``own``.
    """
    nodes = F.col("nodes")
    members = F.transform(
        nodes, lambda n: F.struct(*[n[f].alias(f) for f in ("node_id", "type", "kind", "start")])
    )

    def record(own: Column) -> Column:
        return F.struct(members.alias("members"), own.alias("own"), _type_pairs(nodes, own).alias("links"))

    return graph.select("row_id", F.inline(F.array(let(own_edges(nodes, window, with_proximity), record))))


def compact_totals(compact: DataFrame) -> DataFrame:
    """Nodes, edges and the sum of all weights, in one global aggregation over the records."""
    links = F.col("links")
    zero = F.lit(0).cast("long")
    edges = F.aggregate(links, zero, lambda acc, x: acc + x["n_plain"] + x["n_own"])
    weight = F.aggregate(links, F.lit(0.0), lambda acc, x: acc + x["n_plain"] * x["plain_weight"] + x["own_weight"])
    return compact.select(F.size("members").cast("long").alias("n"), edges.alias("e"), weight.alias("w")).agg(
        F.coalesce(F.sum("n"), zero).alias("nodes"), F.coalesce(F.sum("e"), zero).alias("edges"),
        F.coalesce(F.sum("w"), F.lit(0.0)).alias("weight"),
    )


def expand(compact: DataFrame, window: int = K.WINDOW, with_proximity: bool = True) -> DataFrame:
    """The full edge list, as ``graph_edges`` gives it; quadratic in a row's nodes."""
    full = F.transform(
        "members",
        lambda m: F.struct(
            m["node_id"].alias("node_id"), m["kind"].alias("kind"), m["start"].alias("start"),
            weight_of(m["type"]).alias("weight"), type_code(m["type"]).alias("code"),
            F.lit(False).alias("self_loop"), m["type"].alias("other_type"),
        ),
    )
    pairs = graph_edges(compact.select("row_id", full.alias("nodes")), window, with_proximity)
    own = compact.select("row_id", F.inline("own")).drop("type1", "type2")
    return pairs.filter(F.col("relation_type") == "cooccurrence").unionByName(own)
