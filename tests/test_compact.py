"""Compact graph records against the full edge list."""

import pytest

from tests.test_graph import random_entities
from tests.test_proximity import detections
from veilspark.operators import compact as C
from veilspark.operators import graph as G
from veilspark.operators.gazetteer import rows_of


def graph_of(spark, data):
    df = spark.createDataFrame([(r, "") for r in data], "id long, t string")
    return G.graph_rows(rows_of(df, "id", detections(spark, data)))


def edges_of(df):
    return {(r["src"], r["dst"]): (round(r["weight"], 9), r["relation_type"], r["distance"]) for r in df.collect()}


@pytest.mark.parametrize("near", [True, False])
def test_expansion(spark, near):
    graph = graph_of(spark, random_entities(5, n_rows=14, most=30))
    full = G.graph_edges(graph, with_proximity=near)
    found = C.expand(C.graph_compact(graph, with_proximity=near), with_proximity=near)
    assert found.count() == full.count() and edges_of(found) == edges_of(full)


def test_links_and_totals(spark):
    graph = graph_of(spark, random_entities(9, n_rows=10, most=40))
    compact = C.graph_compact(graph)
    full = G.graph_edges(graph).collect()
    total = C.compact_totals(compact).first()
    assert (total["nodes"], total["edges"]) == (G.graph_nodes(graph).count(), len(full))
    assert total["weight"] == pytest.approx(sum(e["weight"] for e in full))
    own = sum(e["relation_type"] == "proximity" or e["src"] == e["dst"] for e in full)
    assert compact.selectExpr("sum(size(own)) as n").first()["n"] == own


def test_crowded_row_stays_linear(spark):
    """3,000 findings far apart: 4.5 million pairs, no edge written out."""
    graph = graph_of(spark, {0: [("x", "email", 100 * i, 100 * i + 3) for i in range(3000)]})
    row = C.graph_compact(graph).first()
    assert len(row["own"]) == 0 and len(row["members"]) == 3000
    assert [(x["type1"], x["n_plain"]) for x in row["links"]] == [("email", 3000 * 2999 // 2)]


def test_empty_and_single(spark):
    graph = graph_of(spark, {1: [("x", "name", 0, 3)]})
    row = C.graph_compact(graph).first()
    assert (len(row["members"]), row["own"], row["links"]) == (1, [], [])
    assert tuple(C.compact_totals(C.graph_compact(graph.filter("false"))).first()) == (0, 0, 0.0)
    assert C.expand(C.graph_compact(graph)).count() == 0


def test_export_builds_the_compact_graph_once(spark, tmp_path, monkeypatch):
    """Own edges and cliques are read from one staged pass, which is gone afterwards."""
    from veilspark.operators.detect import entity_rows
    from veilspark.operators.graph import graph_rows
    from veilspark.sources import exports

    df = spark.createDataFrame([(1, "Mary Smith, 10001, mary@smith.org and Bob Miller"), (2, "nothing")], "id long, t string")
    seen, own_edges = [], exports.export_own_edges

    def watched(compact):
        seen.append(compact.inputFiles())
        return own_edges(compact)

    monkeypatch.setattr(exports, "export_own_edges", watched)
    exports.export_graph(graph_rows(entity_rows(df, "id")), str(tmp_path / "graph"))
    assert len(seen) == 1 and seen[0] and all("_scan-" in f for f in seen[0])
    assert sorted(p.name for p in (tmp_path / "graph").iterdir()) == ["cliques", "edges", "metadata", "nodes"]
    assert spark.read.json(str(tmp_path / "graph/cliques")).first()["size"] == 4
