import itertools
import math
import random
from collections import Counter

import pytest

from tests.test_proximity import detections
from veilspark import constants as K
from veilspark.operators import graph as G
from veilspark.operators.gazetteer import rows_of

TYPES = ["name", "ssn", "phone", "email", "zip_code", "credit_card"]


def random_entities(seed, n_rows=12, most=9):
    """Few texts and places, so ids repeat inside a row."""
    rng = random.Random(seed)
    return {
        r: [
            (rng.choice("xy"), rng.choice(TYPES), s, s + 3)
            for s in (rng.choice([0, 4, 30, 70]) for _ in range(rng.randint(1, most)))
        ]
        for r in range(n_rows)
    }


class Plain:
    """The same graph with sets and breadth-first search."""

    def __init__(self, data):
        self.attr, self.adj, self.edges, self.rank = {}, {}, {}, {}
        listed = {}
        for r, ents in data.items():
            for text, ty, s, e in ents:
                n = f"{r}_{s}_{e}_{text}"
                self.rank.setdefault(n, len(self.rank))
                self.attr[n] = (r, ty, s, e)
                listed.setdefault(r, []).append(n)
                self.adj.setdefault(n, set())
        for nodes in listed.values():
            for a, b in itertools.combinations(nodes, 2):
                self.link(a, b, None)
        for r, ents in data.items():
            for a, b in itertools.combinations(ents, 2):
                if abs(a[2] - b[2]) <= K.WINDOW:
                    na, nb = (f"{r}_{x[2]}_{x[3]}_{x[0]}" for x in (a, b))
                    self.link(na, nb, (abs(a[2] - b[2]), a[1], b[1]))

    def link(self, a, b, near):
        self.adj[a].add(b)
        self.adj[b].add(a)
        self.edges[tuple(sorted((a, b)))] = near

    def weight(self, edge):
        w = lambda t: K.RISK_WEIGHTS.get(t, K.DEFAULT_WEIGHT)
        near = self.edges[edge]
        if near:
            return math.sqrt(w(near[1]) * w(near[2])) * max(0.1, 1 - near[0] / K.WINDOW)
        t1, t2 = (self.attr[n][1] for n in edge)
        hot = {frozenset(p) for p in K.BOOSTED_PAIRS}
        return math.sqrt(w(t1) * w(t2)) * (K.BOOST if frozenset((t1, t2)) in hot else 1)

    def reach(self, start):
        dist, todo = {start: 0}, [start]
        for n in todo:
            for m in self.adj[n]:
                if m not in dist:
                    dist[m] = dist[n] + 1
                    todo.append(m)
        return dist

    def clustering(self, n):
        near = self.adj[n] - {n}
        if len(near) < 2:
            return 0.0
        linked = sum(b in self.adj[a] for a, b in itertools.combinations(near, 2))
        return linked / (len(near) * (len(near) - 1) / 2)


@pytest.fixture
def make(spark):
    def build(data):
        df = spark.createDataFrame([(r, "") for r in data], "id long, t string")
        return G.graph_rows(rows_of(df, "id", detections(spark, data)))

    return build


@pytest.mark.parametrize("seed", [1, 2])
def test_closed_forms_equal_brute_force(make, seed):
    data = random_entities(seed)
    graph, p = make(data), Plain(data)
    n, e = len(p.attr), len(p.edges)
    s = G.graph_stats(graph).first()
    assert (s.nodes, s.edges) == (n, e)
    assert s.density == pytest.approx(2 * e / (n * (n - 1)))
    assert s.average_clustering == pytest.approx(sum(map(p.clustering, p.attr)) / n)
    assert s.is_connected == (len(p.reach(next(iter(p.attr)))) == n)

    parts = {frozenset(p.reach(x)) for x in p.attr}
    got = {frozenset(c.nodes): c for c in G.components(graph).collect()}
    assert set(got) == parts
    for part, c in got.items():
        types = [p.attr[x][1] for x in part]
        assert c.entity_types == dict(Counter(types))
        mean = sum(K.RISK_WEIGHTS.get(t, K.DEFAULT_WEIGHT) for t in types) / len(types)
        assert c.risk_score == pytest.approx(mean)

    risk = G.reid_risk(graph).first()
    c = min(e / (n * (n - 1) / 2), 1.0)
    v = sum(p.attr[x][1] in K.HIGH_VALUE_TYPES for x in p.attr) / n
    m = max(map(len, parts)) / n
    assert risk.score == pytest.approx(0.4 * c + 0.4 * v + 0.2 * m)

    degree = {
        x: (len(p.adj[x] - {x}) + 2 * (x in p.adj[x])) / (n - 1) for x in p.attr
    }
    close = {}
    for x in p.attr:
        d = p.reach(x)
        far = sum(d.values())
        close[x] = (len(d) - 1) / far * (len(d) - 1) / (n - 1) if far else 0.0
    for measure, scores in (("degree", degree), ("closeness", close)):
        want = sorted(scores, key=lambda x: (-scores[x], p.rank[x]))[:5]
        got = G.top_central(graph, measure).collect()
        assert [r.node_id for r in got] == want
        assert [r.centrality for r in got] == pytest.approx([scores[x] for x in want])
    first = sorted(p.rank, key=p.rank.get)[:5]
    flat = G.top_central(graph, "betweenness").collect()
    assert [r.node_id for r in flat] == first and {r.centrality for r in flat} == {0.0}

    clusters = {frozenset(r.nodes): r for r in G.risk_clusters(graph).collect()}
    assert set(clusters) == {x for x in parts if len(x) >= 2}
    for part, r in clusters.items():
        types = {p.attr[x][1] for x in part}
        want = 0.2 * len(types) + (0.5 if types & set(K.HIGH_VALUE_TYPES) else 0)
        assert r.risk_score == pytest.approx(want)


@pytest.mark.parametrize("tile", [2, G.EDGE_TILE])
def test_edges_equal_brute_force(make, monkeypatch, tile):
    monkeypatch.setattr(G, "EDGE_TILE", tile)
    data = random_entities(3)
    graph, p = make(data), Plain(data)
    edges = G.graph_edges(graph)
    got = {(r.src, r.dst): r for r in edges.collect()}
    assert set(got) == set(p.edges) and len(got) == edges.count()
    for k, r in got.items():
        assert r.weight == pytest.approx(p.weight(k)), k
        assert r.relation_type == ("proximity" if p.edges[k] else "cooccurrence")
        assert r.distance == (p.edges[k][0] if p.edges[k] else None)
    assert G.cliques_hold(edges).count() == 0
    nodes = {r.node_id: r for r in G.graph_nodes(graph).collect()}
    assert {k: (r.row_id, r.type, r.start, r.end) for k, r in nodes.items()} == p.attr


def test_not_a_clique_is_reported(make):
    edges = G.graph_edges(make({0: [("a", "name", i * 5, i * 5 + 3) for i in range(3)]}))
    assert G.cliques_hold(edges.limit(2)).count() == 1


def test_single_and_empty_graph(make, spark):
    one = make({0: [("a", "name", 0, 3)]})
    assert G.reid_risk(one).first().connectivity_risk == 0.0
    assert G.top_central(one).first().centrality == 1.0
    assert G.top_central(one, "closeness").first().centrality == 0.0
    s = G.graph_stats(one).first()
    assert (s.nodes, s.edges, s.density, s.is_connected) == (1, 0, 0.0, True)
    from veilspark.plans.report import graph_summary

    none = graph_summary(one.filter("row_id < 0")).first()
    assert none.error == K.EMPTY_GRAPH and none.graph_stats.nodes == 0
    assert graph_summary(one).first().error is None


def test_top_subgraph(make):
    data = {r: [("a", "name", i * 5, i * 5 + 3) for i in range(r + 1)] for r in range(6)}
    nodes, edges = G.top_subgraph(make(data), max_nodes=7)
    kept = {r.node_id for r in nodes.collect()}
    assert len(kept) == 7 and {x.split("_")[0] for x in kept} == {"5", "4"}
    assert edges.count() == 6 * 5 // 2


def test_unknown_measure(make):
    with pytest.raises(ValueError):
        G.top_central(make({0: [("a", "name", 0, 3)]}), "pagerank")


def test_whole_edge_list_is_written_compressed(spark, tmp_path):
    """The whole edge list is written compressed and read back whole."""
    from veilspark.operators.detect import entity_rows
    from veilspark.operators.graph import graph_edges, graph_rows
    from veilspark.sources.exports import export_graph

    df = spark.createDataFrame([(1, "a@b.example and c@d.example, call 0161-555-0199")], "row_id long, t string")
    graph = graph_rows(entity_rows(df, "row_id"))
    spread = graph_edges(graph)
    export_graph(graph, f"{tmp_path}/g", expanded=True)
    names = [p.name for p in (tmp_path / "g" / "edges").iterdir() if p.name.startswith("part-")]
    assert names and all(n.endswith(".json.gz") for n in names)
    assert spark.read.json(f"{tmp_path}/g/edges").count() == spread.count()
