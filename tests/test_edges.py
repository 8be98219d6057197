"""Measures of edge lists against sets and breadth-first search."""

import itertools
import random

import pytest

from veilspark.operators import edges as E


def table(spark, pairs, kind="long"):
    return spark.createDataFrame(pairs, f"src {kind}, dst {kind}")


def neighbours(pairs):
    near = {}
    for a, b in pairs:
        if a is not None and b is not None:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    return near


def reached(near):
    home = {}
    for first in sorted(near):
        if first in home:
            continue
        todo = [first]
        home[first] = first
        while todo:
            for x in near[todo.pop()]:
                if x not in home:
                    home[x] = first
                    todo.append(x)
    return home


def clustering(near):
    out = {}
    for n, them in near.items():
        them = them - {n}
        t = sum(b in near[a] for a, b in itertools.combinations(them, 2))
        d = len(them)
        out[n] = (d + 2 * (n in near[n]), t, 2 * t / (d * (d - 1)) if d > 1 else 0.0)
    return out


def noisy(seed):
    """Sparse parts, a star, a chain, loops, repeated and turned edges, nulls."""
    rng = random.Random(seed)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(150)]
    pairs += [(100, x) for x in range(101, 160)] + [(x, x + 1) for x in range(200, 230)]
    pairs += [(101, 102), (300, 300), (102, 101), (101, 102), (None, 5), (400, None)]
    return pairs


@pytest.mark.parametrize("hot", [5_000, 2])
def test_against_sets(spark, monkeypatch, hot):
    monkeypatch.setattr(E, "HOT_PARTS", hot)
    pairs = noisy(7)
    near = neighbours(pairs)
    edges = table(spark, pairs)
    got = {r["node"]: (r["degree"], r["triangles"], r["clustering"]) for r in E.edge_clustering(edges).collect()}
    want = clustering(near)
    assert got.keys() == want.keys()
    assert all(got[n] == pytest.approx(want[n]) for n in want)
    home = reached(near)
    size = {h: sum(x == h for x in home.values()) for h in home.values()}
    parts = {r["node"]: (r["component_id"], r["size"]) for r in E.edge_components(edges).collect()}
    assert parts == {n: (h, size[h]) for n, h in home.items()}
    s = E.edge_stats(edges).first()
    kinds = {tuple(sorted(p)) for p in pairs if None not in p}
    n = len(near)
    assert (s["nodes"], s["edges"], s["is_connected"]) == (n, len(kinds), False)
    assert s["density"] == pytest.approx(2 * len(kinds) / (n * (n - 1)))
    assert s["average_clustering"] == pytest.approx(sum(c for _, _, c in want.values()) / n)


def test_other_graphs_are_refused(spark):
    path = table(spark, [("a", "b"), ("b", "c")], "string")
    for measure in ("betweenness", "closeness"):
        with pytest.raises(E.NotCliques, match="3 nodes and 2 edges"):
            E.edge_centrality(path, measure)
    with pytest.raises(E.NotCliques):
        E.edge_clusters(path)
    with pytest.raises(ValueError, match="measure"):
        E.edge_centrality(path, "fame")
    assert [tuple(r) for r in E.edge_top_central(path, limit=1).collect()] == [("b", 1.0)]


def test_cliques_are_taken(spark):
    three = table(spark, [(1, 2), (2, 3), (1, 3), (8, 9), (9, 9)])
    assert {tuple(r) for r in E.edge_clusters(three).collect()} == {(1, 3), (8, 2)}
    close = dict(map(tuple, E.edge_centrality(three, "closeness").collect()))
    assert close == pytest.approx({1: 0.5, 2: 0.5, 3: 0.5, 8: 0.25, 9: 0.25})
    assert set(dict(map(tuple, E.edge_centrality(three, "betweenness").collect())).values()) == {0.0}
    assert dict(map(tuple, E.edge_centrality(three).collect()))[9] == pytest.approx(0.75)


def test_empty_and_loops(spark):
    s = E.edge_stats(table(spark, [])).first()
    assert tuple(s) == (0, 0, 0.0, 0.0, False)
    assert E.edge_components(table(spark, [(None, None)])).count() == 0
    assert [tuple(r) for r in E.edge_components(table(spark, [(4, 4)])).collect()] == [(4, 4, 1)]
    assert tuple(E.edge_stats(table(spark, [(4, 4)])).first()) == (1, 1, 0.0, 0.0, True)


def test_string_chain(spark):
    chain = [(f"n{i:03}", f"n{i + 1:03}") for i in range(40)]
    got = E.edge_components(table(spark, chain, "string")).collect()
    assert {(r["component_id"], r["size"]) for r in got} == {("n000", 41)} and len(got) == 41
