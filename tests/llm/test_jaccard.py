"""Jaccard join and components against brute force."""

import random
import re

import pytest

from veilspark.llm.components import connected
from veilspark.llm import jaccard as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def roots(n, edges):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_connected(spark, seed):
    rnd = random.Random(seed)
    n = 300
    edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(200)] + [(i, i + 1) for i in range(200, 260)] + [(7, 7), (0, 5), (0, 5)]
    want = roots(n, edges)
    got = connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {i: want[i] for e in edges for i in e} and len(got) == len({i for e in edges for i in e})
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(lowered)
    if not w:
        return set()
    return {tuple(w)} if len(w) < 3 else {tuple(w[i : i + 3]) for i in range(len(w) - 2)}


def plain(texts, percent):
    sets = [shingles(t) for t in texts]
    edges = [
        (i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i])
        if a and b and 100 * len(a & b) >= percent * len(a | b)
    ]
    return [len(s) for s in sets], roots(len(texts), edges), len(edges)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcDé") for _ in range(3))
    base = [[word() for _ in range(rnd.choice([5, 20, 60, 200]))] for _ in range(12)]
    line = [word() for _ in range(14)]
    texts = [None, "", " \n", "one", "One", "one two", "ONE\ttwo", "one two three", "x " * 40]
    for _ in range(150):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
            w[rnd.randrange(len(w))] = word()
        if rnd.random() < 0.3:
            w = line + w
        texts.append(" ".join(w))
    for _ in range(40):
        texts.append(" ".join(line + [word() for _ in range(rnd.randrange(0, 30))]))
    return texts


@pytest.mark.parametrize(("seed", "wide", "percent"), [(1, 100, 90), (2, 3, 90), (3, 1, 70), (4, 10, 80)])
def test_brute_force(spark, docs, monkeypatch, seed, wide, percent):
    if wide < 10:
        monkeypatch.setattr(J, "TILE", 16)
    texts = corpus(seed)
    sizes, want, links = plain(texts, percent)
    got = {r.doc_id: r for r in J.jaccard_components(docs(texts), percent=percent, keep=["doc_id"], wide=wide).collect()}
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert [got[i].component_id for i in range(len(texts))] == want and links > 100
    kept = J.one_per_component(docs(texts), percent=percent, wide=wide)
    assert kept.columns == docs(texts).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want))


def test_cases(spark, docs):
    long = " ".join(f"t{i}" for i in range(30_000))
    rows = [(None, long), (5, long + " tail"), (5, long + " tail"), (None, None), (7, "a b c d"), (None, "a b c d"), (None, "q r s t")]
    df = docs(rows).withColumnRenamed("lang", "component_id").withColumnRenamed("source", "n_shingles")
    got = J.jaccard_components(df)
    assert got.columns == ["doc_id", "text", "_component_id", "_n_shingles", "n_chars", "n_shingles", "component_id"]
    assert sorted(map(str, got.select("doc_id", "n_shingles", "component_id").collect())) == sorted(
        f"Row(doc_id={a}, n_shingles={b}, component_id={c})"
        for a, b, c in [(None, 29_998, 5), (5, 29_999, 5), (5, 29_999, 5), (None, 0, None), (7, 2, 7), (None, 2, 7), (None, 2, None)]
    )
    assert sorted(str(r.doc_id) for r in J.one_per_component(df).collect()) == ["5", "7", "None", "None"]
    assert J.jaccard_components(df.limit(0)).count() == 0 and J.one_per_component(df.limit(0)).count() == 0
