"""Pigeonhole edit matching against plain dynamic programming."""

import random

import pytest
from hypothesis import given, settings, strategies as st

from veilspark.llm import decontaminate as D

ITEMS = "item_id long, text string"


def distance(item, text):
    """Least edits of ``item`` against any part of ``text``."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        before, row[0] = row[0], 0
        for i, d in enumerate(item, 1):
            before, row[i] = row[i], min(before + (c != d), row[i] + 1, row[i - 1] + 1)
        best = min(best, row[-1])
    return best


@settings(max_examples=150, deadline=None)
@given(st.text("abc ", min_size=1, max_size=70), st.text("abc ", max_size=120), st.integers(0, 30))
def test_myers(item, text, budget):
    found = D.myers(D._masks(item), len(item), text, budget)
    want = distance(item, text)
    # an empty part costs the whole item, which the search does not report
    assert (found[0] if found else None) == (want if want <= budget and (want < len(item) or found) else None)


def test_pieces_cover_item():
    for n in (1, 5, 20, 133):
        item = "".join(chr(97 + i % 26) for i in range(n))
        for rate in (0.0, 0.08, 0.3):
            parts = D.pieces(item, rate)
            assert "".join(p for _, p in parts) == item and all(item.startswith(p, a) for a, p in parts)
            assert len(parts) == min(int(rate * n) + 1, n)


@pytest.fixture(scope="module")
def case():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("etaoinsr") for _ in range(rnd.randrange(1, 8)))
    items = [" ".join(word() for _ in range(rnd.randrange(8, 30))) for _ in range(12)]
    texts = []
    for i in range(60):
        body = [word() for _ in range(rnd.randrange(0, 60))]
        text = " ".join(body)
        if i % 2:
            item = list(rnd.choice(items))
            for _ in range(rnd.randrange(0, 14)):
                at = rnd.randrange(len(item))
                item[at] = rnd.choice(["", "x", item[at] + "y"])
            cut = rnd.randrange(len(text) + 1)
            text = text[:cut] + "".join(item).upper().replace(" ", "  \n") + text[cut:]
        texts.append(text)
    return items, texts


def test_brute_force(spark, docs, case):
    items, texts = case
    table = spark.createDataFrame(list(enumerate(items)), ITEMS)
    got = {(r.doc_id, r.item_id): r for r in D.leaks(docs(texts), table).collect()}
    want = {}
    for d, t in enumerate(texts):
        for i, item in enumerate(items):
            n = distance(item, D.normal(t))
            if n <= int(0.08 * len(item)):
                want[d, i] = n
    assert {k: r.edits for k, r in got.items()} == want and want
    for (d, i), r in got.items():
        assert distance(items[i], D.normal(texts[d])[r.start : r.end]) == r.edits


def test_cases(spark, docs):
    item = "one two three four five six"
    items = spark.createDataFrame([(1, item), (2, item.upper()), (3, None), (4, ""), (5, "short")], ITEMS)
    df = docs([None, "", "x" * 50000 + item, item, item, "nothing short"]).withColumnRenamed("lang", "leaks")
    assert {(r.doc_id, r.item_id) for r in D.leaks(df, items).collect()} == {(d, i) for d in (2, 3, 4) for i in (1, 2)}
    kept = D.clean(df, items)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 5]
    assert D.clean(df, items.limit(0)).count() == 6 and D.leaks(df.limit(0), items).count() == 0


def test_blocks(spark, docs, case, monkeypatch):
    items, texts = case
    table = spark.createDataFrame(list(enumerate(items)), ITEMS)
    whole = sorted(D.leaks(docs(texts), table).collect())
    monkeypatch.setattr(D, "BLOCK_CHARS", 300)
    assert sorted(D.leaks(docs(texts), table).collect()) == whole
