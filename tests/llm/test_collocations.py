"""Phrases against brute force; sorting against counting."""

import re
from collections import Counter

import numpy as np
import pytest

from veilspark.llm import collocations as module
from veilspark.llm.collocations import collocations, equal_partitions

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least, longest=5, top=2000):
    grams = {}
    for lang, text in rows:
        f = grams.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            f.update(w[i : i + m] for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    out = []
    for lang, f in grams.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = []
        held = [p for p, c in f.items() if len(p) > 1 and c >= least]
        inside = {
            q for p in held for i in range(len(p)) for j in range(i + 1, len(p) + 1)
            if (q := p[i:j]) != p and f[p] >= f[q]
        }
        for p in held:
            if p not in inside:
                cuts = [(1000 * f[p] * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
                s, k = min(cuts)
                found.append((-s, -f[p], " ".join(p).encode(), f[p], f[p[:k]], f[p[k:]], n, s))
        for rank, x in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, x[2].decode(), *x[3:]))
    return sorted(out)


def got(df, **kw):
    return sorted(map(tuple, collocations(df, **kw).collect()))


def some(n, seed, words="a b c New york é 東 x-y".split()):
    rng = np.random.default_rng(seed)
    marks = ["", "", "", ",", ".", "\n", "\r\n", "\t", "  ", "!"]
    return [
        (["en", "fr", None][i % 3],
         " ".join(words[int(j)] + marks[int(k)] for j, k in zip(rng.zipf(1.6, 60) % len(words), rng.integers(0, 10, 60), strict=True)))
        for i in range(n)
    ]


ROWS = [
    *some(80, 1), (None, None), ("en", ""), ("en", " \t , ."), ("", "of the of the of the"), ("de", "Ja JA ja jA"),
    *[("es", "hoy es un dia muy bueno para todos")] * 9, ("en", "\x00 \x1c zero \x1c zero"),
]
SCHEMA = "lang string, text string"


@pytest.mark.parametrize("least", [1, 3, 8])
def test_equals_brute_force(spark, least):
    assert got(spark.createDataFrame(ROWS, SCHEMA), least=least) == brute(ROWS, least)


def test_top_and_length(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    assert got(df, least=2, longest=3, top=7) == brute(ROWS, 2, 3, 7)


def test_blocks_buckets_and_hot_pairs(spark, monkeypatch):
    """Small blocks, many buckets, every pair hot, and a bitmap that lets everything through."""
    want = brute(ROWS, 3)
    df = spark.createDataFrame(ROWS, SCHEMA)
    monkeypatch.setattr(module, "BUCKET", 50)
    assert got(df, least=3) == want
    monkeypatch.setattr(module, "HOT", 20)
    assert got(df, least=3) == want
    monkeypatch.setattr(module, "_filter", lambda hashes, most_bits=0: module.Filter(np.full(1, 255, np.uint8)))
    assert got(df, least=3) == want


def test_long_text_ties_and_other_columns(spark):
    text = "one two three four five six seven. " * 3000
    df = spark.createDataFrame([(text, "en", 1, "z", 2), ("one two " * 5, "en", 1, "z", 2)],
                               "text string, lang string, n int, phrase string, rank int")
    assert got(df, least=5) == brute([("en", text), ("en", "one two " * 5)], 5)


def test_empty(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(None, None), ("en", "one two")], SCHEMA)) == []


def test_hash_clash_draws_other_hashes(spark, monkeypatch):
    whole = spark.createDataFrame([r for r in ROWS if None not in r], SCHEMA)
    words, names = module._word_counts(whole.coalesce(1), 2), module._named_languages(whole, 2)
    assert not module._clashes(words, names)
    assert module._clashes(words.selectExpr("lang_h", "word", "1L as h", "n"), names)
    tries = iter([True, False])
    monkeypatch.setattr(module, "_clashes", lambda words, names: next(tries))
    assert got(spark.createDataFrame(ROWS, SCHEMA), least=8) == brute(ROWS, 8)
    monkeypatch.setattr(module, "_clashes", lambda words, names: True)
    with pytest.raises(module.HashClash):
        collocations(spark.createDataFrame(ROWS[:3], SCHEMA))


def test_hashes_of_words():
    import pyarrow as pa

    words = ["", "a", "b", "ab", "ba", "aa", "aaa", "é", "x" * 500, "x" * 501, "東京"]
    h = module._hashed(pa.array(words), 3)
    assert len(set(h.tolist())) == len(words) and 0 not in h
    assert (module._hashed(pa.array(words[::-1]), 3) == h[::-1]).all()


@pytest.mark.parametrize("seed", range(4))
def test_sort_counts_prefixes(seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(1, 4 + seed, (400, 4)).astype(np.uint64)
    rows[rng.random(400) < 0.3, 2:] = 0
    weight = rng.integers(1, 5, 400)
    want = Counter()
    for r, w in zip(rows.tolist(), weight.tolist(), strict=True):
        for d in range(1, 5):
            if 0 not in r[:d]:
                want[tuple(r[:d])] += w
    for least in (1, 30):
        found = {}
        for d, pointer, total in equal_partitions(rows, weight, least):
            for p, t in zip(pointer, total, strict=True):
                assert tuple(rows[p, :d].tolist()) not in found
                found[tuple(rows[p, :d].tolist())] = t
        assert found == {k: v for k, v in want.items() if v >= least}
    assert list(equal_partitions(rows[:0], weight[:0], 1)) == []
