"""Substring dedup against plain Python."""

import random
import re
from collections import Counter

import pytest

from veilspark.llm import repeats as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(40)] + ["a", "B", "b"]
    word = lambda: rnd.choice(vocabulary)
    passages = [[word() for _ in range(rnd.choice([15, 16, 20, 60]))] for _ in range(6)]
    texts = [None, "", " \n ", "be " * 100, "be " * 17, "x y " * 40]
    for _ in range(60):
        w = []
        for _ in range(rnd.randrange(4)):
            w += [word() for _ in range(rnd.randrange(30))]
            if rnd.random() < 0.6:
                p = rnd.choice(passages)
                a = rnd.randrange(len(p))
                w += p[a:] if rnd.random() < 0.3 else p
        texts.append(rnd.choice([" ", "\n", " \t "]).join(w))
    return texts + texts[10:14]


@pytest.mark.parametrize("hot", [0, 5, 1000])
def test_brute_force(spark, docs, hot):
    texts = corpus(hot)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in R.remove_repeats(docs(texts), window=16, hot=hot).collect()}
    assert [got[i] for i in range(len(texts))] == plain(texts, 16)
    assert sum(g[1] for g in got.values()) > 500


def test_cases(spark, docs):
    long = " ".join(f"t{i}" for i in range(50_000))
    df = docs([(None, long), (None, long), (1, "a b c"), (1, "a b c")]).withColumnRenamed("lang", "kept").withColumnRenamed("source", "n_words")
    got = R.remove_repeats(df)
    assert got.columns == ["doc_id", "_kept", "_n_words", "n_chars", "n_words", "n_removed", "kept"]
    assert sorted((r["n_words"], r.n_removed) for r in got.select("n_words", "n_removed").collect()) == [(3, 0), (3, 0), (50_000, 50_000), (50_000, 50_000)]
    assert R.remove_repeats(df.limit(0)).count() == 0
