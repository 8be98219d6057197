"""Quality rules against plain Python, and against the labels."""

import random
import re

from veilspark.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
        len(lines), sum("A" <= c <= "Z" for c in text), len(set(words)),
    )


def corpus():
    rnd = random.Random(9)
    word = lambda: rnd.choice(["a", "be", "Çé", "x#", "🙂", "THE", "$%", "foo", "bar"])
    texts = [None, "", " \t\n", "be " * 7, "be " * 8, "be " * 9, "a\n\na\n b\n", "a b c d e f g h " * 3, "x y z\x85"]
    for _ in range(60):
        w = [word() for _ in range(rnd.randrange(60))]
        if rnd.random() < 0.5 and len(w) > 12:
            w += w[2:14] + [word()] + w[:9]
        texts.append("".join(x + rnd.choice([" ", "\n", "  ", "\t"]) for x in w))
    return texts


def test_measures(spark, docs):
    texts = corpus()
    got = {r.doc_id: r for r in Q.quality_verdicts(docs(texts)).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i][m] for m in Q.MEASURES) == plain(t), (i, t)
        assert got[i].base_failed == (got[i].n_words < 20 or 100 * got[i].n_repeat_words > 30 * got[i].n_words)
        assert not (got[i].base_failed and got[i].kept)


def test_posterior(spark):
    """Same posterior as plain EM over all rows, and agreement with the labels."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = Q.quality_verdicts(df).collect()
    measured = Q.with_measures(df, "text", "m")
    votes = measured.select("doc_id", *[v.alias(f"v{i}") for i, v in enumerate(Q.votes(measured["m"]))]).collect()
    rows = {r[0]: tuple(r[1:]) for r in votes}
    model = Q.fit([(v, 1) for v in sorted(rows.values())], 8)
    for r in got:
        assert abs(r.posterior - model.posterior(rows[r.doc_id])) < 1e-6
    assert all(a > 0.5 for a in model.accuracies())
    quality = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    good = [r for r in got if quality.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r for r in got if quality.get(r.doc_id) == 0]
    assert sum(r.kept for r in good) / len(good) > 0.98 and sum(not r.kept for r in bad) / len(bad) > 0.95


def test_em_finds_accuracies():
    rnd = random.Random(2)
    truth = [rnd.random() < 0.8 for _ in range(5000)]
    acc = [0.95, 0.9, 0.8, 0.7]
    counts = {}
    for t in truth:
        v = tuple(0 if rnd.random() < 0.2 else (1 if (rnd.random() < a) == t else -1) for a in acc)
        counts[v] = counts.get(v, 0) + 1
    model = Q.fit(list(counts.items()), 4)
    assert abs(model.prior - 0.8) < 0.05
    assert all(abs(g - a) < 0.06 for g, a in zip(model.accuracies(), acc, strict=True))


def test_cases(spark, docs):
    df = docs([(None, "good words " * 30), (1, None), (1, "x")]).withColumnRenamed("lang", "kept").withColumnRenamed("source", "n_words")
    got = Q.quality_verdicts(df)
    assert got.columns[:4] == ["doc_id", "_kept", "_n_words", "n_chars"] and got.count() == 3
    assert Q.good_rows(df).columns == df.columns
    assert Q.quality_verdicts(df.limit(0)).count() == 0 and Q.good_rows(df.limit(0)).count() == 0
