import zlib

import numpy as np

from veilspark.llm.language import codewords, identify


def test_codewords():
    for n in (2, 3, 4, 6, 9, 40):
        code = codewords(n)
        assert len({tuple(c) for c in code}) == n and set(np.unique(code)) == {-1.0, 1.0}
        if n > 2:
            least = min((a != b).sum() for i, a in enumerate(code) for b in code[:i])
            assert least >= 2


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify(df).collect()
    lang = {r.doc_id: r.lang for r in df.select("doc_id", "lang").collect()}
    assert len(got) == len(lang) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97


def test_cases(spark, docs):
    rows = [(i, t) for i, t in enumerate([None, "", "12 !?", "the cat", "the cat", "è" * 9000] + ["a dog"] * 9)]
    df = docs(rows).withColumnRenamed("source", "score")
    got = {r.doc_id: r for r in identify(df).collect()}
    assert [got[i].lang_pred for i in range(6)] == ["und", "und", "und", "en", "en", "en"]
    assert got[3][2:] == got[4][2:] and got[0].score == 0
    assert identify(df.limit(0)).count() == 0
    assert {r.lang_pred for r in identify(df.withColumn("lang", df.lang.cast("string").substr(9, 1)).replace("", None, ["lang"])).collect()} == {"und"}


def test_not_from_other_columns(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a = {r.doc_id: (r.lang_pred, r.score) for r in identify(df).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in identify(df.selectExpr("doc_id", "text", "lang", "'x' as source")).collect()}
    assert a == b
