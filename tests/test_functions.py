import random
import re

from pyspark.sql import functions as F

from veilspark.functions import text as X
from veilspark.functions.arrays import chunked, constant, lookup, running_totals
from veilspark.functions.spans import BLOCK, blocks, cut_after_last, find_spans, piece


def test_pieces_over_block_borders(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        n = rng.choice([0, 1, BLOCK - 1, BLOCK, BLOCK + 1, 3 * BLOCK + 7])
        t = "".join(rng.choice("abé中😀\n") for _ in range(n))
        start = rng.choice([0, n // 2, BLOCK - 3, BLOCK, 2 * BLOCK, max(n - 2, 0), n + 5])
        rows.append((i, t, start, rng.choice([-4, 0, 1, 9, BLOCK, 2 * BLOCK + 3])))
    df = spark.createDataFrame(rows, "id int, t string, s int, n int")
    got = df.select("id", piece(blocks(F.col("t")), F.col("s"), F.col("n")).alias("p")).collect()
    for r in got:
        _, t, s, n = rows[r.id]
        assert r.p == (t[s:s + n] if n > 0 else ""), rows[r.id][2:]


def test_running_totals_and_chunks(spark):
    df = spark.createDataFrame([(list(range(n)),) for n in (0, 1, 63, 64, 65, 200)], "a array<int>")
    for r in df.select(
        "a", running_totals(F.col("a"), lambda x: x).alias("r"),
        F.flatten(chunked(F.col("a"))).alias("c"),
    ).collect():
        assert r.r == [sum(r.a[:i]) for i in range(len(r.a))] and r.c == r.a


def test_spans_and_cut(texts):
    items = ["a1b22c", "", "none", "1", "é1\n2 tail", "12 😀 3"]
    df = texts(items)
    for r in df.select(
        "id", find_spans(F.col("t"), r"\d+").alias("s"),
        cut_after_last(F.col("t"), r"\d").alias("c"),
    ).collect():
        t = items[r.id]
        assert [(x.start, x.end, x.text) for x in r.s] == [
            (m.start(), m.end(), m.group()) for m in re.finditer(r"\d+", t)
        ]
        ends = [m.end() for m in re.finditer(r"\d", t)]
        assert r.c == (t[:ends[-1]] if ends else "")


def test_constants(spark):
    value = [{"a": "it's \\ 'x'", "n": 1.5}, {"a": "é", "n": -2.0}]
    got = spark.range(1).select(constant(value).alias("v")).first().v
    assert [x.asDict() for x in got] == value
    r = spark.range(1).select(
        lookup({"a": 1, "b": 2}, F.lit("b")).alias("b"), lookup({"a": 1}, F.lit("z"), 9).alias("z")
    ).first()
    assert (r.b, r.z) == (2, 9)


def test_text_scalars(texts):
    items = ["﻿ <a onClick=x href='JavaScript:y'>  ", None, "a b/c?.csv", "HIGH!"]
    rows = texts(items).orderBy("id").select(
        X.sanitize_text(F.col("t")).alias("s"), X.sanitize_filename(F.col("t")).alias("f"),
        X.risk_badge(F.col("t")).alias("b"),
    ).collect()
    assert rows[0].s == "a x href='y'" and rows[1].s == ""
    assert rows[2].f == "a_b_c_.csv" and rows[3].b == "badge-danger"
    assert rows[1].b == rows[2].b == "badge-info"
    assert texts(["x"]).select(X.score_percent(F.lit(0.4567)).alias("p")).first().p == "45.7%"
