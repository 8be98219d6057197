"""What expressions over a row need not do: copy, compile or look for more than they use."""

import re

from pyspark.sql import functions as F

from veilspark.functions.arrays import let
from veilspark.functions.spans import cut_after_last, find_spans
from veilspark.operators.detect import entity_rows
from veilspark.operators.inference import contexts, inferred

TEXTS = [
    "John Doe, 123-45-6789, john@x.example.com, Jane Roe 555-123-4567, born 01/02/1990, Patient at home",
    "no one", None, "Jane Roe Jane Roe 12345 4111111111111111 salary",
]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_let_copies_nothing(spark):
    df = spark.createDataFrame([([1, 2],), ([],), (None,)], "a array<int>")
    twice = let(F.transform("a", lambda x: x + 1), lambda b: F.concat(b, b))
    assert [r.r for r in df.select(twice.alias("r")).collect()] == [[2, 3, 2, 3], [], None]
    plan = _plan(df.select(twice.alias("r")))
    assert plan.count("transform(") == 1  # a binding by transform would copy what it returns


def test_gaps_compile_no_pattern_a_text(spark, texts):
    df = texts(["a1b22c", "1", "", "none", "x\x01y1\x012z", "\x01", None])
    got = {r.id: [(x["start"], x["end"], x["text"]) for x in r.s or []] for r in df.select("id", find_spans(F.col("t"), r"\d+").alias("s")).collect()}
    want = {i: [(m.start(), m.end(), m[0]) for m in re.finditer(r"\d+", t or "")] for i, t in enumerate(["a1b22c", "1", "", "none", "x\x01y1\x012z", "\x01", None])}
    assert got == want
    cut = [r.c for r in df.select(cut_after_last(F.col("t"), r"\d").alias("c")).collect()]
    assert cut == ["a1b22", "1", "", "", "x\x01y1\x012", "", ""]
    plan = _plan(df.select(find_spans(F.col("t"), r"\d+").alias("s")))
    assert "split(regexp_replace(" in plan  # by a single character; the pattern serves texts that hold it


def test_context_keywords_are_looked_for_in_rows_that_hold_them(texts):
    rows = entity_rows(texts([*TEXTS, "Jane Roe " + "x " * 60 + "PATIENT", "JOHN Doe İ phone 555-123-4567 ΟΔΟΣ Home Jane Roe"]), "id")
    got = {r.row_id: r.n for r in inferred(rows, kind="context").groupBy("row_id").agg(F.count("*").alias("n")).collect()}
    plain = {r.row_id: r.n for r in _by_entity(rows).collect()}
    assert got == plain and 4 not in got and got[5] > 0


def _by_entity(rows):
    return contexts(rows).filter(F.size("indicators") > 0).groupBy("row_id").agg(F.count("*").alias("n"))
