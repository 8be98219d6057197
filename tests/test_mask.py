import random
import re

import pytest
from pyspark.sql import functions as F

from tests import plain
from tests.test_detect import FIELDS, LETTERS, sample  # noqa: F401
from veilspark import constants as K
from veilspark.functions.dialect import detection_regex
from veilspark.operators.detect import detect
from veilspark.operators.mask import (
    mask, mask_detections, mask_merged, mask_names, mask_patterns, mask_spans,
)

NOISE = plain.noisy_texts(1500, 3)
SPANS_DDL = "id long, t string, spans array<struct<start:int,rank:int,end:int>>"


def span_rows(seed, n, most):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t = "".join(rng.choice("abcdé ") for _ in range(rng.randint(1, 400)))
        found = sorted(
            (s, r, min(len(t), s + rng.randint(1, 40)))
            for r, s in enumerate(rng.randint(0, len(t) - 1) for _ in range(rng.randint(0, most)))
        )
        rows.append((i, t, found))
    return rows


@pytest.mark.parametrize("most", [6, 200])
def test_span_fold_equals_python(spark, most):
    """Overlaps, stale ends, and more spans than one chunk."""
    rows = span_rows(most, 150, most)
    df = spark.createDataFrame(rows, SPANS_DDL)
    got = df.select("id", mask_spans(F.col("t"), F.col("spans")).alias("m")).collect()
    for r in got:
        _, t, found = rows[r.id]
        assert r.m == plain.mask_by_spans(t, found)


def test_merged_spans(spark):
    rows = span_rows(5, 200, 8)
    df = spark.createDataFrame(rows, SPANS_DDL)
    for r in df.select("id", mask_merged(F.col("t"), F.col("spans")).alias("m")).collect():
        _, t, found = rows[r.id]
        want, at = "", 0
        merged = []
        for s, _, e in found:
            if merged and s < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        for s, e in merged:
            want, at = want + t[at:s] + K.MASK, e
        assert r.m == want + t[at:]


def test_patterns_and_names_equal_python(texts):
    df = texts(NOISE)
    got = df.select(
        "id", mask_patterns(F.col("t")).alias("p"), mask_names(F.col("t")).alias("n")
    ).collect()
    for r in got:
        want = NOISE[r.id]
        for pattern in plain.MASKS.values():
            want = pattern.sub(K.MASK, want)
        assert r.p == want, repr(NOISE[r.id])
        want = NOISE[r.id]
        for name in plain.DETECT["name"].findall(want):
            want = want.replace(name, K.MASK)
        assert r.n == want


def test_whole_chain_equals_python(texts):
    for r in mask(texts(NOISE + [None, ""]), "id").collect():
        t = (NOISE + [None, ""])[r.id]
        assert r.t == (plain.mask_all(t) if t else t), repr(t)


def test_wide_table_and_other_columns(sample):  # noqa: F811
    df = sample.withColumn("amount", F.lit(555123456)).withColumn("gap", F.lit(None).cast("string"))
    out = mask(df, "row_id")
    assert out.columns == df.columns
    for r in out.collect():
        assert r.amount == 555123456 and r.gap is None
        for got, t in zip((r[c] for c in FIELDS), LETTERS[r.row_id], strict=True):
            assert got == (t and plain.mask_all(t))


def test_unscanned_columns_can_still_be_pattern_masked(sample):  # noqa: F811
    out = mask(sample, "row_id", columns=["sender"], extra_columns=["letter"]).collect()
    for r in out:
        letter, sender, plot = LETTERS[r.row_id]
        assert r.sender == (sender and plain.mask_all(sender)) and r.plot == plot
        want = letter
        for pattern in plain.MASKS.values():
            want = pattern.sub(K.MASK, want)
        for name in plain.DETECT["name"].findall(want):
            want = want.replace(name, K.MASK)
        assert r.letter == want


def test_mask_from_detections(sample):  # noqa: F811
    by_join = mask_detections(sample, "row_id", detect(sample, "row_id"))
    in_place = mask(sample, "row_id", steps="spans")
    assert sorted(by_join.collect()) == sorted(in_place.collect())


def test_masking_is_map_only_and_searches_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).selectExpr("id", "'John Doe' as a", "'x' as b").write.parquet(path)
    plan = mask(spark.read.parquet(path), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    for name in K.DETECTION_PATTERNS:  # the name step looks for names once more
        search = r"regexp_extract_all\([^,]*, " + re.escape(detection_regex(name))
        assert len(re.findall(search, plan)) == (2 if name == "name" else 1)
