from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests import plain
from veilspark import constants as K
from veilspark.operators.detect import detect, entity_rows, pattern_spans
from veilspark.operators import summary

NOISE = plain.noisy_texts(1500, 1)


def by_row(df, *cols):
    out = {}
    for r in df.collect():
        out.setdefault(r["row_id"], []).append(tuple(r[c] for c in cols))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("name", list(K.DETECTION_PATTERNS))
def test_pattern_spans_equal_python(texts, name):
    got = by_row(pattern_spans(texts(NOISE), "id", "t", name), "start", "end", "text")
    for i, t in enumerate(NOISE):
        assert got.get(i, []) == plain.spans(plain.DETECT[name], t), repr(t)


@pytest.mark.parametrize("precedence", ["reference", "specific"])
def test_entities_equal_python(texts, precedence):
    got = by_row(
        detect(texts(NOISE), "id", precedence=precedence),
        "ent_ord", "start", "end", "type", "text",
    )
    order = None if precedence == "reference" else K.SPECIFIC_ORDER
    for i, t in enumerate(NOISE):
        want = [(n, s, e, ty, x) for n, (s, _, e, ty, x) in enumerate(plain.entities(t, order))]
        assert got.get(i, []) == want, repr(t)


EDGE_CELLS = {
    "123-45-6789": [(0, 11, "phone")],
    "4532-1234-5678-9012": [(0, 14, "phone")],
    "4111111111111111": [(0, 10, "phone"), (0, 16, "credit_card"), (10, 16, "phone")],
    "192.168.1.100": [(0, 13, "ip_address")],
    "12/31/2000": [(0, 10, "date_of_birth")],
    "2024-01-01": [(0, 10, "phone")],
    "10001-1234": [(0, 10, "phone")],
    "85001": [(0, 5, "zip_code")],
    "Mary Ann Lee Smith": [(0, 8, "name"), (9, 18, "name")],
    "": [],
    None: [],
}


def test_edge_cells(texts):
    cases = list(EDGE_CELLS)
    got = by_row(detect(texts(cases), "id"), "ent_ord", "start", "end", "type")
    for i, t in enumerate(cases):
        assert [x[1:] for x in got.get(i, [])] == EDGE_CELLS[t]


def test_specific_precedence_lets_ssn_win(texts):
    got = detect(texts(["123-45-6789", "4111111111111111"]), "id", precedence="specific")
    types = {(r.row_id, r.start, r.end): r.type for r in got.collect()}
    assert types[(0, 0, 11)] == "ssn" and types[(1, 0, 16)] == "credit_card"


def test_long_cell_offsets(texts):
    """More hits than one chunk of the running totals."""
    t = "é 85001 " * 1000
    got = detect(texts([t]), "id").orderBy("ent_ord").collect()
    want = plain.entities(t)
    assert [(r.start, r.end) for r in got] == [(e[0], e[2]) for e in want] and len(got) == 1000


# Letters to a garden club: findings of several kinds in one cell, one cell in two columns,
# a cell of white space, a null, and a column without any finding.
LETTERS = [
    ("tea at 4, ask Hanna Weiss (hanna@rose.example, 0171 223 4455)", "Rosa Club", None),
    (" ", "Hanna Weiss", "plot 9"),
    ("seeds paid by 4929123412341234 from 172.16.4.4 on 11-30-1975", "Hanna Weiss", "plot 12"),
    ("no reply yet", None, "plot 3"),
    ("post to 10115 or 10115-0001, c/o Otto Klein and Otto Klein", "o.klein@rose.example", ""),
]
FIELDS = ["letter", "sender", "plot"]


@pytest.fixture
def sample(spark):
    rows = [(i, *r) for i, r in enumerate(LETTERS)]
    return spark.createDataFrame(rows, "row_id long, letter string, sender string, plot string")


def test_wide_table(sample):
    got = by_row(detect(sample, "row_id"), "ent_ord", "column", "start", "end", "type")
    for i, row in enumerate(LETTERS):
        want = [(c, e[0], e[2], e[3]) for c, t in zip(FIELDS, row, strict=True) for e in plain.entities(t or "")]
        assert [x[1:] for x in got.get(i, [])] == want
        assert [x[0] for x in got.get(i, [])] == list(range(len(want)))


def test_chosen_columns(sample):
    only = detect(sample, "row_id", columns=["plot", "sender"])
    assert {r.column for r in only.collect()} == {"sender"}
    with pytest.raises(ValueError):
        detect(sample, "row_id", columns=["nope"])


def test_digit_only_numbers_are_scanned_on_request(spark):
    df = spark.createDataFrame([(1, 123456789)], "id long, ssn long")
    assert detect(df, "id").count() == 0
    assert detect(df, "id", columns=["ssn"]).count() == 1


def test_summary_counts(sample):
    rows = entity_rows(sample, "row_id", with_text=False)
    s = summary.detection_summary(rows).first()
    want = [e for r in LETTERS for t in r for e in plain.entities(t or "")]
    rows_hit = sum(any(plain.entities(t or "") for t in r) for r in LETTERS)
    assert s.total_detections == len(want) and s.n_rows_affected == rows_hit
    assert s.detection_types == dict(Counter(e[3] for e in want))
    assert s.columns_affected == ["letter", "sender"]


def test_summary_of_nothing(texts):
    s = summary.detection_summary(entity_rows(texts(["no hit here"]), "id")).first()
    assert s.total_detections == 0 and s.detection_types == {} and s.n_rows_affected == 0


def test_model_hook(texts):
    def tagger(batches):
        words = {"Rome": "GPE", "NASA": "ORG", "John Doe": "PERSON", "Monday": "DATE"}
        for batch in batches:
            yield pd.Series(
                [
                    [
                        {"text": w, "label": label, "start": t.index(w), "end": t.index(w) + len(w)}
                        for w, label in words.items() if t and w in t
                    ]
                    for t in batch
                ]
            )

    df = detect(texts(["John Doe met NASA in Rome on Monday", None, "85001"]), "id", model=tagger)
    got = {(r.row_id, r.text): (r.type, r.confidence, r.method) for r in df.collect()}
    assert got == {
        (0, "John Doe"): ("name", 0.9, K.MODEL_METHOD),
        (0, "NASA"): ("organization", 0.9, K.MODEL_METHOD),
        (0, "Rome"): ("location", 0.9, K.MODEL_METHOD),
        (2, "85001"): ("zip_code", 0.8, "regex"),
    }


def test_detection_is_map_only(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(10).selectExpr("id", "'John Doe' as a", "'x' as b", "id as n").write.parquet(path)
    df = spark.read.parquet(path)
    plan = detect(df, "id", columns=["a"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<id:bigint,a:string>" in plan
    assert plan.count("regexp_extract_all") == len(K.DETECTION_PATTERNS)
    rows = entity_rows(df, "id").filter(F.size("entities") > 0)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == len(K.DETECTION_PATTERNS)
