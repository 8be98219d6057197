import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from veilspark.operators import risk
from veilspark.operators.cells import cells
from veilspark.operators.detect import detect
from veilspark.operators.gazetteer import (
    MAX_GAP, _runs, _table, gazetteer_entities, measured, rows_of, term_hits, with_gazetteer,
)
from veilspark.operators.keyfilter import key_test
from veilspark.operators.mask import mask, mask_detections

TEXTS = [
    "John Doe works at Acme  Corp in New\nYork.",
    "new york is not New York; New York City is",
    "é New York é",
    None,
]
TERMS = [
    ("New York", "GPE"), ("New York City", "GPE"), ("Acme Corp", "ORG"), ("John Doe", "PERSON"),
    ("works", "VERB"), ("--", "ORG"), ("New  York", "LOC"),
]


@pytest.fixture
def found(spark, texts):
    terms = spark.createDataFrame(TERMS, "term string, label string")

    def run(**options):
        return gazetteer_entities(texts(TEXTS), "id", terms, **options)

    return run


def test_terms_with_offsets(found):
    got = sorted((r.row_id, r.start, r.end, r.text, r.label, r.type) for r in found().collect())
    assert got == [
        (0, 0, 8, "John Doe", "PERSON", "name"),
        (0, 18, 28, "Acme  Corp", "ORG", "organization"),
        (0, 32, 40, "New\nYork", "GPE", "location"),
        (1, 16, 24, "New York", "GPE", "location"),
        (1, 26, 39, "New York City", "GPE", "location"),
        (2, 2, 10, "New York", "GPE", "location"),
    ]
    for r in found().collect():
        assert TEXTS[r.row_id][r.start:r.end] == r.text


def test_large_dictionary_path_is_the_same(found):
    plan = found(broadcast_terms=0)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "salt" in plan
    assert sorted(found(broadcast_terms=0).collect()) == sorted(found().collect())


def test_only_runs_that_are_terms_leave_the_task(spark, texts):
    """A long term that begins with a frequent word does not multiply the text."""
    long = " ".join(["the", *[f"w{i}" for i in range(60)]])
    terms = measured(spark.createDataFrame([(long, "ORG"), ("the end", "GPE")], "term string, label string"), 0)
    said = " ".join(["the cat sat by"] * 300)
    df = texts([f"{said} the end", f"{long} {said}", ""])
    runs = _runs(cells(df, "id"), terms)
    assert runs.count() < 50
    cut = _runs(cells(df, "id"), terms, most_chars=1)
    assert sorted(cut.collect()) == sorted(runs.collect())
    got = sorted((r.row_id, r.text, r.label) for r in gazetteer_entities(df, "id", terms).collect())
    assert got == [(0, "the end", "GPE"), (1, long, "ORG")]


def test_dictionary_wins_and_order_is_kept(found, texts):
    df = texts(TEXTS)
    both = with_gazetteer(detect(df, "id"), found())
    first = both.filter("row_id = 0").orderBy("ent_ord").collect()
    assert [(r.start, r.text, r.method) for r in first][0] == (0, "John Doe", "gazetteer")
    assert [r.ent_ord for r in first] == list(range(len(first)))
    assert [r.start for r in first] == sorted(r.start for r in first)
    levels = {r.row_id: r.n_pairs for r in risk.row_risk(rows_of(df, "id", both)).collect()}
    assert levels[2] == 0 and levels[0] >= 3


def brute(text, terms):
    """Longest hits by trying every run of words."""
    words = [(m.start(), m.end()) for m in re.finditer(r"[^\W]+", text)]
    hits = []
    for i in range(len(words)):
        for j in range(i, len(words)):
            run = words[i : j + 1]
            if all(b[0] - a[1] <= MAX_GAP for a, b in zip(run, run[1:])):
                label = terms.get(" ".join(text[a:b] for a, b in run))
                if label:
                    hits.append((run[0][0], run[-1][1], label))
    return sorted(
        (text[a:b], label, a, b) for a, b, label in hits
        if not any((c, d) != (a, b) and c <= a and b <= d for c, d, _ in hits)
    )


def test_longest_hits_against_brute_force():
    rng = random.Random(3)
    words = ["a", "b", "B", "c_1", "é", "ß", "½", "x"]
    terms = {" ".join(rng.choices(words, k=rng.randint(1, 4))): rng.choice(["ORG", "GPE"]) for _ in range(30)}
    for _ in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", ", ", " -- ", "\n\n\n", "    "]) for _ in range(12))
        assert sorted(term_hits(text, _table(list(terms.items())))) == brute(text, terms)
    assert term_hits(None, {}) == [] and term_hits("", _table([("a", "ORG")])) == []


def test_gap_is_bounded(spark, texts):
    terms = spark.createDataFrame([("New York", "GPE")], "term string, label string")
    df = texts(["New - York", "New ... York", "New" + " " * 500 + "York"])
    for n in (0, 10):
        assert [r.row_id for r in gazetteer_entities(df, "id", terms, broadcast_terms=n).collect()] == [0]


@pytest.mark.parametrize("limit", [200_000, 0])
def test_dictionary_through_detection_and_masking(spark, texts, limit):
    """Both ways give what the union of detections gives; both mask every hit."""
    terms = measured(spark.createDataFrame(TERMS, "term string, label string"), limit)
    df = texts(TEXTS)
    got = detect(df, "id", dictionary=terms)
    want = with_gazetteer(detect(df, "id"), gazetteer_entities(df, "id", terms))
    fields = ["row_id", "ent_ord", "column", "start", "end", "text", "label", "type", "confidence", "method"]
    assert sorted(map(tuple, got.select(fields).collect())) == sorted(map(tuple, want.select(fields).collect()))
    masked = {r.id: r.t for r in mask(df, "id", dictionary=terms).collect()}
    assert masked == {0: "*** works at *** in ***.", 1: "new york is not ***; ***", 2: "é *** é", 3: None}
    if terms.small:
        assert "Exchange" not in mask(df, "id", dictionary=terms)._jdf.queryExecution().executedPlan().toString()


def test_model_before_dictionary_before_patterns(spark, texts):
    def tagger(batches):
        for batch in batches:
            yield pd.Series([[{"text": "John Doe", "label": "GPE", "start": 0, "end": 8}] for _ in batch])

    terms = spark.createDataFrame([("John Doe", "ORG"), ("Jane Roe", "ORG"), ("10001", "ZIP")], "term string, label string")
    got = detect(texts(["John Doe, Jane Roe, 10001"]), "id", model=tagger, dictionary=terms).collect()
    assert [(r.text, r.type, r.method) for r in got] == [
        ("John Doe", "location", "model_ner"), ("Jane Roe", "organization", "gazetteer"), ("10001", "zip", "gazetteer"),
    ]


def test_empty_dictionary(spark, texts):
    none = spark.createDataFrame([], "term string, label string")
    assert gazetteer_entities(texts(TEXTS), "id", none).collect() == []
    assert gazetteer_entities(texts(TEXTS), "id", none, broadcast_terms=-1).collect() == []


def test_rows_without_findings_are_not_shuffled(spark):
    """The bitmap holds every key put in, whatever its size; masks are the same with any."""
    keys = spark.range(0, 5000, 7).toDF("row_id")
    for bits in (32_768, 1 << 24):
        test = key_test(keys, "row_id", bits)
        passed = {r.id for r in spark.range(5000).filter(test(F.col("id"))).collect()}
        assert set(range(0, 5000, 7)) <= passed
    assert len(passed) < 1500
    df = spark.range(200).selectExpr("id", "if(id % 50 = 3, 'call 85001', 'nothing') as t")
    out = mask_detections(df, "id", detect(df, "id"))
    assert {r.id: r.t for r in out.collect()} == {i: "call ***" if i % 50 == 3 else "nothing" for i in range(200)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan
