import random

import pytest
from pyspark.sql import functions as F

from tests.test_detect import sample  # noqa: F401
from veilspark import constants as K
from veilspark.operators import risk
from veilspark.operators.detect import detect, entity_rows
from veilspark.operators.gazetteer import rows_of
from veilspark.operators.proximity import assess, band_pairs, relations

DETECTION_DDL = (
    "row_id long, ent_ord int, column string, col_idx int, text string, label string, "
    "type string, start int, end int, confidence double, method string"
)
# Kinds in another order than any pattern table has, with gaps chosen for the window of 50.
SENTENCE = (
    "Parcel 7 for 5 Birch Walk: call 0161 555 0199 before noon, card 5105105105105100, "
    "ask for Edda Lind (edda@lind.example)."
)
HAND_MADE = [
    (x, kind, SENTENCE.index(x), SENTENCE.index(x) + len(x))
    for x, kind in [
        ("5 Birch Walk", "address"), ("0161 555 0199", "phone"), ("5105105105105100", "credit_card"),
        ("Edda Lind", "name"), ("edda@lind.example", "email"),
    ]
]


def detections(spark, per_row):
    rows = [
        (r, i, "t", 0, text, ty.upper(), ty, s, e, 0.8, "regex")
        for r, found in per_row.items()
        for i, (text, ty, s, e) in enumerate(found)
    ]
    return spark.createDataFrame(rows, DETECTION_DDL)


def test_hand_made_sentence(spark):
    df = spark.createDataFrame([(0, SENTENCE)], "id long, t string")
    rows = rows_of(df, "id", detections(spark, {0: HAND_MADE}))
    got = {(r.ord1, r.ord2): r for r in relations(rows).collect()}
    # starts 13, 32, 64, 90, 101: all pairs within 50
    assert set(got) == {(0, 1), (1, 2), (2, 3), (2, 4), (3, 4)}
    assert got[(0, 1)].text_between == ": call "
    levels = {(r.ord1, r.ord2): r.risk_level for r in assess(relations(rows)).collect()}
    assert levels == {(0, 1): "medium", (1, 2): "low", (2, 3): "high", (2, 4): "low", (3, 4): "high"}
    r = risk.row_risk(rows).first()
    assert (r.n_pairs, r.n_high, r.overall_risk) == (5, 2, "high")


def random_rows(seed, n_rows=40, longest=150):
    rng = random.Random(seed)
    out = {}
    for r in range(n_rows):
        starts = sorted(rng.randint(0, 900) for _ in range(rng.randint(1, longest)))
        out[r] = [
            (f"x{i}", rng.choice(["name", "phone", "email"]), s, s + rng.randint(1, 30))
            for i, s in enumerate(starts)
        ]
        rng.shuffle(out[r])
    return out


@pytest.mark.parametrize("window", [0, 7, 50])
def test_pairs_equal_brute_force(spark, window):
    data = random_rows(window)
    text = "".join(chr(97 + i % 26) for i in range(1000))
    df = spark.createDataFrame([(r, text) for r in data], "id long, t string")
    found = detections(spark, data)
    want = {}
    for r, ents in data.items():
        for i, a in enumerate(ents):
            for j in range(i + 1, len(ents)):
                b = ents[j]
                if abs(a[2] - b[2]) <= window:
                    between = text[min(a[3], b[3]):max(a[2], b[2])]
                    want[(r, i, j)] = (abs(a[2] - b[2]), between)
    tiled = {
        (x.row_id, x.ord1, x.ord2): (x.distance, x.text_between)
        for x in relations(rows_of(df, "id", found), window).collect()
    }
    assert tiled == want
    joined = {(x.row_id, x.ord1, x.ord2): x.distance for x in band_pairs(found, window).collect()}
    assert joined == {k: v[0] for k, v in want.items()}


def test_one_crowded_row(spark):
    """All entities of a big row at one place: still every pair, once."""
    data = {0: [(f"x{i}", "name", 5, 9) for i in range(120)], 1: [("y", "name", 0, 3)]}
    df = spark.createDataFrame([(0, "a" * 20), (1, "b")], "id long, t string")
    rows = rows_of(df, "id", detections(spark, data))
    assert relations(rows).count() == 120 * 119 // 2
    assert band_pairs(detections(spark, data)).count() == 120 * 119 // 2


def test_band_join_sends_no_side_through_the_driver(spark):
    """A small scan may hold very many detections: neither side is collected and broadcast."""
    data = {0: [("a", "name", 5, 9), ("b", "email", 12, 15)], 1: [("y", "name", 0, 3)]}
    plan = band_pairs(detections(spark, data))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert [tuple(r) for r in band_pairs(detections(spark, data)).collect()] == [(0, 0, 1, "name", "email", 7)]


def test_risk_rules(spark):
    three_medium = [("a", "email", 0, 3), ("b", "phone", 4, 6), ("c", "ssn", 8, 9)]
    two = [("a", "email", 0, 3), ("b", "phone", 4, 6)]
    far = [("a", "email", 0, 3), ("b", "phone", 30, 36)]
    words = "ssn social security patient doctor salary wage income email phone"
    cases = {
        0: (three_medium, "plain text here", "medium"),
        1: (two, "plain text here", "low"),
        2: (far, "plain", "low"),
        3: (two, words, "high"),
        4: (two, "ssn patient salary wage income", "medium"),
        5: ([("a", "email", 0, 3)], words, "low"),
    }
    df = spark.createDataFrame([(k, v[1]) for k, v in cases.items()], "id long, t string")
    found = detections(spark, {k: v[0] for k, v in cases.items()})
    got = {r.row_id: r for r in risk.row_risk(rows_of(df, "id", found)).collect()}
    assert {k: got[k].overall_risk for k in cases} == {k: v[2] for k, v in cases.items()}
    assert got[2].n_low == 1 and got[0].n_medium == 3
    assert [c.category for c in got[3].sensitive_categories] == [
        "personal_identifiers", "contact_info", "medical", "employment",
    ]
    assert got[3].context_score == pytest.approx(0.9)


def test_offset_basis(spark):
    df = spark.createDataFrame([(0, "Otto Klein", None, "Edda Lind")], "row_id long, a string, b string, c string")
    near = relations(entity_rows(df, "row_id")).first()
    real = relations(entity_rows(df, "row_id", offset_basis="row")).first()
    assert near.distance == 0  # two columns, both at their start
    assert real.distance == len("Otto Klein") + 1 and real.text_between == " "


def test_assess_skips_untyped(spark):
    d = detections(spark, {0: [("a", "name", 0, 1), ("b", "ssn", 2, 3)]})
    d = d.withColumn("type", F.when(F.col("ent_ord") == 0, F.col("type")))
    assert assess(band_pairs(d)).count() == 0


def test_rows_of_round_trip(sample):  # noqa: F811
    direct = entity_rows(sample, "row_id")
    again = rows_of(sample, "row_id", detect(sample, "row_id"))
    assert sorted(map(str, direct.collect())) == sorted(map(str, again.collect()))
    assert direct.count() == 4
    assert K.WINDOW == 50
