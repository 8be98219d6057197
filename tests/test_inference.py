import random
import time

from tests import plain
from veilspark import constants as K
from veilspark.operators.inference import combinations, contexts, inferred
from veilspark.operators.detect import entity_rows

WORDS = [
    "John Doe", "al bo", "x y", "a", "I", "Acme", "corp", "Corp", "inc", "include", "LLC", "ltd.",
    "Company", "Corporation", "12345", "12345-6789", "1234567890123", "123-45-6789", "123 45 6789",
    "+1 555-123-4567", "(555)123.4567", "12 Main St", "7 long winding Street", "99 a b drive",
    "Rd", "Ave", ".", ",", "-", "\n", "  ", "é", "éa", "aé bc", "Kk", "ſs", "_", "#", "5", "Big B Inc",
]


def noise(n, seed):
    rng = random.Random(seed)
    return [
        rng.choice([" ", " ", "", "\n"]).join(rng.choice(WORDS) for _ in range(rng.randint(1, 16)))
        for _ in range(n)
    ]


NOISE = noise(3000, 7) + plain.noisy_texts(1000, 8)


def test_combinations_equal_python(texts):
    df = texts(NOISE).selectExpr("id as row_id", "t")
    found = df.select("row_id", combinations(df["t"]).alias("c")).collect()
    for row in found:
        t = NOISE[row.row_id]
        for name in K.COMBINATION_PATTERNS:
            got = [(c.start, c.end, c.text) for c in row.c if c.pattern == name]
            assert got == plain.spans(plain.COMBINE[name], t), (name, t)


def test_long_texts_neither_hang_nor_overflow(texts):
    words = "lorem ipsum " * 4000
    cases = [
        words, "10001 " + words, words + "123-45-6789", "10001 " + words + "Acme Corp end",
        "1 " + words, "10001 " * 3000, "john doe " * 3000 + "555-123-4567",
    ]
    df = texts(cases).selectExpr("id as row_id", "t")
    got = {r.row_id: r.c for r in df.select("row_id", combinations(df["t"]).alias("c")).collect()}
    assert got[0] == [] and got[1] == []
    assert [(c.pattern, c.start, c.end) for c in got[2]] == [
        ("name_with_ssn", 0, len(cases[2])),
        ("name_with_phone", 0, 0),
    ][:1]
    org = [c for c in got[3] if c.pattern == "zip_with_org"]
    assert [(c.start, c.end) for c in org] == [(0, len(cases[3]) - 4)]
    assert [c.pattern for c in got[6]] == ["name_with_phone"]


def test_context(texts):
    half = K.WINDOW // 2
    t = "Patient record of John Doe, billing phone 555-123-4567" + " " * 60 + "85001"
    rows = entity_rows(texts([t]), "id")
    found = contexts(rows).orderBy("ent_ord").collect()
    for r, e in zip(found, plain.entities(t)):
        assert r.context == t[max(0, e[0] - half):e[2] + half]
    assert found[0].indicators == ["medical: patient"] or "medical: patient" in found[0].indicators
    inf = inferred(rows, kind="context").collect()
    assert {r.type for r in inf} == {"name", "phone"}
    assert all(r.confidence == 0.6 and r.risk_level == "medium" for r in inf)
    both = inferred(rows).orderBy("inf_ord").collect()
    assert [r.method for r in both][:1] == ["proximity_inference"]
    assert [r.inf_ord for r in both] == list(range(len(both)))


def test_streets_without_a_name_stay_linear(texts):
    listed = "1 " + "ast\n" * 150_000 + "9"
    short = ["1 " + "ast\n" * 50 + tail for tail in ("9", "al bo", "a bo", "al  bo", "al bo cd\n9", "St x Rd al bo Ave ef gh i")]
    cases = [listed, *short]
    df = texts(cases).selectExpr("id as row_id", "t")
    start = time.time()
    found = {r.row_id: r.c for r in df.select("row_id", combinations(df["t"]).alias("c")).collect()}
    assert time.time() - start < 30
    for i, t in enumerate(cases):
        got = [(c.start, c.end, c.text) for c in found[i] if c.pattern == "address_with_name"]
        assert got == ([] if t is listed else plain.spans(plain.COMBINE["address_with_name"], t)), i
