"""Masking of very many names in one cell."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tests import plain
from veilspark import constants as K
from veilspark.operators import mask as M


def by_hand(text):
    for name in dict.fromkeys(plain.DETECT["name"].findall(text)):
        text = text.replace(name, K.MASK)
    return text


def crowded(seed, n):
    """Names of few and short words, so that they overlap, contain and follow each other."""
    rng = random.Random(seed)
    words = ["Ann", "Anna", "Lee", "Leeds", "Lees", "Bo", "Bob", "Jo", "JoAnn", "McBob", "Émil", "X", "de", "Bo1", "Lee_", "the"]
    glue = [" ", " ", " ", " ", "  ", ", ", "\n", ". ", "-", " é "]
    return "".join(rng.choice(words) + rng.choice(glue) for _ in range(n))


@pytest.mark.parametrize("many", [0, 3, 64])
def test_equal_to_plain(texts, monkeypatch, many):
    monkeypatch.setattr(M, "MANY_NAMES", many)
    items = [crowded(s, 3 + 7 * s) for s in range(40)] + plain.noisy_texts(60, 3) + ["", "Ann Lee", "JoAnn Leeds Ann Lee"]
    got = texts(items).select("id", M.mask_names(F.col("t")).alias("m")).orderBy("id").collect()
    for row, item in zip(got, items, strict=True):
        assert row["m"] == by_hand(item), item


def test_many_names_in_one_cell(texts):
    rng = random.Random(4)

    def word():
        return rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") + "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))

    text = "; ".join(f"{word()} {word()}" for _ in range(20_000)) + " and McJohn Smithers met John Smith"
    df = texts([text]).select(M.mask_names(F.col("t")).alias("m"))
    want = by_hand(text)
    start = time.time()
    got = df.first()["m"]
    took = time.time() - start
    assert got == want
    assert took < 5, took


def test_one_long_run(texts):
    """Thousands of names without anything between them: one run, no stack of the regex engine."""
    text = " ".join(f"A{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} B{chr(97 + i // 676)}x" for i in range(6_000))
    assert texts([text]).select(M.mask_names(F.col("t")).alias("m")).first()["m"] == by_hand(text)
