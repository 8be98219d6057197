"""Columns called like a result, with and without an underscore in front."""

import public_tokenizers
import pytest

from veilspark.llm import bpe, jaccard, lines, ppm, quality_rules, repeats, token_counts
from veilspark.llm.frames import kept_names

TEXTS = ["the red fox ran home\nover the hill", "the red fox ran home\nover the hill", "", None, "one more line of words here"]

OPERATORS = {
    "n_removed": lines.line_report,
    "ids": lines.line_report,
    "__doc": lines.line_report,
    "kept": quality_rules.quality_verdicts,
    "n_words": quality_rules.quality_verdicts,
    "k1": repeats.remove_repeats,
    "runs": repeats.remove_repeats,
    "component_id": jaccard.jaccard_components,
    "__rid": jaccard.jaccard_components,
    "n_tokens": lambda d: token_counts.token_counts(d, public_tokenizers.path("byte_bpe_50k.json")),
    "decoded": lambda d: bpe.bpe_round_trip(d, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN),
}


def test_names():
    assert kept_names(["kept", "_kept", "Other"], ["kept"]) == ["__kept", "_kept", "Other"]
    assert kept_names(["KEPT", "x"], ["kept", "_kept"]) == ["__KEPT", "x"]
    assert kept_names(["a", "_a"], ["a", "_a"]) == ["__a", "___a"]


@pytest.mark.parametrize("name", list(OPERATORS))
def test_clashing_columns(spark, name):
    rows = [(i, t, f"x{i}", f"y{i}") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, `{name}` string, `_{name}` string")
    plain = OPERATORS[name](docs.select("doc_id", "text"))
    found = OPERATORS[name](docs)
    assert len({c.lower() for c in found.columns}) == len(found.columns)
    mine = next(c for c in found.columns if c == f"__{name}" or c == f"___{name}" or (name.startswith("__") and c.lstrip("_") == name.lstrip("_")))
    results = [c for c in plain.columns if c not in ("text",)]
    old = {r["doc_id"]: tuple(r[c] for c in results) for r in plain.collect()}
    new = {r["doc_id"]: tuple(r[c] for c in results) for r in found.collect()}
    assert new == old
    assert {r["doc_id"]: r[mine] for r in found.collect()} == {i: f"x{i}" for i in range(len(TEXTS))}
    assert {r["doc_id"]: r[f"_{name}"] for r in found.collect()} == {i: f"y{i}" for i in range(len(TEXTS))}


@pytest.mark.parametrize("copies", [3, 49])
def test_known_words_of_equal_rows(spark, copies):
    """Held-out rows with the same id and text share a key in the join; the count stays whole."""
    held = next(i for i in range(100) if ppm_fold(i) == 1)
    seen = next(i for i in range(100) if ppm_fold(i) != 1)
    rows = [(seen, "known")] + [(held, "known strange odd")] * copies
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for most in (4_000_000, 0):
        got = [r["n_known"] for r in ppm.ppm_scores(docs, most_words=most).collect() if r["held_out"]]
        assert got == [2] * copies  # the word and the end


def ppm_fold(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 5
