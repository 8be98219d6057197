"""Quality rules with weak supervision, in DataFrame expressions only.

Each rule votes keep (1), reject (-1) or abstains (0).  Expectation
maximisation over the counts of vote patterns estimates how accurate every rule
is when a text is good and when it is bad; a text's posterior probability of
being good replaces the demand that all rules pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from veilspark.llm.frames import fresh, kept_names
from veilspark.sources.stage import staged

SPACE = " \t\n\x0b\x0c\r"
RUN = r"[\x20\x09-\x0D]+"
WINDOW = 8
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_distinct"]


def with_measures(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` with a struct of the counts in ``MEASURES``.

    Words are runs of characters outside ``[\\x20\\x09-\\x0D]``.  Every step that is
    used twice is a column of its own, so nothing is evaluated twice.
    """
    words, lines, h, grams, repeated, at = fresh(docs, "__words", "__lines", "__h", "__grams", "__repeated", "__at")
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    cut = F.btrim(value, F.lit(SPACE))
    out = docs.withColumns({
        words: F.when(cut == "", F.array().cast("array<string>")).otherwise(F.split(cut, RUN)),
        lines: F.filter(F.split(value, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""),
    })
    out = out.withColumn(h, F.when(F.size(words) > WINDOW, F.transform(words, lambda w: F.xxhash64(w))))
    # hash of 2, 4, 8 consecutive words, by doubling
    step = 1
    while step < WINDOW:
        size = F.size(h) - F.lit(step)
        out = out.withColumn(h, F.zip_with(F.slice(h, 1, size), F.slice(h, step + 1, size), lambda a, b: F.xxhash64(a, b)))
        step *= 2
    out = out.withColumn(grams, F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    twin = lambda e, i: F.coalesce(F.get(grams, i - 1)["x"] == e["x"], F.lit(False)) | F.coalesce(F.get(grams, i + 1)["x"] == e["x"], F.lit(False))
    out = out.withColumn(at, F.sort_array(F.transform(F.filter(grams, twin), lambda e: e["i"])))
    steps = F.zip_with(F.slice(at, 1, F.size(at) - 1), F.slice(at, 2, F.size(at) - 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    out = out.withColumn(repeated, F.when(F.col(at).isNull(), F.lit(0)).otherwise(F.aggregate(steps, F.lit(0), lambda s, x: s + x) + WINDOW))
    measure = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.length(value) - F.length(F.regexp_replace(value, "[#*$%&|<>]+", "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": F.col(repeated),
        "n_lines": F.size(lines),
        "n_upper": F.length(value) - F.length(F.regexp_replace(value, "[A-Z]+", "")),
        "n_distinct": F.size(F.array_distinct(words)),
    }
    made = F.struct(*[measure[m].cast("long").alias(m) for m in MEASURES])
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], made.alias(name))


def votes(m: Column) -> list[Column]:
    """The rules over a struct of measures; each gives -1, 0 or 1.

    Most rules know one defect and abstain without it; the last knows prose.
    """
    words = F.greatest(m["n_words"], F.lit(1))

    def rule(bad: Column, good: Column = F.lit(False)) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    # long texts repeat words by nature
    monotonous = (20 * m["n_distinct"] < words) | ((4 * m["n_distinct"] < words) & (words <= 1000))
    prose = (
        (m["n_words"] >= 20) & m["word_chars"].between(3 * words, 10 * words) & (20 * m["n_symbols"] <= words)
        & (100 * m["n_repeat_words"] <= 30 * words) & (10 * m["n_upper"] <= 2 * m["word_chars"])
        & (10 * m["n_dup_lines"] <= F.greatest(2 * m["n_lines"], F.lit(20))) & ~monotonous
    )
    return [
        rule(m["n_words"] < 20),
        rule((m["word_chars"] < 2 * words) | (m["word_chars"] > 15 * words)),
        rule(10 * m["n_symbols"] > words),
        rule((m["n_lines"] >= 6) & (100 * m["n_dup_lines"] > 30 * m["n_lines"])),
        rule(100 * m["n_repeat_words"] > 30 * m["n_words"]),
        rule(10 * m["n_upper"] > 3 * m["word_chars"]),
        rule(monotonous),
        rule(F.lit(False), prose),
    ]


OUTCOMES = (-1, 0, 1)


@dataclass
class Model:
    """Prior of good and, by rule, how often it rejects, abstains and keeps among
    good and among bad texts."""

    prior: float
    on_good: list[tuple[float, float, float]]
    on_bad: list[tuple[float, float, float]]

    def accuracies(self) -> list[float]:
        """Probability that a vote is right, by rule, where it votes at all."""
        out = []
        for g, b in zip(self.on_good, self.on_bad, strict=True):
            right = self.prior * g[2] + (1 - self.prior) * b[0]
            wrong = self.prior * g[0] + (1 - self.prior) * b[2]
            out.append(right / (right + wrong))
        return out

    def weights(self) -> list[tuple[float, float, float]]:
        """Log-odds of each outcome of each rule."""
        return [tuple(math.log(x / y) for x, y in zip(g, b, strict=True)) for g, b in zip(self.on_good, self.on_bad, strict=True)]

    def posterior(self, pattern) -> float:
        x = math.log(self.prior / (1 - self.prior))
        for v, w in zip(pattern, self.weights(), strict=True):
            x += w[v + 1]
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))


def fit(patterns: list[tuple[tuple[int, ...], int]], rules: int, rounds: int = 60) -> Model:
    """Expectation maximisation over counted vote patterns (at most ``3 ** rules``).

    It starts from the majority of votes.  Counts are smoothed, and a reject may
    not be likelier on good texts nor a keep on bad ones, else the two classes
    could swap their meaning.
    """
    even = (1 / 3, 1 / 3, 1 / 3)
    model = Model(0.5, [even] * rules, [even] * rules)
    good = {p: 1 / (1 + math.exp(-(3.0 * sum(p) + 0.5))) for p, _ in patterns}
    for _ in range(rounds if patterns else 0):
        total = sum(n for _, n in patterns)
        mass = sum(n * good[p] for p, n in patterns)
        on_good, on_bad = [], []
        for j in range(rules):
            g = [1 + sum(n * good[p] for p, n in patterns if p[j] == v) for v in OUTCOMES]
            b = [1 + sum(n * (1 - good[p]) for p, n in patterns if p[j] == v) for v in OUTCOMES]
            g, b = [x / sum(g) for x in g], [x / sum(b) for x in b]
            g[0], b[0] = min(g[0], b[0]), max(g[0], b[0])
            g[2], b[2] = max(g[2], b[2]), min(g[2], b[2])
            on_good.append(tuple(x / sum(g) for x in g))
            on_bad.append(tuple(x / sum(b) for x in b))
        model = Model(min(0.99, max(0.01, mass / total)), on_good, on_bad)
        good = {p: model.posterior(p) for p, _ in patterns}
    return model


def _judged(measured: DataFrame, name: str) -> tuple[DataFrame, str, str, Model]:
    """Measured rows with the columns ``base_failed`` and posterior, under fresh names."""
    pattern, failed, posterior = fresh(measured, "__votes", "base_failed", "posterior")
    m = F.col(f"`{name}`")
    rules = votes(m)
    counts = measured.groupBy(F.array(*rules).alias(pattern)).count().collect()
    model = fit(sorted((tuple(r[pattern]), r["count"]) for r in counts), len(rules))
    odds = F.lit(math.log(model.prior / (1 - model.prior)))
    for rule, (reject, abstain, keep) in zip(rules, model.weights(), strict=True):
        odds = odds + F.when(rule == 1, keep).when(rule == -1, reject).otherwise(abstain)
    out = measured.withColumns({
        failed: (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"]),
        posterior: 1 / (1 + F.exp(-odds)),
    })
    return out, failed, posterior, model


def quality_verdicts(docs: DataFrame, text: str = "text", keep: list[str] | None = None, least: float = 0.5) -> DataFrame:
    """Columns ``keep`` (all but the text by default), the measures, ``base_failed``
    (fewer than 20 words, or over 30 % of the words in repeated 8-word windows),
    ``posterior`` and ``kept``: not ``base_failed`` and a posterior of at least
    ``least``.

    A null or empty text has no words and fails.  Rules are fitted on all rows;
    equal texts get equal results, an empty table an empty result.  Kept columns
    called like a result get underscores in front until they differ.  No shuffle of texts:
    measures are staged without the text, and only counts of vote patterns (at
    most 3 to the number of rules) reach the driver.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    names = kept_names(keep, (*MEASURES, "base_failed", "posterior", "kept", "m", "__text"))
    source = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text}`").alias("__text"))
    measured = staged(with_measures(source, "__text", "m").drop("__text"))
    out, failed, posterior, _ = _judged(measured, "m")
    return out.select(
        *[F.col(f"`{n}`") for n in names], *[F.col(f"m.{c}").alias(c) for c in MEASURES], F.col(failed).alias("base_failed"),
        F.col(posterior).alias("posterior"), (~F.col(failed) & (F.col(posterior) >= least)).alias("kept"),
    )


def good_rows(docs: DataFrame, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``quality_verdicts`` keeps; columns unchanged."""
    m, = fresh(docs, "__measures")
    measured = staged(with_measures(docs, text, m))
    out, failed, posterior, _ = _judged(measured, m)
    return out.filter(~F.col(failed) & (F.col(posterior) >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])
