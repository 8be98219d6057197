"""Row risk: pair counts, sensitive categories, context score, overall level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veilspark import constants as K
from veilspark.functions.arrays import constant, let
from veilspark.operators.proximity import pair_risk, window_pairs


def sensitive_categories(text: Column) -> Column:
    """Keyword categories present in a text, with the number of keywords found."""

    table = constant(
        [{"category": c, "words": words} for c, words in K.CONTEXT_KEYWORDS.items()]
    )

    def counted(low: Column) -> Column:
        counts = F.transform(
            table,
            lambda t: F.struct(
                t["category"].alias("category"),
                F.size(F.filter(t["words"], lambda w: F.contains(low, w)))
                .alias("indicator_count"),
            ),
        )
        return F.filter(counts, lambda c: c["indicator_count"] > 0)

    return let(F.lower(text), counted)


def context_score(categories: Column) -> Column:
    total = F.aggregate(categories, F.lit(0), lambda acc, c: acc + c["indicator_count"])
    return F.least(total / F.lit(10.0), F.lit(1.0))


def overall_risk(pairs: Column, high: Column, medium: Column, score: Column) -> Column:
    """A row without pairs is low whatever its context says."""
    return (
        F.when(pairs == 0, F.lit("low"))
        .when((high > 0) | (score > 0.7), F.lit("high"))
        .when((medium > 2) | (score > 0.4), F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def context_scores(df: DataFrame, key: str, text: Column) -> DataFrame:
    """Context analysis of any text column, one row per input row."""
    found = let(
        sensitive_categories(text),
        lambda c: F.struct(
            c.alias("sensitive_categories"), context_score(c).alias("context_score")
        ),
    )
    return df.select(F.col(key).alias("row_id"), F.inline(F.array(found)))


def risk_struct(row_text: Column, pairs: Column, window: int) -> Column:
    """Everything known about one row's risk, as a struct, from its window pairs."""
    levels = F.transform(
        F.coalesce(pairs, F.array()),
        lambda p: pair_risk(p["hot"], p["distance"], window),
    )

    def count(found: Column, level: str) -> Column:
        return F.size(F.filter(found, lambda r: r == level))

    counts = let(
        levels,
        lambda found: F.struct(
            F.size(found).alias("n_pairs"),
            *[count(found, r).alias(f"n_{r}") for r in ("high", "medium", "low")],
        ),
    )

    def judged(x: Column) -> Column:
        score = context_score(x["cats"])
        n = x["n"]
        return F.struct(
            n["n_pairs"].alias("n_pairs"),
            n["n_high"].alias("n_high"),
            n["n_medium"].alias("n_medium"),
            n["n_low"].alias("n_low"),
            x["cats"].alias("sensitive_categories"),
            score.alias("context_score"),
            overall_risk(n["n_pairs"], n["n_high"], n["n_medium"], score).alias("overall_risk"),
        )

    return let(
        F.struct(counts.alias("n"), sensitive_categories(row_text).alias("cats")), judged
    )


def row_risk(rows: DataFrame, window: int = K.WINDOW) -> DataFrame:
    """Risk of each row that has entities (map-only)."""
    pairs = window_pairs(F.col("entities"), window)
    risk = risk_struct(F.col("row_text"), pairs, window)
    return rows.select("row_id", F.inline(F.array(risk)))
