"""Presentation scalars: sanitizing, badges, percentages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from veilspark import constants as K
from veilspark.functions.arrays import lookup

_BLANK = r"[\t\n\x0B\f\r\uFEFF\u2028\u2029\p{Zs}]+"


def sanitize_text(text: Column) -> Column:
    """Without angle brackets, ``javascript:`` and ``on...=``, trimmed; '' for NULL."""
    for pattern in (r"[<>]", r"(?i)javascript:", r"(?i)on\w+=", f"^{_BLANK}|{_BLANK}$"):
        text = F.regexp_replace(text, pattern, "")
    return F.coalesce(text, F.lit(""))


def sanitize_filename(name: Column) -> Column:
    return F.regexp_replace(name, "[^a-zA-Z0-9._-]", "_")


def risk_badge(risk: Column) -> Column:
    letters = F.regexp_replace(F.lower(risk), "[^a-zA-Z]", "")
    return lookup(K.RISK_BADGES, letters, K.DEFAULT_BADGE)


def score_percent(score: Column) -> Column:
    return F.format_string("%.1f%%", score * 100)
