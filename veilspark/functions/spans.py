"""Regex spans with code-point offsets, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from veilspark.functions.arrays import empty_array, let, running_totals

_HITS_DDL = "struct<tag:int,hits:array<string>,gaps:array<string>>"


_CUT = "\x01"


def _gaps(text: Column, regex: str) -> Column:
    """``split(text, regex, -1)``, which would compile a pattern anew for every text; a single
    character it takes as it is.  A text that holds this character is split by the pattern."""
    marked = F.split(F.regexp_replace(text, regex, _CUT), _CUT, -1)
    return F.when(F.contains(text, F.lit(_CUT)), F.split(text, regex, -1)).otherwise(marked)


def pattern_hits(text: Column, regex: str, tag: int = 0) -> Column:
    """Matches of one pattern and the text pieces between them, not yet located.

    A cell without a match costs one regex pass: the second one, which cuts the
    gaps, only runs when the first found something.
    """
    return let(
        F.regexp_extract_all(text, F.lit(regex), F.lit(0)),
        lambda h: F.struct(
            F.lit(tag).alias("tag"),
            h.alias("hits"),
            F.when(F.size(h) > 0, _gaps(text, regex)).alias("gaps"),
        ),
    )


def no_hits() -> Column:
    return empty_array(_HITS_DDL)


def locate(found: Column) -> Column:
    """``array<pattern_hits>`` -> ``array<struct<start,end,tag,text>>``.

    Offsets are lengths added up from the left, so they count code points.
    """

    def spans(one: Column, pieces: Column) -> Column:
        def place(p: Column, at: Column) -> Column:
            start = at + F.length(p["gap"])
            return F.struct(
                start.alias("start"),
                (start + F.length(p["hit"])).alias("end"),
                one["tag"].alias("tag"),
                p["hit"].alias("text"),
            )

        before = running_totals(pieces, lambda p: F.length(p["gap"]) + F.length(p["hit"]))
        return let(before, lambda b: F.transform(pieces, lambda p, i: place(p, F.get(b, i))))

    def one_pattern(one: Column) -> Column:
        zipped = F.arrays_zip(one["hits"].alias("hit"), one["gaps"].alias("gap"))
        return let(F.slice(zipped, 1, F.size(one["hits"])), lambda pieces: spans(one, pieces))

    return F.flatten(
        F.transform(F.filter(found, lambda one: F.size(one["hits"]) > 0), one_pattern)
    )


def find_spans(text: Column, regex: str) -> Column:
    """All non-overlapping matches of one pattern."""
    return locate(F.array(pattern_hits(text, regex)))


def cut_after_last(text: Column, regex: str) -> Column:
    """``text`` up to the end of the last match of ``regex``; empty without a match."""
    rest = F.element_at(_gaps(text, regex), -1)
    return F.when(
        F.rlike(text, F.lit(regex)),
        F.substring(text, F.lit(1), F.length(text) - F.length(rest)),
    ).otherwise(F.lit(""))


BLOCK = 1024


def blocks(text: Column) -> Column:
    """The text cut into blocks of ``BLOCK`` code points, in one pass.

    ``substring`` walks a string from its beginning; taking many pieces of a long
    text is only linear when each is taken from its own block.
    """
    short = F.length(text).between(1, BLOCK)
    return F.when(short, F.array(text)).otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))


def piece(parts: Column, start: Column, length: Column) -> Column:
    """``text[start:start + length]`` from the blocks of ``text``."""
    first = F.floor(start / F.lit(BLOCK)).cast("int")
    last = F.floor((start + length) / F.lit(BLOCK)).cast("int")
    near = F.array_join(F.slice(parts, first + 1, last - first + 1), "")
    return F.when(
        length > 0, F.substring(near, start - first * BLOCK + 1, length)
    ).otherwise(F.lit(""))
