"""Entities inferred from combinations in a row's text and from context words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veilspark import constants as K
from veilspark.functions.arrays import constant, let
from veilspark.functions.dialect import jvm_pattern
from veilspark.functions.spans import blocks, cut_after_last, locate, pattern_hits, piece

_LETTER = "[A-Z]"
_LONE = jvm_pattern(rf"(?<!{_LETTER}){_LETTER}(?!{_LETTER})", "i")
_ORG = rf"{_LETTER}{{2}}[A-Z\s]*\s{K.ORG_SUFFIX}"
_ORG_TAIL = jvm_pattern(rf"(?<={_LETTER}{{2}})\s+{K.ORG_SUFFIX}", "is")
_ZIP_ORG = jvm_pattern(
    rf"{K.ZIP_PART}(?:[^A-Z]++|(?!{_ORG}){_LETTER}[A-Z\s]*+)*+{_ORG}", "is", r"\d"
)
_SECOND_WORD = jvm_pattern(rf"(?<={_LETTER}{{2}}) {_LETTER}{{2,}}", "i")
_ORDER = list(K.COMBINATION_PATTERNS)


def _with_tail(text: Column, name: str, tail: str) -> Column:
    """A lazy "name ... number" pattern in linear time.

    Behind the last number nothing can match, so the text is cut there; every
    start that is left then finds its number.
    """
    regex = jvm_pattern(K.COMBINATION_PATTERNS[name], "is")
    cut = cut_after_last(text, jvm_pattern(tail, "is"))
    return let(cut, lambda t: pattern_hits(t, regex, _ORDER.index(name)))


def _address_with_name(text: Column) -> Column:
    """Behind the last two words joined by a space no name can end: cut there, or
    every street of a text without a name would search it to its end."""
    name = "address_with_name"
    regex = jvm_pattern(K.COMBINATION_PATTERNS[name], "is", r"\d")
    return let(cut_after_last(text, _SECOND_WORD), lambda t: pattern_hits(t, regex, _ORDER.index(name)))


def _zip_with_org(text: Column) -> Column:
    """Postal code followed by an organization, without deep regex recursion.

    A word of one letter ends an organization.  Once such letters are blotted out
    (length kept), an organization is two letters and any run of letters and
    spaces up to the suffix, which needs no nested repetition; and runs that
    hold no suffix can be skipped whole.
    """
    wanted = F.rlike(text, F.lit(r"(?U)\d{5}")) & F.rlike(text, F.lit(_ORG_TAIL))
    blotted = F.when(wanted, F.regexp_replace(text, _LONE, "#")).otherwise(F.lit(""))
    return let(
        let(blotted, lambda t: cut_after_last(t, _ORG_TAIL)),
        lambda t: pattern_hits(t, _ZIP_ORG, _ORDER.index("zip_with_org")),
    )


def combinations(text: Column) -> Column:
    """Every combination-pattern match in the row text as inferred entities."""
    found = F.array(
        _with_tail(text, "name_with_ssn", K.SSN_TAIL),
        _with_tail(text, "name_with_phone", K.PHONE_TAIL),
        _address_with_name(text),
        _zip_with_org(text),
    )
    names = constant(_ORDER)
    types = constant(
        [K.COMBINATION_TYPES.get(n, K.COMBINATION_DEFAULT_TYPE) for n in _ORDER]
    )
    blotted = _ORDER.index("zip_with_org")

    def inferred(s: Column, parts: Column) -> Column:
        written = piece(parts, s["start"], s["end"] - s["start"])
        return F.struct(
            F.when(s["tag"] == blotted, written).otherwise(s["text"]).alias("text"),
            F.get(types, s["tag"]).alias("type"),
            F.get(names, s["tag"]).alias("pattern"),
            F.lit(None).cast("array<string>").alias("context_indicators"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lit(K.PATTERN_CONFIDENCE).alias("confidence"),
            F.lit(K.PATTERN_METHOD).alias("method"),
            F.lit("high").alias("risk_level"),
        )

    return let(
        locate(found),
        lambda spans: let(
            F.when(F.size(spans) > 0, blocks(text)),
            lambda parts: F.transform(spans, lambda s: inferred(s, parts)),
        ),
    )


def _windows(row_text: Column, entities: Column, window: int) -> Column:
    """``array<struct<e, context>>``: each entity with half a window of row text
    on either side of it."""
    half = window // 2

    def one(e: Column, x: Column) -> Column:
        start = F.greatest(e["start"] + e["base"] - half, F.lit(0))
        end = F.least(e["end"] + e["base"] + half, x["length"])
        return F.struct(e.alias("e"), piece(x["parts"], start, end - start).alias("context"))

    text = F.struct(blocks(row_text).alias("parts"), F.length(row_text).alias("length"))
    return let(text, lambda x: F.transform(entities, lambda e: one(e, x)))


def keyword_table() -> Column:
    """All context keywords as one constant array of (category, keyword)."""
    return constant(
        [
            {"category": category, "keyword": word}
            for category, words in K.CONTEXT_KEYWORDS.items()
            for word in words
        ]
    )


def _keywords_in(text: Column, table: Column) -> Column:
    """Those keywords of ``table`` that stand in the lower-cased text."""
    return let(F.lower(text), lambda low: F.filter(table, lambda k: F.contains(low, k["keyword"])))


def indicators(context: Column, table: Column | None = None) -> Column:
    """``"category: keyword"`` of each keyword (of ``table``, if given) in the lower-cased context."""
    return F.transform(
        _keywords_in(context, keyword_table() if table is None else table),
        lambda k: F.concat(k["category"], F.lit(": "), k["keyword"]),
    )


def from_context(row_text: Column, entities: Column, window: int) -> Column:
    """Entities that stand near at least one context keyword.

    A context is a piece of the row's text, so only keywords of the row are looked for in it,
    and none is cut out of a row without any.
    """

    def near(words: Column) -> Column:
        seen = F.transform(
            _windows(row_text, entities, window),
            lambda x: F.struct(x["e"].alias("e"), indicators(x["context"], words).alias("ind")),
        )
        return F.when(F.size(words) > 0, F.filter(seen, lambda x: F.size(x["ind"]) > 0))

    return F.transform(
        F.coalesce(let(_keywords_in(row_text, keyword_table()), near), F.array()),
        lambda x: F.struct(
            x["e"]["text"].alias("text"),
            x["e"]["type"].alias("type"),
            F.lit(None).cast("string").alias("pattern"),
            x["ind"].alias("context_indicators"),
            (x["e"]["start"] + x["e"]["base"]).alias("start"),
            (x["e"]["end"] + x["e"]["base"]).alias("end"),
            F.lit(K.CONTEXT_CONFIDENCE).alias("confidence"),
            F.lit(K.CONTEXT_METHOD).alias("method"),
            F.lit("medium").alias("risk_level"),
        ),
    )


def inferred_array(row_text: Column, entities: Column, window: int) -> Column:
    """Pattern inferences, then context inferences, of one row."""
    return F.concat(combinations(row_text), from_context(row_text, entities, window))


def inferred(rows: DataFrame, window: int = K.WINDOW, kind: str = "all") -> DataFrame:
    """One row per inferred entity; ``kind`` is ``all``, ``pattern`` or ``context``."""
    text, entities = F.col("row_text"), F.col("entities")
    array = {
        "all": lambda: inferred_array(text, entities, window),
        "pattern": lambda: combinations(text),
        "context": lambda: from_context(text, entities, window),
    }[kind]()
    found = rows.select("row_id", F.posexplode(array).alias("inf_ord", "i"))
    return found.select("row_id", "inf_ord", "i.*")


def contexts(rows: DataFrame, window: int = K.WINDOW) -> DataFrame:
    """Context window and its indicators, one row per entity."""

    def of(x: Column) -> Column:
        return F.struct(
            x["e"]["type"].alias("type"),
            x["context"].alias("context"),
            indicators(x["context"]).alias("indicators"),
        )

    seen = F.transform(_windows(F.col("row_text"), F.col("entities"), window), of)
    found = rows.select("row_id", F.posexplode(seen).alias("ent_ord", "c"))
    return found.select("row_id", "ent_ord", "c.*")
