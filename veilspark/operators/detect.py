"""Entity detection: eight patterns plus an optional model, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from veilspark import constants as K
from veilspark.functions.arrays import constant, empty_array, first_of_runs, let
from veilspark.functions.dialect import detection_regex
from veilspark.functions.spans import locate, no_hits, pattern_hits
from veilspark.operators.cells import _named, cell_array, chosen_columns, row_text
from veilspark.operators.gazetteer import LABELS, Terms, label_type, with_term_hits

HIT_DDL = "struct<text:string,label:string,start:int,end:int>"
ModelHook = Callable[[Iterator[pd.Series]], Iterator[pd.Series]]

_DIGIT = r"(?U)\d"


def _order(precedence: str) -> list[str]:
    if precedence == "reference":
        return list(K.DETECTION_PATTERNS)
    if precedence == "specific":
        return list(K.SPECIFIC_ORDER)
    raise ValueError("precedence is 'reference' or 'specific'")


def _regex_spans(text: Column, names: Sequence[str]) -> Column:
    """Located hits of the patterns; ``tag`` is the rank, 1 = strongest.

    Every pattern but ``email`` and ``name`` needs a digit, and an email needs an
    at sign, so two cheap tests spare most texts seven of the eight passes.
    """
    rank = {name: i + 1 for i, name in enumerate(names)}

    def hits(*wanted: str) -> Column:
        return F.array(*[pattern_hits(text, detection_regex(n), rank[n]) for n in wanted])

    digits = [n for n in names if n not in ("email", "name")]
    found = F.concat(
        F.when(F.contains(text, F.lit("@")), hits("email")).otherwise(no_hits()),
        F.when(F.rlike(text, F.lit(_DIGIT)), hits(*digits)).otherwise(no_hits()),
        hits("name"),
    )
    return locate(found)


def _given(hits: Column, rank: Callable[[Column, Column], Column]) -> Column:
    """Hits of a model or a dictionary as spans; ``rank`` of (place, number of hits)."""
    kept = F.filter(F.coalesce(hits, empty_array(HIT_DDL)), lambda h: h["label"].isin(LABELS))
    return let(
        kept,
        lambda hs: F.transform(
            hs,
            lambda h, i: F.struct(
                h["start"].cast("int").alias("start"),
                h["end"].cast("int").alias("end"),
                rank(i, F.size(hs)).cast("int").alias("rank"),
                h["text"].alias("text"),
                h["label"].alias("label"),
            ),
        ),
    )


def cell_spans(
    text: Column,
    precedence: str = "reference",
    model_hits: Column | None = None,
    term_hits: Column | None = None,
) -> Column:
    """Spans of one cell, first source wins, ordered by (start, source).

    ``array<struct<start,rank,end,text,label>>``; model hits carry ranks below 0,
    dictionary hits rank 0.
    """
    names = _order(precedence)
    labels = constant([n.upper() for n in names])
    raw = F.transform(
        _regex_spans(text, names),
        lambda s: F.struct(
            s["start"], s["end"], s["tag"].alias("rank"), s["text"],
            F.get(labels, s["tag"] - 1).alias("label"),
        ),
    )
    if term_hits is not None:
        raw = F.concat(_given(term_hits, lambda i, n: F.lit(0)), raw)
    if model_hits is not None:
        raw = F.concat(_given(model_hits, lambda i, n: i - n), raw)
    unique = let(
        F.array_sort(raw),
        lambda a: first_of_runs(
            a, lambda x, y: (x["start"] == y["start"]) & (x["end"] == y["end"])
        ),
    )
    return F.array_sort(
        F.transform(
            unique,
            lambda s: F.struct(s["start"], s["rank"], s["end"], s["text"], s["label"]),
        )
    )


def _entity(cell: Column, s: Column) -> Column:
    given = s["rank"] <= 0
    return F.struct(
        cell["column"].alias("column"),
        cell["col_idx"].alias("col_idx"),
        cell["base"].alias("base"),
        s["text"].alias("text"),
        s["label"].alias("label"),
        F.when(given, label_type(s["label"])).otherwise(F.lower(s["label"])).alias("type"),
        s["start"].alias("start"),
        s["end"].alias("end"),
        F.when(given, F.lit(K.MODEL_CONFIDENCE)).otherwise(F.lit(K.REGEX_CONFIDENCE))
        .alias("confidence"),
        F.when(s["rank"] < 0, F.lit(K.MODEL_METHOD)).when(given, F.lit(K.TERM_METHOD))
        .otherwise(F.lit(K.REGEX_METHOD)).alias("method"),
    )


def hidden(df: DataFrame, stem: str) -> str:
    """A prefix that no column of ``df`` begins with."""
    while any(c.lower().startswith(stem) for c in df.columns):
        stem = f"_{stem}"
    return stem


def _prepare(
    df: DataFrame, key: str, columns: Sequence[str] | None, offset_basis: str,
    model: ModelHook | None = None, dictionary: DataFrame | Terms | None = None,
) -> tuple[DataFrame, Column]:
    """The frame to select from and its array of cells."""
    chosen = chosen_columns(df, key, columns)
    base, given = df, {}
    if model is not None:

        def tag(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            return model(batches)

        tagger = F.pandas_udf(tag, f"array<{HIT_DDL}>")
        stem = hidden(base, "_model_hits_")
        names = {c: f"{stem}{i}" for i, c in enumerate(chosen)}
        base = base.select("*", *[tagger(_named(c).cast("string")).alias(n) for c, n in names.items()])
        given["model_hits"] = {c: F.col(n) for c, n in names.items()}
    if dictionary is not None:
        base, given["term_hits"] = with_term_hits(base, key, chosen, dictionary, hidden(base, "_term_hits_"))
    return base, cell_array(df, key, chosen, offset_basis, given)


def spans_of(c: Column, precedence: str, model: bool, dictionary: bool) -> Column:
    """Spans of a cell made by ``_prepare``."""
    return cell_spans(
        c["text"], precedence, c["model_hits"] if model else None, c["term_hits"] if dictionary else None
    )


def entity_array(
    cells: Column, precedence: str = "reference", with_model: bool = False, with_terms: bool = False
) -> Column:
    """All entities of a row in (column, start) order."""

    def of_cell(c: Column) -> Column:
        return F.transform(spans_of(c, precedence, with_model, with_terms), lambda s: _entity(c, s))

    filled = F.filter(cells, lambda c: c["text"].isNotNull() & (c["text"] != ""))
    return F.flatten(F.transform(filled, of_cell))


def detect(
    df: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    precedence: str = "reference",
    model: ModelHook | None = None,
    dictionary: DataFrame | Terms | None = None,
) -> DataFrame:
    """One row per detected entity.  Map-only; also works on a streaming frame.

    ``dictionary`` is a table (term, label) or ``gazetteer.measured`` of one; its hits
    come before those of the patterns.  A dictionary too large to be sent to every task
    is joined instead, and only rows that hold a term are then shuffled.

    ``model`` is an iterator-of-series function (as for ``pandas_udf``) that gets
    cell texts and yields lists of ``(text, label, start, end)``; load the model
    before its loop and it is loaded once per Python worker.
    """
    base, cells = _prepare(df, key, columns, "cell", model, dictionary)
    entities = entity_array(cells, precedence, model is not None, dictionary is not None)
    found = base.select(_named(key).alias("row_id"), F.posexplode(entities).alias("ent_ord", "e"))
    return found.select("row_id", "ent_ord", "e.*").drop("base")


def entity_rows(
    df: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    precedence: str = "reference",
    offset_basis: str = "cell",
    model: ModelHook | None = None,
    with_text: bool = True,
    dictionary: DataFrame | Terms | None = None,
) -> DataFrame:
    """Rows with at least one entity: ``row_id[, row_text], entities``.

    Everything that follows (pairs, inference, risk, graph) stays inside a row,
    so this is the one frame those steps start from, and none of them shuffles
    the text.  The generator filters and keeps the detection from being
    evaluated a second time by a pushed-down predicate.
    """
    base, cells = _prepare(df, key, columns, offset_basis, model, dictionary)
    entities = entity_array(cells, precedence, model is not None, dictionary is not None).alias("entities")
    row = F.struct(*([row_text(df, key).alias("row_text")] if with_text else []), entities)
    return base.select(
        _named(key).alias("row_id"),
        F.inline(F.filter(F.array(row), lambda r: F.size(r["entities"]) > 0)),
    )


def detections_of(rows: DataFrame) -> DataFrame:
    """``entity_rows`` back to one row per entity."""
    found = rows.select("row_id", F.posexplode("entities").alias("ent_ord", "e"))
    return found.select("row_id", "ent_ord", "e.*").drop("base")


def pattern_spans(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    """Raw spans of a single detection pattern, before any precedence."""
    found = df.select(
        _named(key).alias("row_id"),
        F.inline(locate(F.array(pattern_hits(_named(column), detection_regex(name))))),
    )
    return found.select("row_id", "start", "end", "text")
