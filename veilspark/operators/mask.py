"""Masking: detected spans, then patterns, then names.  Map-only, any frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from veilspark import constants as K
from veilspark.functions.arrays import chunked, let
from veilspark.functions.dialect import detection_regex, mask_regex
from veilspark.functions.spans import blocks, piece
from veilspark.operators.cells import _named, chosen_columns
from veilspark.operators.detect import ModelHook, _prepare, hidden, spans_of
from veilspark.operators.gazetteer import Terms, attached
from veilspark.sources.stage import staged

SPAN_CHUNK = 64
MANY_NAMES = 64
# A run of capitalized words, and each two words in it that may hold a name between them.
_RUN = r"[A-Z][a-z]+(?: [A-Z][a-z]+)++"
_GAP = r"(?=([A-Z][a-z]+ [A-Z][a-z]))"


def mask_spans(text: Column, spans: Column) -> Column:
    """Replace each span by the mask, from the last start to the first.

    Spans are not merged: an earlier span that reaches past the start of a later
    one cuts the already masked text at its own old end.  Chunks of spans work on
    their own stretch of text; what a cut takes beyond it is carried as ``spill``
    and taken from the tail, so long texts are not copied once per span.
    """
    backwards = F.array_sort(
        F.transform(
            spans,
            lambda s: F.struct((-s["start"]).alias("back"), s["rank"], s["end"], s["start"]),
        )
    )

    def cut(state: Column, s: Column, lo: Column) -> Column:
        piece, start, end = state["piece"], s["start"] - lo, s["end"] - lo
        over = F.greatest(end - F.length(piece), F.lit(0))
        masked = F.concat(
            F.substring(piece, F.lit(1), start), F.lit(K.MASK),
            F.substring(piece, end + 1, F.length(piece)),
        )
        return F.struct(masked.alias("piece"), (state["spill"] + over).alias("spill"))

    def chunk(state: Column, part: Column, parts: Column) -> Column:
        def run(lo: Column) -> Column:
            stretch = piece(parts, lo, state["at"] - lo)
            first = F.struct(stretch.alias("piece"), F.lit(0).alias("spill"))
            return let(
                F.aggregate(part, first, lambda st, s: cut(st, s, lo)),
                lambda done: F.struct(
                    lo.alias("at"),
                    F.concat(
                        done["piece"],
                        F.when(done["spill"] == 0, state["tail"]).otherwise(
                            F.substring(
                                state["tail"], done["spill"] + 1, F.length(state["tail"])
                            )
                        ),
                    ).alias("tail"),
                ),
            )

        return let(F.element_at(part, -1)["start"], run)

    def folded(items: Column, parts: Column) -> Column:
        start = F.struct(F.length(text).alias("at"), F.lit("").alias("tail"))
        return F.aggregate(
            chunked(items, SPAN_CHUNK), start, lambda st, p: chunk(st, p, parts),
            lambda st: F.concat(F.substring(text, F.lit(1), st["at"]), st["tail"]),
        )

    masked = let(blocks(text), lambda parts: let(backwards, lambda b: folded(b, parts)))
    return F.when(F.size(spans) == 0, text).otherwise(masked)


def mask_merged(text: Column, spans: Column) -> Column:
    """Like ``mask_spans``, but overlapping spans become one mask."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(st: Column, s: Column, parts: Column) -> Column:
        apart = (s["start"] >= st["at"]) | (st["out"] == "")
        gap = piece(parts, st["at"], s["start"] - st["at"])
        return F.struct(
            F.when(apart, F.concat(st["out"], gap, F.lit(K.MASK))).otherwise(st["out"])
            .alias("out"),
            F.greatest(st["at"], s["end"]).alias("at"),
        )

    def folded(parts: Column) -> Column:
        return F.aggregate(
            spans, start, lambda st, s: step(st, s, parts),
            lambda st: F.concat(
                st["out"], piece(parts, st["at"], F.length(text) - st["at"])
            ),
        )

    return F.when(F.size(spans) == 0, text).otherwise(let(blocks(text), folded))


def mask_patterns(text: Column) -> Column:
    """Replace every masking-pattern match, pattern after pattern.

    Consecutive digit patterns share one test for a digit, and the email pattern
    needs an at sign, so a text without either passes untouched.
    """
    digit = F.lit(r"(?U)\d")

    def chain(t: Column, names: Sequence[str]) -> Column:
        for name in names:
            t = F.regexp_replace(t, mask_regex(name), K.MASK)
        return t

    def digits(t: Column, names: Sequence[str]) -> Column:
        return let(t, lambda x: F.when(F.rlike(x, digit), chain(x, names)).otherwise(x))

    order = list(K.MASK_PATTERNS)
    at = order.index("email")
    before = digits(text, order[:at])
    emails = let(
        before,
        lambda x: F.when(F.contains(x, F.lit("@")), chain(x, ["email"])).otherwise(x),
    )
    return digits(emails, order[at + 1:])


def _replaced(t: Column, names: Column) -> Column:
    return F.aggregate(names, t, lambda acc, n: F.replace(acc, n, F.lit(K.MASK)))


def _replaced_in_runs(t: Column, names: Column) -> Column:
    """``_replaced`` for very many names, without a pass over the text for each.

    A name lies within one run of capitalized words, and the mask holds no letter, so each
    run can be masked by itself.  Of the names only those count whose first word and two
    letters of the second one stand at a gap of the run; they are found in buckets by hash,
    about as many as the root of the number of names, and replaced in their old order.
    """
    n_buckets = F.ceil(F.sqrt(F.size(names))).cast("int")

    def number(key: Column) -> Column:
        return F.pmod(F.xxhash64(key), n_buckets)

    def item(n: Column, i: Column) -> Column:
        key = F.substring(n, F.lit(1), F.instr(n, " ") + 2)
        return let(key, lambda k: F.struct(i.alias("i"), n.alias("name"), k.alias("key"), number(k).alias("at")))

    def bucketed(items: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), n_buckets - 1), lambda b: F.filter(items, lambda x: x["at"] == b)
        )

    def run(r: Column, buckets: Column) -> Column:
        gaps = F.array_distinct(F.regexp_extract_all(r, F.lit(_GAP), F.lit(1)))
        met = F.transform(
            gaps,
            lambda g: F.filter(
                F.get(buckets, number(g).cast("int")), lambda x: (x["key"] == g) & F.contains(r, x["name"])
            ),
        )
        # sorted by their place in the list of names
        return _replaced(r, F.transform(F.array_sort(F.flatten(met)), lambda x: x["name"]))

    def joined(buckets: Column) -> Column:
        runs = F.regexp_extract_all(t, F.lit(_RUN), F.lit(0))
        both = F.arrays_zip(
            F.split(t, _RUN, -1).alias("before"), F.transform(runs, lambda r: run(r, buckets)).alias("run")
        )
        return F.array_join(
            F.transform(both, lambda x: F.concat(x["before"], F.coalesce(x["run"], F.lit("")))), ""
        )

    return let(let(F.transform(names, item), bucketed), joined)


def mask_names(text: Column) -> Column:
    """Replace every literal occurrence of each full name found in the text, name after name.

    Up to ``MANY_NAMES`` different names take one pass each; beyond that runs of
    capitalized words are masked by themselves, with the same result.  Only a single run of
    very many names still takes a pass over that run for each of its names.
    """

    def by_number(t: Column, names: Column) -> Column:
        few = F.when(F.size(names) <= MANY_NAMES, _replaced(t, names))
        return few.otherwise(_replaced_in_runs(t, names))

    return let(
        text,
        lambda t: let(
            F.regexp_extract_all(t, F.lit(detection_regex("name")), F.lit(0)),
            lambda found: F.when(
                F.size(found) > 0, let(F.array_distinct(found), lambda names: by_number(t, names))
            ).otherwise(t),
        ),
    )


def masked_text(
    text: Column, spans: Column | None, overlap: str = "reference", steps: str = "all"
) -> Column:
    """The masking chain over one cell; ``steps`` is ``all`` or ``spans``."""
    if overlap not in ("reference", "merge"):
        raise ValueError("overlap is 'reference' or 'merge'")
    spanned = text
    if spans is not None:
        by_spans = mask_spans if overlap == "reference" else mask_merged
        spanned = let(spans, lambda s: by_spans(text, s))
    if steps == "spans":
        return spanned
    return F.when(text.isNotNull(), mask_names(mask_patterns(spanned)))


def mask(
    df: DataFrame,
    key: str,
    columns: Sequence[str] | None = None,
    precedence: str = "reference",
    overlap: str = "reference",
    steps: str = "all",
    model: ModelHook | None = None,
    extra_columns: Sequence[str] = (),
    dictionary: DataFrame | Terms | None = None,
) -> DataFrame:
    """The table with its text columns masked; other columns pass through.

    Detected spans are masked in ``columns``; the pattern and name steps also run
    over ``extra_columns``, the text columns that were not scanned.  ``model`` and
    ``dictionary`` add spans as in ``detect``.
    """
    chosen = chosen_columns(df, key, columns)
    base, cells = _prepare(df, key, columns, "cell", model, dictionary)

    def masked(c: Column) -> Column:
        spans = spans_of(c, precedence, model is not None, dictionary is not None)
        return masked_text(c["text"], spans, overlap, steps)

    texts = hidden(df, "_texts")
    done = F.struct(F.transform(cells, masked).alias(texts))
    found = base.select(*[_named(c) for c in df.columns], F.inline(F.array(done)))
    place = {c: i for i, c in enumerate(chosen)}

    def out(name: str) -> Column:
        if name in place:
            return F.get(F.col(texts), F.lit(place[name])).alias(name)
        if name in extra_columns and steps == "all":
            return masked_text(_named(name).cast("string"), None).alias(name)
        return _named(name)

    return found.select(*[out(c) for c in df.columns])


def mask_detections(df: DataFrame, key: str, detections: DataFrame) -> DataFrame:
    """Span masking of a table from a detection frame made elsewhere.

    Detections are grouped to one array per row.  A bitmap of the rows that have any
    parts the table: only those rows are shuffled to meet their spans, the text of
    all others stays where it is.
    """
    spans = F.struct(
        "column", "start", F.col("ent_ord").alias("rank"), "end",
    )
    name = hidden(df, "_spans")
    per_row = staged(
        detections.groupBy("row_id").agg(F.array_sort(F.collect_list(spans)).alias(name))
    )
    joined = attached(df, key, per_row, name)
    touched = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}

    def one(column: str) -> Column:
        if column == key or column not in touched:
            return _named(column)
        mine = F.filter(F.coalesce(F.col(name), F.array()), lambda s: s["column"] == column)
        return let(mine, lambda s: mask_spans(_named(column), s)).alias(column)

    return joined.select(*[one(n) for n in df.columns])
