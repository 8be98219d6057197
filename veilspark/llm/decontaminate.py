"""Benchmark decontamination by pigeonhole edit matching.

An item of ``n`` characters may appear with up to ``e = floor(rate * n)`` edits.
Cut into ``e + 1`` pieces, at least one piece must appear unchanged; all pieces
of all items are found in one pass of an Aho-Corasick automaton, and the
neighbourhood of every hit is verified with Myers' bit-parallel distance.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from veilspark.llm.frames import added, fresh, text_slices

BLOCK_CHARS = 4_000_000
_compiled: dict[str, "Items"] = {}


def normal(text: str) -> str:
    """Lower case, white space collapsed to one space."""
    return " ".join(text.lower().split())


def pieces(item: str, rate: float) -> list[tuple[int, str]]:
    """``floor(rate * n) + 1`` consecutive pieces of nearly equal length, with their offsets."""
    parts = min(int(rate * len(item)) + 1, len(item))
    cuts = [len(item) * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(masks: dict[str, int], size: int, text: str, budget: int) -> tuple[int, int] | None:
    """Least edits of a pattern against any part of ``text`` and the first end of
    such a part; None above ``budget``.  ``masks``: positions of each character."""
    full, top = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score, best = full, 0, size, None
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (full & ~(xh | plus))
        mh = plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        plus = mh | (full & ~(xv | ph))
        minus = ph & xv
        if score <= budget and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


class Items:
    """Compiled items: automaton over distinct pieces, masks for the verification."""

    def __init__(self, items: list[tuple[object, str]], rate: float):
        import ahocorasick

        owners: dict[str, list[tuple[int, int]]] = {}
        self.items = [(key, text, int(rate * len(text)), _masks(text)) for key, text in items]
        for i, (_, text, _, _) in enumerate(self.items):
            for offset, piece in pieces(text, rate):
                owners.setdefault(piece, []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in owners.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def matches(self, text: str) -> list[tuple[object, int, int, int]]:
        """(item key, edits, start, end) of the best match of every item in ``text``."""
        spots: dict[int, set[int]] = {}
        for last, (size, where) in self.automaton.iter(text):
            at = last + 1 - size
            for i, offset in where:
                spots.setdefault(i, set()).add(at - offset)
        return [m for i in sorted(spots) if (m := self._best(i, sorted(spots[i]), text))]

    def _best(self, i: int, starts: list[int], text: str):
        key, item, budget, masks = self.items[i]
        n = len(item)
        for s in starts:
            if s >= 0 and text.startswith(item, s):
                return key, 0, s, s + n
        best = None
        k = 0
        while k < len(starts):
            low = high = starts[k]
            while k < len(starts) and starts[k] - budget <= high + n + budget:
                high = starts[k]
                k += 1
            a, b = max(0, low - budget), high + n + budget
            found = myers(masks, n, text[a:b], budget)
            if found and (best is None or found[0] < best[0]):
                best = (found[0], a + found[1])
        if best is None:
            return None
        edits, end = best
        back = myers(_masks(item[::-1]), n, text[max(0, end - n - budget) : end][::-1], edits)
        return key, edits, end - (back[1] if back else n), end


def _masks(text: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(text):
        out[c] = out.get(c, 0) | (1 << i)
    return out


def _blocks(items: DataFrame, key: str, text: str, min_chars: int) -> Iterator[list[tuple[object, str]]]:
    """Items in blocks of bounded size (the items pass the driver block by block)."""
    block, size = [], 0
    rows = items.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).filter("t is not null")
    for row in rows.orderBy("k", "t").toLocalIterator():
        item = normal(row.t)
        if len(item) < min_chars:
            continue
        block.append((row.k, item))
        size += len(item)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def with_leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    rate: float = 0.08,
    min_chars: int = 20,
    keep: list[str] | None = None,
    name: str = "leaks",
) -> DataFrame:
    """``docs`` with an array of (item, edits, start, end): for every item that
    appears in the text with at most ``rate`` edits a character, its best match
    (fewest edits, then the first).  Offsets count characters of the text in
    lower case with white space collapsed.

    ``keep`` limits the columns returned (all by default); ``name`` is prefixed
    with underscores where it clashes.  A null or empty text has no leaks; a
    null item or one of fewer than ``min_chars`` characters matches nothing;
    items with equal text are all reported.  Empty tables give an empty result
    or empty arrays.  Every whole text is searched.  Map-only; the items travel
    in blocks of ``BLOCK_CHARS`` characters, each block one more pass.
    """
    kept = docs.columns if keep is None else keep
    inner, = fresh(docs, "__normal")
    out = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias(inner))
    item_type = items.schema[item_key].dataType
    leak = T.ArrayType(T.StructType([
        T.StructField("item", item_type), T.StructField("edits", T.IntegerType()),
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    ]))
    found: list[str] = []
    for block in _blocks(items, item_key, item_text, min_chars):
        schema, (column,) = added(out, [(f"__leaks{len(found)}", leak)])
        out = out.mapInArrow(_searcher(docs.sparkSession.sparkContext.broadcast(block), rate, inner, column, schema), schema)
        found.append(column)
    none = F.array().cast(leak)
    label, = fresh(docs.select(*[F.col(f"`{c}`") for c in kept]), name)
    every = F.concat(*[F.col(f"`{c}`") for c in found]) if found else none
    return out.select(*[F.col(f"`{c}`") for c in kept], every.alias(label))


def _searcher(block, rate: float, text: str, column: str, schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(schema[column].dataType)
    name = uuid.uuid4().hex

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _compiled:
            _compiled.clear()
            _compiled[name] = Items(block.value, rate)
        items = _compiled[name]
        fields = ("item", "edits", "start", "end")
        for batch in batches:
            where = batch.schema.get_field_index(text)
            row = 0
            for part in text_slices(batch.column(where)):
                leaks = [
                    [dict(zip(fields, m, strict=True)) for m in items.matches(normal(t))] if t else []
                    for t in part.to_pylist()
                ]
                kept = [c.slice(row, len(part)) for c in batch.columns]
                row += len(part)
                yield pa.RecordBatch.from_arrays([*kept, pa.array(leaks, kind)], names=[*batch.schema.names, column])

    return task


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per (document, item) found: ``doc_id, item_id, edits, start, end``.
    Cases as in ``with_leaks``; equal rows of ``docs`` give equal rows here."""
    found = with_leaks(docs, items, text=text, keep=[doc_id], name="leaks", **options)
    pairs = found.select(F.col(f"`{doc_id}`").alias("doc_id"), F.explode("leaks").alias("m"))
    return pairs.select(
        "doc_id", F.col("m.item").alias("item_id"), F.col("m.edits").alias("edits"),
        F.col("m.start").alias("start"), F.col("m.end").alias("end"),
    )


def clean(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without any leak; columns unchanged."""
    label, = fresh(docs, "leaks")
    marked = with_leaks(docs, items, text=text, name=label, **options)
    return marked.filter(F.size(f"`{label}`") == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
