"""Array-expression helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

CHUNK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable so ``body`` can use it many times.

    Without this, every mention of an expression is another evaluation, and the
    optimizer may also inline a column that was projected one step earlier.  The value
    is the start of a fold over nothing, and ``body`` its end: unlike ``transform``, a
    fold does not copy what its functions return, which nested bindings would do anew
    at every level.
    """
    return F.aggregate(F.array(), value, lambda bound, _: bound, body)


def empty_array(element_ddl: str) -> Column:
    return F.array().cast(f"array<{element_ddl}>")


def chunked(items: Column, size: int = CHUNK) -> Column:
    """Split an array into consecutive slices of at most ``size`` elements."""
    count = F.ceil(F.size(items) / F.lit(size)).cast("int")
    return F.when(F.size(items) == 0, F.array()).when(F.size(items) <= size, F.array(items)).otherwise(
        F.transform(
            F.sequence(F.lit(0), count - 1),
            lambda c: F.slice(items, c * size + 1, F.lit(size)),
        )
    )


def running_totals(items: Column, width: Callable[[Column], Column]) -> Column:
    """Sum of the widths *before* each element, as ``array<int>``.

    Appending to an array inside ``aggregate`` copies it, so the sums are taken
    per chunk and then shifted by the chunk's own base; long arrays stay cheap.
    """

    def prefix(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), empty_array("int").alias("sums"))
        return F.aggregate(
            values,
            start,
            lambda acc, v: F.struct(
                (acc["at"] + v).alias("at"),
                F.concat(acc["sums"], F.array(acc["at"])).alias("sums"),
            ),
        )

    def shifted(parts: Column) -> Column:
        bases = prefix(F.transform(parts, lambda p: p["at"]))["sums"]
        return let(
            bases,
            lambda b: F.flatten(
                F.transform(parts, lambda p, i: F.transform(p["sums"], lambda s: s + F.get(b, i)))
            ),
        )

    def totals(widths: Column) -> Column:
        few = F.when(F.size(widths) <= CHUNK, prefix(widths)["sums"])
        return few.otherwise(let(F.transform(chunked(widths), prefix), shifted))

    return let(F.transform(items, width), totals)


def first_of_runs(items: Column, same: Callable[[Column, Column], Column]) -> Column:
    """Keep the elements of a sorted array that differ from the one before them."""
    return F.filter(
        items, lambda x, i: (i == 0) | ~same(F.get(items, F.greatest(i - 1, F.lit(0))), x)
    )


def sql_literal(value) -> str:
    """A constant as SQL text: strings, numbers, lists and dicts (as structs)."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, list):
        return f"array({', '.join(sql_literal(v) for v in value)})"
    if isinstance(value, dict):
        fields = ", ".join(f"'{k}', {sql_literal(v)}" for k, v in value.items())
        return f"named_struct({fields})"
    return str(value)


def constant(value) -> Column:
    """A nested constant as one expression (one call instead of one per element)."""
    return F.expr(sql_literal(value))


def lookup(mapping: dict, key: Column, default=None) -> Column:
    """Constant dictionary lookup."""
    pairs = ", ".join(f"{sql_literal(k)}, {sql_literal(v)}" for k, v in mapping.items())
    found = F.try_element_at(F.expr(f"map({pairs})"), key)
    return found if default is None else F.coalesce(found, F.lit(default))
