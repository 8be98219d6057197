"""Positions in a global order, without one task that holds all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from veilspark.operators.cells import _named
from veilspark.operators.detect import hidden
from veilspark.sources.stage import staged


def ranked(df: DataFrame, order: Sequence[Column], name: str = "rank", path: str | None = None) -> DataFrame:
    """``df`` with ``name``: its place (from 1) in the order given.

    The rows are dealt out by ranges of the order, sorted within each partition and
    staged with their place there; the numbers of rows of the partitions before are
    then added.  Only one count a partition goes through a single window, so this
    works for any number of rows.  Give an order without ties for a defined result;
    a value met very often needs a second key, or its range fills one partition.
    """
    at, part = hidden(df, "_at"), hidden(df, "_part")
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = staged(placed.withColumn(at, F.monotonically_increasing_id()), path)
    number = F.shiftright(at, 33)
    counts = placed.groupBy(number.alias(part)).agg(F.count("*").alias("_n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col(at).bitwiseAND((1 << 33) - 1) + 1
    return (
        placed.withColumn(part, number)
        .join(F.broadcast(offsets), part)  # one row a partition
        .select(place.cast("long").alias(name), *[_named(c) for c in df.columns])
    )
