"""CSV records with quoted line breaks, from files that are still split over tasks.

A line break ends a record only outside quotes, and whether a block of a file begins
inside quotes depends on all blocks before it.  A first pass counts the quotes of
every block; an even or odd sum over the blocks before says how each begins.  Then
every block finds its own records.  What a border cuts in two is joined again: only
those pieces are moved.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

MOST_BLOCKS = 500_000
WHOLE, OPENS, GOES_ON, CLOSES = 0, 1, 2, 3


class TooManyBlocks(ValueError):
    """More file blocks than may be sent to every task."""


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the file block that they were read from."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def quotes_in(value: Column) -> Column:
    return F.length(value) - F.length(F.replace(value, F.lit('"')))


def block_starts(lines: DataFrame) -> DataFrame:
    """(file, block, inside): does the block begin within quotes?  One row a block."""
    odd = lines.groupBy("file", "block").agg((F.sum(quotes_in(F.col("value"))) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return odd.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _records(batches: Iterator[pa.RecordBatch], starts: dict) -> Iterator[pa.RecordBatch]:
    at, held, first, number, out = None, [], False, 0, []

    def close(kind: int, file: str, block: int) -> None:
        nonlocal held, first, number
        text = "\n".join(held)
        held = []
        if kind == WHOLE:
            text = text.removesuffix("\r")
            if first:  # the header of the file
                first = False
                return
            if not text.strip():
                return
        out.append((file, block, number, kind, text))
        number += 1

    def end() -> None:
        if at is not None and held:
            if opened:
                close(GOES_ON if from_before else OPENS, *at)
            else:
                close(WHOLE, *at)

    opened = from_before = False
    for batch in batches:
        for file, block, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, block) != at:
                end()
                at, held, number, first = (file, block), [], 0, block == 0
                opened = from_before = starts[file, block]
            held.append(value)
            opened ^= value.count('"') % 2 == 1
            if not opened:
                close(CLOSES if from_before else WHOLE, file, block)
                from_before = False
        yield _batch(out)
        out = []
    end()
    yield _batch(out)


def _batch(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) or [()] * 5
    types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["file", "block", "place", "kind", "record"]
    )


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, place, record): the records of CSV files behind their headers, in
    file order by (file, block, place); blank ones are left out.

    A record belongs to the block in which it begins.  A file is as many tasks as it
    has blocks, whatever its cells hold.  Line ends within quotes are kept.
    """
    lines = lines_of(spark, path)
    starts = block_starts(lines).limit(MOST_BLOCKS + 1).collect()
    if len(starts) > MOST_BLOCKS:
        raise TooManyBlocks(f"more than {MOST_BLOCKS} file blocks; raise spark.sql.files.maxPartitionBytes")
    sent = spark.sparkContext.broadcast({(r["file"], r["block"]): r["inside"] for r in starts})
    found = lines.mapInArrow(
        lambda batches: _records(batches, sent.value),
        "file string, block long, place long, kind int, record string",
    )
    whole = found.filter(F.col("kind") == WHOLE).select("file", "block", "place", "record")
    pieces = found.filter(F.col("kind") != WHOLE)
    order = Window.partitionBy("file").orderBy("block", "place")
    begun = F.sum((F.col("kind") == OPENS).cast("int")).over(order)
    piece = F.struct("block", "place", "record")
    joined = (
        pieces.withColumn("begun", begun)
        .groupBy("file", "begun")
        .agg(F.array_sort(F.collect_list(piece)).alias("p"))
        .select(
            "file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["place"].alias("place"),
            F.regexp_replace(F.array_join(F.transform("p", lambda x: x["record"]), "\n"), "\r$", "").alias("record"),
        )
    )
    return whole.unionByName(joined)
