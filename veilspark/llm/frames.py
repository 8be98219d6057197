"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(
    df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema
) -> DataFrame:
    return df.mapInArrow(task, schema)


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts`` (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))) % parts


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that do not clash with those of ``df``, whatever its columns are called."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def kept_names(keep: Iterable[str], taken: Iterable[str]) -> list[str]:
    """Names for the columns ``keep`` next to those in ``taken``: one that clashes gets
    underscores in front until it differs from all taken and all kept names."""
    keep = list(keep)
    held = {t.lower() for t in taken}
    used = held | {c.lower() for c in keep}
    out = []
    for name in keep:
        if name.lower() in held:
            while name.lower() in used:
                name = f"_{name}"
            used.add(name.lower())
        out.append(name)
    return out


def rest_of(batch: pa.RecordBatch, names: list[str]) -> list[pa.Array]:
    return [batch.column(batch.schema.get_field_index(n)) for n in names]


def added(df: DataFrame, fields: list[tuple[str, T.DataType]]) -> tuple[T.StructType, list[str]]:
    """Schema of ``df`` with further fields, renamed where they clash; their names."""
    names = fresh(df, *[n for n, _ in fields])
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, t) for n, (_, t) in zip(names, fields, strict=True)]])
    return schema, names


def text_slices(column: pa.Array, limit: int = 4_000_000) -> Iterator[pa.Array]:
    """Slices of a text column of about ``limit`` bytes, or of one text."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    at = np.concatenate([[0], np.cumsum(sizes)])
    first = 0
    while first < len(column):
        last = int(np.searchsorted(at, at[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield column.slice(first, last - first)
        first = last
