"""From table rows to text cells and row text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from veilspark.functions.arrays import empty_array


def text_columns(df: DataFrame, key: str) -> list[str]:
    """The string columns of ``df`` apart from the key."""
    return [
        f.name
        for f in df.schema.fields
        if f.name != key and isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))
    ]


def _named(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def chosen_columns(df: DataFrame, key: str, columns: Sequence[str] | None) -> list[str]:
    if key not in df.columns:
        raise ValueError(f"unknown key column: {key}")
    if columns is None:
        return text_columns(df, key)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"unknown text columns: {missing}")
    return list(columns)


def row_text(df: DataFrame, key: str) -> Column:
    """Non-null cells of every column but the key, joined by one space."""
    return F.concat_ws(" ", *[_named(c).cast("string") for c in df.columns if c != key])


def _base(df: DataFrame, key: str, column: str) -> Column:
    """Where the cell of ``column`` begins inside the row text."""
    base = F.lit(0)
    for name in df.columns:
        if name == column:
            break
        if name != key:
            base = base + F.coalesce(F.length(_named(name).cast("string")) + 1, F.lit(0))
    return base


def cell_array(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    offset_basis: str = "cell",
    given: dict[str, dict[str, Column]] | None = None,
) -> Column:
    """The row's text cells, in column order, as one array (empty cells included).

    ``given`` adds fields: for each its name and, by column, its value.
    """
    if offset_basis not in ("cell", "row"):
        raise ValueError("offset_basis is 'cell' or 'row'")
    order = {name: i for i, name in enumerate(c for c in df.columns if c != key)}
    parts = []
    for name in columns:
        base = _base(df, key, name) if offset_basis == "row" else F.lit(0)
        fields = [
            F.lit(order[name]).alias("col_idx"),
            F.lit(name).alias("column"),
            base.cast("int").alias("base"),
            _named(name).cast("string").alias("text"),
        ]
        fields += [values[name].alias(field) for field, values in (given or {}).items()]
        parts.append(F.struct(*fields))
    if not parts:  # nothing to scan still needs a typed array
        hits = "".join(
            f",{field}:array<struct<text:string,label:string,start:int,end:int>>" for field in given or {}
        )
        return empty_array(f"struct<col_idx:int,column:string,base:int,text:string{hits}>")
    return F.array(*parts)


def cells(df: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per non-empty text cell: ``row_id, col_idx, column, text``."""
    chosen = chosen_columns(df, key, columns)
    filled = F.filter(
        cell_array(df, key, chosen), lambda c: c["text"].isNotNull() & (c["text"] != "")
    )
    return df.select(_named(key).alias("row_id"), F.inline(filled)).drop("base")
