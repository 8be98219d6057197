"""Counts over detections and risk rows, as single aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veilspark.functions.arrays import let
from veilspark.operators.detect import detections_of


def detection_by_type(rows: DataFrame) -> DataFrame:
    return detections_of(rows).groupBy("type").agg(F.count("*").alias("n"))


def affected_columns(rows: DataFrame) -> DataFrame:
    return detections_of(rows).groupBy("column").agg(F.count("*").alias("n"))


def affected_rows(rows: DataFrame) -> DataFrame:
    """The rows that hold an entity, with their entity counts (no shuffle)."""
    return rows.select("row_id", F.size("entities").cast("long").alias("n"))


def _sum_by(items: Column, field: str) -> Column:
    """``map<field, sum of n>`` over a small array of structs."""

    def total(name: Column) -> Column:
        return F.aggregate(
            F.filter(items, lambda x: x[field] == name),
            F.lit(0).cast("long"),
            lambda acc, x: acc + x["n"],
        )

    return let(
        F.array_sort(F.array_distinct(F.transform(items, lambda x: x[field]))),
        lambda names: F.map_from_arrays(names, F.transform(names, total)),
    )


def detection_summary(rows: DataFrame) -> DataFrame:
    """One row: totals, counts per type, columns affected, number of rows affected.

    The first aggregation leaves one record per (column, type); only those few
    reach the second one.  A row counts once, at its first entity.
    """
    small = (
        detections_of(rows)
        .groupBy("column", "type")
        .agg(F.count("*").alias("n"), F.count_if(F.col("ent_ord") == 0).alias("first"))
    )
    packed = small.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_detections"),
        F.collect_list(F.struct("type", "n")).alias("counts"),
        F.sort_array(F.collect_set("column")).alias("columns_affected"),
        F.coalesce(F.sum("first"), F.lit(0)).alias("n_rows_affected"),
    )
    return packed.select(
        "total_detections",
        _sum_by(F.col("counts"), "type").alias("detection_types"),
        "columns_affected",
        "n_rows_affected",
    )


def proximity_summary(risks: DataFrame) -> DataFrame:
    """Analysed rows and rows per overall risk level."""
    level = F.col("overall_risk")
    return risks.agg(
        F.count("*").alias("total_analyses"),
        *[F.count_if(level == r).alias(f"{r}_risk_rows") for r in ("high", "medium", "low")],
    )
