"""The one-row report, its recommendations and its text form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from veilspark import constants as K
from veilspark.functions.arrays import constant, empty_array
from veilspark.operators import graph as G
from veilspark.operators.summary import detection_summary, proximity_summary


def recommendations(total: Column, high_rows: Column, reid_level: Column) -> Column:
    """Advice lines, in order; the first three depend on the findings."""

    def line_if(test: Column, line: Column) -> Column:
        return F.when(test, F.array(line)).otherwise(empty_array("string"))

    return F.concat(
        line_if(total > 0, F.format_string(K.FOUND_ENTITIES, total)),
        line_if(high_rows > 0, F.format_string(K.FOUND_HIGH_ROWS, high_rows)),
        line_if(reid_level == "high", F.lit(K.FOUND_HIGH_REID)),
        constant(K.GENERAL_ADVICE),
    )


def graph_summary(graph: DataFrame) -> DataFrame:
    """Statistics, re-identification risk and central nodes of a graph, one row.

    Components and clusters are tables of their own; here only their numbers.
    """
    found = G.graph_totals(graph).select(
        F.when(F.col("nodes") == 0, F.lit(K.EMPTY_GRAPH)).alias("error"),
        G.stats_struct().alias("graph_stats"),
        F.col("components").alias("n_components"),
        G.reid_struct().alias("reidentification_risk"),
    )

    def top(measure: str) -> Column:
        pairs = G.top_central(graph, measure).agg(
            F.collect_list(F.struct("centrality", "node_id"))
        )
        return pairs.scalar().alias(f"{measure}_centrality")

    return found.select("*", F.struct(*[top(m) for m in G.MEASURES]).alias("centrality_measures"))


def failed_graph_summary(graph: DataFrame, error: str) -> DataFrame:
    """What stands in for ``graph_summary`` when the graph step failed."""
    return graph_summary(graph.limit(0)).withColumn("error", F.lit(error))


def _packed(df: DataFrame) -> Column:
    """A one-row frame as a scalar struct."""
    return df.select(F.struct("*")).scalar()


def report(
    rows: DataFrame,
    risks: DataFrame,
    graph_part: DataFrame,
    input_name: str,
    window: int = K.WINDOW,
) -> DataFrame:
    """The report as one row; its parts are scalar subqueries, not joins."""
    spark = rows.sparkSession
    parts = spark.range(0, 1, 1, 1).select(
        F.struct(
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            .alias("timestamp"),
            F.lit(input_name).alias("input_file"),
            F.lit(window).alias("proximity_window"),
        ).alias("metadata"),
        _packed(detection_summary(rows)).alias("ner_summary"),
        _packed(proximity_summary(risks)).alias("proximity_summary"),
        _packed(graph_part).alias("graph_summary"),
    )
    return parts.withColumn(
        "recommendations",
        recommendations(
            F.col("ner_summary.total_detections"),
            F.col("proximity_summary.high_risk_rows"),
            F.coalesce(F.col("graph_summary.reidentification_risk.risk_level"), F.lit("")),
        ),
    )


def _title(name: Column) -> Column:
    """Every letter behind a character that is none in upper case, the others in lower case."""
    return F.array_join(F.transform(F.split(name, r"(?<=\P{L})"), F.initcap), "")


def text_summary(report_row: DataFrame) -> DataFrame:
    """The report as printable lines: ``ord, line``."""
    ner, prox, graph = (F.col(c) for c in ("ner_summary", "proximity_summary", "graph_summary"))
    types = F.transform(
        F.map_entries(ner["detection_types"]),
        lambda e: F.format_string("%s: %d", _title(e["key"]), e["value"]),
    )
    stats, reid = graph["graph_stats"], graph["reidentification_risk"]
    lines = F.concat(
        F.array(F.format_string("Total PII Entities Detected: %d", ner["total_detections"])),
        types,
        F.array(
            F.format_string("High Risk Rows: %d", prox["high_risk_rows"]),
            F.format_string("Medium Risk Rows: %d", prox["medium_risk_rows"]),
            F.format_string("Low Risk Rows: %d", prox["low_risk_rows"]),
            F.format_string("Total Nodes: %d", stats["nodes"]),
            F.format_string("Total Edges: %d", stats["edges"]),
            F.format_string("Graph Density: %.3f", stats["density"]),
            F.format_string("Re-identification Risk: %s", F.upper(reid["risk_level"])),
        ),
        F.transform(
            F.col("recommendations"), lambda r, i: F.format_string("%d. %s", i + 1, r)
        ),
    )
    return report_row.select(F.posexplode(lines).alias("ord", "line"))
