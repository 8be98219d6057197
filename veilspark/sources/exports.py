"""Report and graph files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from veilspark import constants as K
from veilspark.operators.compact import graph_compact
from veilspark.operators.graph import graph_edges, graph_nodes, graph_totals
from veilspark.sources.stage import drop_stage, stage_path, staged


def write_report(report: DataFrame, path: str) -> None:
    """The one-row report as JSON, NULL fields kept."""
    report.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_report(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A saved report.  Give ``report.schema`` to get maps back as maps."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def export_nodes(graph: DataFrame) -> DataFrame:
    """``{id, data}`` per node."""
    n = graph_nodes(graph)
    data = F.struct(
        "text", "type", F.col("row_id").alias("row"), "column", "start", "end",
        "confidence", "method", "risk_level",
    )
    return n.select(F.col("node_id").alias("id"), data.alias("data"))


def export_edges(graph: DataFrame, window: int = K.WINDOW) -> DataFrame:
    """``{source, target, data}`` per edge."""
    return graph_edges(graph, window).select(
        F.col("src").alias("source"),
        F.col("dst").alias("target"),
        F.struct("weight", "relation_type", "distance").alias("data"),
    )


def export_metadata(graph: DataFrame, window: int = K.WINDOW) -> DataFrame:
    return graph_totals(graph).select(
        F.col("nodes").alias("total_nodes"),
        F.col("edges").alias("total_edges"),
        F.lit(window).alias("proximity_window"),
    )


def export_cliques(compact: DataFrame) -> DataFrame:
    """``{row, size, links}`` per row: its plain co-occurrences by pair of types.

    ``compact`` has the size of each row in place of its members."""
    links = F.transform(
        F.filter("links", lambda x: x["n_plain"] > 0),
        lambda x: F.struct(
            x["type1"].alias("type1"), x["type2"].alias("type2"), x["n_plain"].alias("count"), x["plain_weight"].alias("weight")
        ),
    )
    return compact.select(F.col("row_id").alias("row"), "size", links.alias("links"))


def export_own_edges(compact: DataFrame) -> DataFrame:
    """``{source, target, data}`` of the edges with a weight of their own."""
    own = compact.select(F.inline("own"))
    return own.select(
        F.col("src").alias("source"), F.col("dst").alias("target"), F.struct("weight", "relation_type", "distance").alias("data")
    )


def export_graph(graph: DataFrame, path: str, window: int = K.WINDOW, expanded: bool = False) -> None:
    """The graph as JSON data sets under ``path``, linear in its nodes.

    ``nodes`` and ``metadata``; ``edges`` holds the edges with a weight of their own, and
    ``cliques`` one record per row for all others: each two nodes of the row that have no
    edge in ``edges`` are linked with the weight of their pair of types.  ``expanded=True``
    writes every edge into ``edges`` instead, and no ``cliques``; this list is quadratic in
    a row's nodes and repeats their ids, so it is written as gzipped JSON.
    """
    stage = stage_path(graph.sparkSession, path)
    parts = {"nodes": export_nodes(graph), "metadata": export_metadata(graph, window)}
    try:
        if expanded:
            parts["edges"] = export_edges(graph, window)
        else:
            slim = graph_compact(graph, window).select("row_id", F.size("members").alias("size"), "own", "links")
            compact = staged(slim, stage)  # both parts come from one pass
            parts["edges"] = export_own_edges(compact)
            parts["cliques"] = export_cliques(compact)
        for name, frame in parts.items():
            packed = "gzip" if expanded and name == "edges" else "none"
            frame.write.mode("overwrite").option("compression", packed).json(f"{path}/{name}")
    finally:  # it holds texts in clear
        drop_stage(graph.sparkSession, stage)
