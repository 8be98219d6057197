"""The registered queries: operator outputs as flat columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from queryset import inputs
from veilspark import constants as K
from veilspark.functions import text as X
from veilspark.operators import compact as C
from veilspark.operators import edges as E
from veilspark.operators import graph as G
from veilspark.operators import inference, mask, proximity, risk, summary
from veilspark.operators.cells import cells, row_text
from veilspark.operators.detect import detect, entity_rows, pattern_spans
from veilspark.operators.gazetteer import gazetteer_entities, measured, rows_of, with_gazetteer
from veilspark.plans.report import graph_summary, recommendations, report, text_summary
from veilspark.plans.run import run
from veilspark.sources.exports import export_graph, read_report, write_report
from veilspark.sources.stage import stage_path, staged
from veilspark.sources.tables import load_csv, write_masked

Query = Callable[[SparkSession, str], DataFrame]


def _long(*names: str) -> list[Column]:
    return [F.col(n).cast("long").alias(n) for n in names]


def _r6(name: str) -> Column:
    return F.round(F.col(name), 6).alias(name)


def _docs(spark, sf):
    return inputs.documents(spark, sf)


def _people(spark, sf):
    return inputs.people(spark, sf)


def _rows(source) -> Callable:
    return lambda spark, sf: entity_rows(source(spark, sf), "row_id")


_doc_rows, _people_rows = _rows(_docs), _rows(_people)


def _shared_rows(spark, sf):
    return entity_rows(_people(spark, sf), "row_id", offset_basis="row")



def _graph(rows) -> Callable:
    return lambda spark, sf: G.graph_rows(rows(spark, sf))


_doc_graph, _people_graph = _graph(_doc_rows), _graph(_people_rows)


# --- detection ----------------------------------------------------------------


def _detect_pattern(name: str) -> Query:
    def query(spark, sf):
        def spans(df, label):
            found = cells(df, "row_id")
            keyed = found.select(
                F.struct("row_id", "column").alias("cell"), F.col("text").alias("cell_text")
            )
            return pattern_spans(keyed, "cell", "cell_text", name).select(
                F.lit(label).alias("source"), "row_id.row_id", "row_id.column",
                *_long("start", "end"), "text",
            )

        return spans(_docs(spark, sf), "documents").unionByName(
            spans(_people(spark, sf), "people")
        )

    return query


def _detections(df: DataFrame) -> DataFrame:
    return df.select(
        "row_id", *_long("ent_ord"), "column", *_long("start", "end"),
        "text", "label", "type", "confidence", "method",
    )


def detect_all(spark, sf):
    return _detections(detect(_docs(spark, sf), "row_id"))


def detect_cells(spark, sf):
    return _detections(detect(_people(spark, sf), "row_id"))


def detect_specific(spark, sf):
    return _detections(detect(_people(spark, sf), "row_id", precedence="specific"))


def text_cells(spark, sf):
    return cells(_people(spark, sf), "row_id").select(
        "row_id", *_long("col_idx"), "column", "text"
    )


def gazetteer(spark, sf):
    found = gazetteer_entities(_docs(spark, sf), "row_id", inputs.dictionary(spark, sf))
    return found.select(
        "row_id", *_long("start", "end"), "text", "label", "type", "confidence"
    )


def gazetteer_large(spark, sf):
    """The way of dictionaries that are too large to be sent to every task."""
    found = gazetteer_entities(_docs(spark, sf), "row_id", inputs.dictionary(spark, sf), broadcast_terms=0)
    return found.select(
        "row_id", *_long("start", "end"), "text", "label", "type", "confidence"
    )


def detect_with_gazetteer(spark, sf):
    found = detect(_docs(spark, sf), "row_id", dictionary=inputs.dictionary(spark, sf))
    return found.select(
        "row_id", *_long("ent_ord", "start", "end"), "text", "label", "type", "confidence"
    )


def gazetteer_risk(spark, sf):
    """From two detection frames made apart and brought together by row."""
    docs = _docs(spark, sf)
    hits = gazetteer_entities(docs, "row_id", inputs.dictionary(spark, sf))
    return _risk(risk.row_risk(rows_of(docs, "row_id", with_gazetteer(detect(docs, "row_id"), hits))))


def gazetteer_pair_risk(spark, sf):
    rows = entity_rows(_people(spark, sf), "row_id", dictionary=inputs.dictionary(spark, sf))
    return _assessed(proximity.assess(proximity.relations(rows)))


def mask_with_gazetteer(spark, sf):
    return mask.mask(_people(spark, sf), "row_id", dictionary=inputs.dictionary(spark, sf))


def mask_documents_with_gazetteer(spark, sf):
    terms = measured(inputs.dictionary(spark, sf), broadcast_terms=0)
    return mask.mask(_docs(spark, sf), "row_id", dictionary=terms)


def graph_with_gazetteer(spark, sf):
    rows = entity_rows(_people(spark, sf), "row_id", dictionary=inputs.dictionary(spark, sf))
    return _nodes(G.graph_rows(rows))


# --- summaries ------------------------------------------------------------------


def detection_summary(spark, sf):
    s = summary.detection_summary(_people_rows(spark, sf))
    return s.select(
        *_long("total_detections", "n_rows_affected"),
        _map_text(F.col("detection_types")).alias("detection_types"),
        F.array_join("columns_affected", ",").alias("columns_affected"),
    )


def _map_text(m: Column) -> Column:
    return F.array_join(
        F.array_sort(
            F.transform(F.map_entries(m), lambda e: F.concat_ws(":", e["key"], e["value"]))
        ),
        ",",
    )


def detection_by_type(spark, sf):
    return summary.detection_by_type(_people_rows(spark, sf)).select("type", *_long("n"))


def affected_columns(spark, sf):
    return summary.affected_columns(_people_rows(spark, sf)).select("column", *_long("n"))


def affected_rows(spark, sf):
    return summary.affected_rows(_people_rows(spark, sf)).select("row_id", *_long("n"))


def row_texts(spark, sf):
    return _people_rows(spark, sf).select("row_id", "row_text")


# --- proximity and risk -----------------------------------------------------------


def proximity_pairs(spark, sf):
    return proximity.relations(_doc_rows(spark, sf)).select(
        "row_id", *_long("ord1", "ord2"), F.col("e1.text").alias("text1"),
        F.col("e2.text").alias("text2"), *_long("distance"), "text_between",
    )


def proximity_pairs_wide(spark, sf):
    return proximity.relations(_people_rows(spark, sf)).select(
        "row_id", *_long("ord1", "ord2"), F.col("e1.text").alias("text1"),
        F.col("e2.text").alias("text2"), *_long("distance"), "text_between",
    )


def _assessed(df: DataFrame) -> DataFrame:
    return df.select(
        "row_id", *_long("ord1", "ord2"), "type1", "type2", *_long("distance"),
        "risk_level", "reason",
    )


def pair_risk(spark, sf):
    return _assessed(proximity.assess(proximity.relations(_people_rows(spark, sf))))


def band_join_pairs(spark, sf):
    found = detect(_people(spark, sf), "row_id")
    return _assessed(proximity.assess(proximity.band_pairs(found)))


def _inferred(df: DataFrame) -> DataFrame:
    return df.select(
        "row_id", *_long("inf_ord"), "text", "type", "pattern",
        F.array_join("context_indicators", "; ").alias("context_indicators"),
        *_long("start", "end"), "confidence", "method", "risk_level",
    )


def _inference(rows, kind: str) -> Query:
    return lambda spark, sf: _inferred(inference.inferred(rows(spark, sf), kind=kind))


def context_window(spark, sf):
    return inference.contexts(_people_rows(spark, sf)).select(
        "row_id", *_long("ent_ord"), "type", "context"
    )


def _indicators(rows) -> Query:
    def query(spark, sf):
        found = inference.contexts(rows(spark, sf))
        return found.filter(F.size("indicators") > 0).select(
            "row_id", *_long("ent_ord"), F.array_join("indicators", "; ").alias("indicators")
        )

    return query


def _categories() -> Column:
    return F.array_join(
        F.transform(
            "sensitive_categories",
            lambda c: F.concat_ws(":", c["category"], c["indicator_count"]),
        ),
        ",",
    ).alias("sensitive_categories")


def context_score(spark, sf):
    scores = risk.context_scores(_docs(spark, sf), "row_id", F.col("text"))
    return scores.select("row_id", _categories(), _r6("context_score"))


def _risk(df: DataFrame) -> DataFrame:
    return df.select(
        "row_id", *_long("n_pairs", "n_high", "n_medium", "n_low"), _categories(),
        _r6("context_score"), "overall_risk",
    )


def _row_risk(rows) -> Query:
    return lambda spark, sf: _risk(risk.row_risk(rows(spark, sf)))


def _proximity_summary(rows) -> Query:
    def query(spark, sf):
        found = summary.proximity_summary(risk.row_risk(rows(spark, sf)))
        return found.select(*_long(*found.columns))

    return query


# --- graph ----------------------------------------------------------------------------


def _nodes(graph: DataFrame) -> DataFrame:
    return G.graph_nodes(graph).select(
        "node_id", "row_id", "column", "text", "type", *_long("start", "end"),
        "confidence", "method", "risk_level", "self_loop", "weight",
    )


def graph_nodes(spark, sf):
    return _nodes(_people_graph(spark, sf))


def graph_edges(spark, sf):
    return G.graph_edges(_people_graph(spark, sf)).select(
        "row_id", "src", "dst", _r6("weight"), "relation_type", *_long("distance")
    )


def graph_edges_detected(spark, sf):
    graph = G.graph_rows(_people_rows(spark, sf), with_proximity=False)
    return G.graph_edges(graph, with_proximity=False).select(
        "row_id", "src", "dst", _r6("weight"), "relation_type"
    )


def graph_compact(spark, sf):
    found = C.graph_compact(_people_graph(spark, sf)).select("row_id", F.inline("links"))
    plain = F.round(F.col("n_plain") * F.col("plain_weight"), 6)
    return found.select("row_id", "type1", "type2", "n_plain", plain.alias("plain_weight"), "n_own", _r6("own_weight"))


def graph_expanded(spark, sf):
    return C.expand(staged(C.graph_compact(_doc_graph(spark, sf)))).select(
        "row_id", "src", "dst", _r6("weight"), "relation_type", *_long("distance")
    )


def _graph_stats(graph) -> Query:
    def query(spark, sf):
        return G.graph_stats(graph(spark, sf)).select(
            *_long("nodes", "edges"), _r6("density"), _r6("average_clustering"), "is_connected"
        )

    return query


def _components(found: DataFrame) -> DataFrame:
    return found.select(
        "component_id", *_long("size"), _map_text(F.col("entity_types")).alias("entity_types"),
        _r6("risk_score"), F.array_join(F.array_sort("nodes"), "|").alias("nodes"),
    )


def _clusters(found: DataFrame) -> DataFrame:
    return found.select(
        "row_id", *_long("size"), F.array_join("entity_types", ",").alias("entity_types"),
        _r6("risk_score"), "cluster_type",
    )


def components(spark, sf):
    return _components(G.components(_doc_graph(spark, sf)))


def risk_clusters(spark, sf):
    return _clusters(G.risk_clusters(_doc_graph(spark, sf)))


def components_ranked(spark, sf):
    return G.ranked_components(_doc_graph(spark, sf)).select("rank", "component_id", *_long("size"), _r6("risk_score"))


def clusters_ranked(spark, sf):
    return G.ranked_clusters(_doc_graph(spark, sf)).select("rank", "row_id", *_long("size"), _r6("risk_score"))


def _top(measure: str) -> Query:
    def query(spark, sf):
        return G.top_central(_doc_graph(spark, sf), measure).select(
            "node_id", "row_id", _r6("centrality")
        )

    return query


def _reid(graph) -> Query:
    def query(spark, sf):
        return G.reid_risk(graph(spark, sf)).select(
            "risk_level", _r6("score"), _r6("connectivity_risk"), _r6("entity_risk"),
            _r6("component_risk"),
        )

    return query


def graph_top_nodes(spark, sf):
    _, edges = G.top_subgraph(_doc_graph(spark, sf))
    return edges.select("src", "dst", _r6("weight"), "relation_type")


def cliques_hold(spark, sf):
    return G.cliques_hold(G.graph_edges(_doc_graph(spark, sf))).agg(
        F.count("*").alias("rows_not_cliques")
    )


def edges_stats(spark, sf):
    return E.edge_stats(inputs.part_links(spark, sf)).select(
        "nodes", "edges", _r6("density"), _r6("average_clustering"), "is_connected"
    )


def edges_degree(spark, sf):
    return E.edge_clustering(inputs.part_links(spark, sf)).select("node", "degree", "triangles", _r6("clustering"))


def edges_top(spark, sf):
    return E.edge_top_central(inputs.part_links(spark, sf)).select("node", _r6("centrality"))


def edges_components(spark, sf):
    return E.edge_components(inputs.turn_links(spark, sf)).select("node", "component_id", "size")


def edges_uneven(spark, sf):
    return E.uneven_components(inputs.turn_links(spark, sf)).select("component_id", "size", "n_edges")


# --- masking ------------------------------------------------------------------------------


def mask_spans(spark, sf):
    return mask.mask(_docs(spark, sf), "row_id", steps="spans")


def mask_from_detections(spark, sf):
    docs = _docs(spark, sf)
    return mask.mask_detections(docs, "row_id", detect(docs, "row_id"))


def mask_merged(spark, sf):
    return mask.mask(_people(spark, sf), "row_id", overlap="merge", steps="spans").drop("balance")


def mask_patterns(spark, sf):
    return _docs(spark, sf).select("row_id", mask.mask_patterns(F.col("text")).alias("text"))


def mask_names(spark, sf):
    return _docs(spark, sf).select("row_id", mask.mask_names(F.col("text")).alias("text"))


def mask_full(spark, sf):
    return mask.mask(_people(spark, sf), "row_id")


def mask_full_documents(spark, sf):
    return mask.mask(_docs(spark, sf), "row_id")


# --- report, scalars, files ------------------------------------------------------------------


def _report(spark, sf):
    rows = staged(_people_rows(spark, sf))
    graph = staged(G.graph_rows(rows))
    return report(rows, risk.row_risk(rows), graph_summary(graph), "people")


def report_row(spark, sf):
    ner, prox, graph = "ner_summary.", "proximity_summary.", "graph_summary."
    stats, reid = graph + "graph_stats.", graph + "reidentification_risk."

    def long(path: str) -> Column:
        return F.col(path).cast("long").alias(path.rsplit(".", 1)[1])

    return _report(spark, sf).select(
        "metadata.input_file",
        long("metadata.proximity_window"),
        *[long(ner + c) for c in ("total_detections", "n_rows_affected")],
        _map_text(F.col(ner + "detection_types")).alias("detection_types"),
        *[long(prox + c) for c in
          ("total_analyses", "high_risk_rows", "medium_risk_rows", "low_risk_rows")],
        long(stats + "nodes"), long(stats + "edges"),
        F.round(stats + "density", 6).alias("density"),
        F.round(reid + "score", 6).alias("score"),
        F.col(reid + "risk_level").alias("risk_level"),
        F.array_join("recommendations", "|").alias("recommendations"),
    )


def report_text(spark, sf):
    return text_summary(_report(spark, sf)).select(*_long("ord"), "line")


def report_file(spark, sf):
    made = _report(spark, sf)
    path = stage_path(spark)
    write_report(made, path)
    return read_report(spark, path, made.schema).select(
        F.col("ner_summary.total_detections").cast("long").alias("total_detections"),
        F.round("graph_summary.reidentification_risk.score", 6).alias("score"),
        F.array_join("recommendations", "|").alias("recommendations"),
    )


def advice(spark, sf):
    rows = staged(_people_rows(spark, sf))
    counts = summary.detection_summary(rows)
    high = summary.proximity_summary(risk.row_risk(rows)).select("high_risk_rows").scalar()
    level = G.reid_risk(G.graph_rows(rows)).select("risk_level").scalar()
    lines = recommendations(F.col("total_detections"), high, level)
    return counts.select(F.posexplode(lines).alias("ord", "line")).select(*_long("ord"), "line")


def sanitize_text(spark, sf):
    pages = inputs.table(spark, sf, "pages")
    return pages.select("page_id", X.sanitize_text(F.col("html")).alias("clean"))


def sanitize_filename(spark, sf):
    pages = inputs.table(spark, sf, "pages")
    return pages.select("page_id", X.sanitize_filename(F.col("url")).alias("filename"))


def risk_badge(spark, sf):
    risks = risk.row_risk(_people_rows(spark, sf))
    return risks.select(
        "row_id",
        X.risk_badge(F.concat(F.upper("overall_risk"), F.lit(" !"))).alias("badge"),
        X.score_percent(F.col("context_score")).alias("score_pct"),
    )


def csv_round_trip(spark, sf):
    people = _people(spark, sf)
    base = stage_path(spark)
    write_masked(people, f"{base}/in.csv")
    df, key, text = load_csv(spark, f"{base}/in.csv", key="row_id")
    write_masked(mask.mask(df, key, text), f"{base}/out.csv")
    back, _, _ = load_csv(spark, f"{base}/out.csv", key="row_id")
    return back.select(F.col("row_id").cast("long").alias("row_id"), *inputs.PEOPLE_TEXT)


def _multi_line(spark, sf) -> str:
    """Documents as CSV files, texts with their line breaks and quotes; the text is longer by a quote."""
    path = f"{stage_path(spark)}/in.csv"
    quoted = F.concat("text", F.lit('\n"said", she')).alias("text")
    write_masked(_docs(spark, sf).filter("text is not null").select("row_id", quoted), path)
    return path


def csv_quoted_breaks(spark, sf):
    df, _, _ = load_csv(spark, _multi_line(spark, sf), key="row_id")
    return df.select(F.col("row_id").cast("long").alias("row_id"), F.length("text").cast("long").alias("n"), F.md5("text").alias("digest"))


def csv_keyless(spark, sf):
    """Rows numbered by their place in the files, a column ``row_id`` of the file kept beside."""
    df, key, _ = load_csv(spark, _multi_line(spark, sf))
    numbers = df.agg(
        F.count("*").alias("n_rows"), F.min(key).cast("long").alias("first"), F.max(key).cast("long").alias("last"),
        F.countDistinct(key).alias("n_numbers"), F.countDistinct("row_id").alias("n_ids"),
    )
    return numbers


def graph_export(spark, sf):
    path = stage_path(spark)
    export_graph(staged(_people_graph(spark, sf)), path, expanded=True)
    nodes = spark.read.schema("id string, data struct<type:string,row:long>").json(f"{path}/nodes")
    edges = spark.read.schema(
        "source string, target string, data struct<weight:double,relation_type:string>"
    ).json(f"{path}/edges")
    empty = F.lit(None).cast("string")
    return nodes.select(
        F.lit("node").alias("part"), "id", empty.alias("target"), F.col("data.type").alias("kind"),
        F.lit(None).cast("double").alias("weight"),
    ).unionByName(
        edges.select(
            F.lit("edge").alias("part"), F.col("source").alias("id"), "target",
            F.col("data.relation_type").alias("kind"), F.round("data.weight", 6).alias("weight"),
        )
    )


def graph_export_compact(spark, sf):
    path = stage_path(spark)
    export_graph(staged(_people_graph(spark, sf)), path)
    edges = spark.read.schema("source string, target string, data struct<weight:double,relation_type:string>").json(f"{path}/edges")
    links = spark.read.schema("row long, size long, links array<struct<type1:string,type2:string,count:long,weight:double>>")
    cliques = links.json(f"{path}/cliques").select("row", F.inline("links"))
    own = edges.groupBy(F.col("data.relation_type").alias("kind")).agg(
        F.count("*").alias("n"), F.round(F.sum("data.weight"), 4).alias("weight")
    )
    plain = cliques.groupBy(F.concat_ws("|", "type1", "type2").alias("kind")).agg(
        F.sum("count").alias("n"), F.round(F.sum(F.col("count") * F.col("weight")), 4).alias("weight")
    )
    return own.unionByName(plain)


def _job(spark, sf, **options) -> tuple:
    """The whole job over the table of people; what it wrote is read back."""
    out = stage_path(spark)
    done = run(spark, _people(spark, sf), out, key="row_id", masked_format="parquet", with_graph_export=False, **options)
    if not done.success:
        raise RuntimeError(done.error)
    return done


def job_masked_subset(spark, sf):
    """Two columns searched; the others leave masked by patterns and names."""
    return spark.read.parquet(_job(spark, sf, columns=["notes", "ssn"]).masked_path)


def job_components(spark, sf):
    return _components(spark.read.parquet(f"{_job(spark, sf).details_path}/components"))


def job_clusters(spark, sf):
    return _clusters(spark.read.parquet(f"{_job(spark, sf).details_path}/risk_clusters"))


QUERIES: dict[str, Query] = {
    **{f"detect_{name}": _detect_pattern(name) for name in K.DETECTION_PATTERNS},
    "detect_all": detect_all,
    "detect_cells": detect_cells,
    "detect_specific": detect_specific,
    "text_cells": text_cells,
    "gazetteer_entities": gazetteer,
    "detect_with_gazetteer": detect_with_gazetteer,
    "gazetteer_large": gazetteer_large,
    "gazetteer_risk": gazetteer_risk,
    "gazetteer_pair_risk": gazetteer_pair_risk,
    "mask_with_gazetteer": mask_with_gazetteer,
    "mask_documents_with_gazetteer": mask_documents_with_gazetteer,
    "graph_with_gazetteer": graph_with_gazetteer,
    "components_ranked": components_ranked,
    "clusters_ranked": clusters_ranked,
    "job_masked_subset": job_masked_subset,
    "job_components": job_components,
    "job_clusters": job_clusters,
    "detection_summary": detection_summary,
    "detection_by_type": detection_by_type,
    "affected_columns": affected_columns,
    "affected_rows": affected_rows,
    "row_text": row_texts,
    "proximity_pairs": proximity_pairs,
    "proximity_pairs_wide": proximity_pairs_wide,
    "pair_risk": pair_risk,
    "band_join_pairs": band_join_pairs,
    "inferred_patterns": _inference(_people_rows, "pattern"),
    "inferred_patterns_documents": _inference(_doc_rows, "pattern"),
    "context_window": context_window,
    "context_indicators": _indicators(_people_rows),
    "context_indicators_shared_basis": _indicators(_shared_rows),
    "inferred_context": _inference(_people_rows, "context"),
    "inferred_all": _inference(_people_rows, "all"),
    "inferred_all_shared_basis": _inference(_shared_rows, "all"),
    "context_score": context_score,
    "row_risk": _row_risk(_people_rows),
    "row_risk_documents": _row_risk(_doc_rows),
    "row_risk_shared_basis": _row_risk(_shared_rows),
    "proximity_summary": _proximity_summary(_people_rows),
    "proximity_summary_documents": _proximity_summary(_doc_rows),
    "graph_nodes": graph_nodes,
    "graph_edges": graph_edges,
    "graph_edges_detected": graph_edges_detected,
    "graph_stats": _graph_stats(_doc_graph),
    "graph_stats_people": _graph_stats(_people_graph),
    "components": components,
    "top_degree": _top("degree"),
    "top_betweenness": _top("betweenness"),
    "top_closeness": _top("closeness"),
    "risk_clusters": risk_clusters,
    "reid_risk": _reid(_doc_graph),
    "reid_risk_people": _reid(_people_graph),
    "graph_top_nodes": graph_top_nodes,
    "cliques_hold": cliques_hold,
    "mask_spans": mask_spans,
    "mask_from_detections": mask_from_detections,
    "mask_merged": mask_merged,
    "mask_patterns": mask_patterns,
    "mask_names": mask_names,
    "mask_full": mask_full,
    "mask_full_documents": mask_full_documents,
    "recommendations": advice,
    "report_row": report_row,
    "report_text": report_text,
    "report_file": report_file,
    "sanitize_text": sanitize_text,
    "sanitize_filename": sanitize_filename,
    "risk_badge": risk_badge,
    "csv_round_trip": csv_round_trip,
    "csv_quoted_breaks": csv_quoted_breaks,
    "csv_keyless": csv_keyless,
    "graph_export": graph_export,
    "graph_export_compact": graph_export_compact,
    "graph_compact": graph_compact,
    "graph_expanded": graph_expanded,
    "edges_stats": edges_stats,
    "edges_degree": edges_degree,
    "edges_top": edges_top,
    "edges_components": edges_components,
    "edges_uneven": edges_uneven,
}
