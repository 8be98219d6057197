"""The whole job: scan a table once, then mask, report and export from the scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veilspark import constants as K
from veilspark.functions.arrays import let
from veilspark.operators.cells import _named, row_text, text_columns
from veilspark.operators.detect import ModelHook, _entity, _prepare, spans_of
from veilspark.operators.gazetteer import Terms
from veilspark.operators.graph import node_array, ranked_clusters, ranked_components
from veilspark.operators.inference import inferred_array
from veilspark.operators.mask import (
    mask_merged, mask_names, mask_patterns, mask_spans, masked_text,
)
from veilspark.operators.proximity import assess, spelled_out, window_pairs
from veilspark.operators.risk import risk_struct
from veilspark.plans.report import failed_graph_summary, graph_summary, report
from veilspark.sources.exports import export_graph, write_report
from veilspark.sources.stage import drop_stage, stage_path, staged
from veilspark.sources.tables import (
    InputError, load_csv, read_table, source_format, spread, validate_input, write_masked,
)


@dataclass(frozen=True)
class RunResult:
    success: bool
    error: str | None = None
    report_path: str | None = None
    masked_path: str | None = None
    details_path: str | None = None
    graph_path: str | None = None
    messages: list[str] = field(default_factory=list)


def scan(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    window: int = K.WINDOW,
    precedence: str = "reference",
    offset_basis: str = "cell",
    overlap: str = "reference",
    model: ModelHook | None = None,
    dictionary: DataFrame | Terms | None = None,
    extra_columns: Sequence[str] | None = None,
    pairs_with_entities: bool = True,
) -> DataFrame:
    """Masked cells and all findings of every row, in one map-only pass.

    Each cell of ``columns`` is searched once; its spans feed both the mask and the
    entities.  ``extra_columns`` (every other text column by default) are not searched,
    but the masking patterns and names run over them, so nothing leaves in clear for
    not being chosen.  Columns: ``row_id, masked`` (the table's columns, masked),
    ``entities, row_text, pairs, inferred, risk, nodes``; all but the first two are
    NULL or empty in rows without entities.  The table's own columns travel in one
    struct, so they may have any name.  Without ``pairs_with_entities`` the pairs name
    their entities by place, which is all that ``spelled_out`` needs.
    """
    base, cells = _prepare(df, key, columns, offset_basis, model, dictionary)
    by_spans = mask_spans if overlap == "reference" else mask_merged

    def seen(c: Column) -> Column:
        return let(
            spans_of(c, precedence, model is not None, dictionary is not None),
            lambda s: F.struct(
                F.transform(s, lambda x: _entity(c, x)).alias("entities"),
                mask_names(mask_patterns(by_spans(c["text"], s))).alias("masked"),
            ),
        )

    filled = F.transform(
        cells,
        lambda c: F.when(c["text"].isNotNull() & (c["text"] != ""), seen(c)).otherwise(
            F.struct(F.array().alias("entities"), c["text"].alias("masked"))
        ),
    )
    row = let(
        filled,
        lambda done: F.struct(
            F.flatten(F.transform(done, lambda d: d["entities"])).alias("entities"),
            F.transform(done, lambda d: d["masked"]).alias("texts"),
        ),
    )
    passed = [c for c in df.columns if c != key]
    place = {c: i for i, c in enumerate(columns)}
    if extra_columns is None:
        extra_columns = text_columns(df, key)
    others = {c for c in extra_columns if c not in place and c != key}
    found = base.select(
        _named(key).alias("row_id"),
        F.struct(F.lit(0).alias("\x01"), *[_named(c).alias(c) for c in passed if c not in place]).alias("passed"),
        row_text(df, key).alias("_row_text"),
        F.inline(F.array(row)),
    )

    def out(name: str) -> Column:
        if name in place:
            return F.get(F.col("texts"), F.lit(place[name]))
        value = F.col("passed").getField(name)
        return masked_text(value.cast("string"), None) if name in others else value

    masked = F.struct(F.col("row_id").alias(key), *[out(c).alias(c) for c in passed])
    text, entities = F.col("_row_text"), F.col("entities")
    some = F.size(entities) > 0
    linked = found.select(
        "row_id",
        masked.alias("masked"),
        "entities",
        F.when(some, text).alias("row_text"),
        F.when(some, window_pairs(entities, window, text, pairs_with_entities)).alias("pairs"),
        F.when(some, inferred_array(text, entities, window)).alias("inferred"),
    )
    return linked.select(
        "*",
        F.when(some, risk_struct(F.col("row_text"), F.col("pairs"), window)).alias("risk"),
        F.when(some, node_array(F.col("row_id"), entities, F.col("inferred"))).alias("nodes"),
    )


def run(
    spark: SparkSession,
    source: str | DataFrame,
    output_dir: str,
    key: str | None = None,
    columns: Sequence[str] | None = None,
    window: int = K.WINDOW,
    max_mb: float | None = None,
    masked_format: str = "csv",
    with_graph_export: bool = True,
    keep_scan: bool = False,
    **options,
) -> RunResult:
    """Validate, detect, analyse, report and mask; errors come back in the result.

    ``source`` is a path or a frame (a frame needs ``key``).  The scan is written
    once to a folder under ``output_dir``, so a lost executor costs a re-read and
    never a second detection; it holds the findings in clear and is deleted at
    the end unless ``keep_scan``.

    ``options`` go to ``scan``: a ``model``, a ``dictionary`` (term, label), precedence
    and the like.  Text columns outside ``columns`` are masked by patterns and names.
    Details: detections, relations, assessments, inferred, row_risk, components and
    risk_clusters, the last two with their rank by risk.
    """
    messages: list[str] = []
    stage = stage_path(spark, output_dir)
    try:
        return _run(
            spark, source, output_dir, key, columns, window, max_mb, masked_format,
            with_graph_export, stage, messages, options,
        )
    except Exception as e:  # the record carries the first error of any stage
        return RunResult(False, str(e), messages=[*messages, f"Error: {e}"])
    finally:
        if not keep_scan:
            drop_stage(spark, stage)


def _load(spark, source, key, columns, max_mb, stage, messages):
    if isinstance(source, DataFrame):
        if key is None:
            raise InputError("a DataFrame needs key=")
        return source, key, columns, text_columns(source, key)
    info = validate_input(spark, source, max_mb)
    messages.append(f"Validated input with {info.n_rows} rows and {info.n_columns} columns")
    if source_format(source) == "csv":
        df, key, text = load_csv(spark, source, key=key, stage=f"{stage}/rows")
        return df, key, columns, text
    if key is None:
        raise InputError("a keyless table must be CSV; give key=")
    df = read_table(spark, source)
    return df, key, columns, text_columns(df, key)


def _run(
    spark, source, output_dir, key, columns, window, max_mb, masked_format,
    with_graph_export, stage, messages, options,
) -> RunResult:
    name = source if isinstance(source, str) else "DataFrame"
    keyless = isinstance(source, str) and key is None
    df, key, columns, text = _load(spark, source, key, columns, max_mb, stage, messages)
    columns = list(text if columns is None else columns)

    scanned = scan(spread(df, key), key, columns, window, extra_columns=text, pairs_with_entities=False, **options)
    done = staged(scanned, f"{stage}/scan")
    # rows with entities, told by one number, as each table below reads its own columns only
    hits = done.filter(F.col("risk.n_pairs").isNotNull())
    rows = hits.select("row_id", "row_text", "entities")
    risks = hits.select("row_id", "risk.*")

    details = f"{output_dir}/details"
    pairs = spelled_out(hits)
    tables = {
        "detections": rows.select(
            "row_id", F.posexplode("entities").alias("ent_ord", "e")
        ).select("row_id", "ent_ord", "e.*").drop("base"),
        "relations": pairs,
        "assessments": assess(pairs, window),
        "inferred": hits.select("row_id", F.posexplode("inferred").alias("inf_ord", "i")).select(
            "row_id", "inf_ord", "i.*"
        ),
        "row_risk": risks,
    }
    for table, frame in tables.items():
        frame.write.mode("overwrite").parquet(f"{details}/{table}")

    counts = hits.agg(
        F.coalesce(F.sum(F.size("entities").cast("long")), F.lit(0)).alias("n"),
        F.count_if(F.col("risk.overall_risk") == "high").alias("high"),
    ).first()
    messages.append(f"Detection completed: {counts['n']} entities found")
    messages.append(f"Proximity analysis completed: {counts['high']} high-risk rows identified")

    graph = hits.select("row_id", "nodes")
    graph_path = None
    try:
        part = graph_summary(graph)
        summary_row = part.first()
        part = spark.createDataFrame([summary_row], part.schema)
        for table, frame in (
            ("components", ranked_components(graph, f"{stage}/components")),
            ("risk_clusters", ranked_clusters(graph, f"{stage}/clusters")),
        ):
            frame.write.mode("overwrite").parquet(f"{details}/{table}")
        if with_graph_export:
            export_graph(graph, f"{output_dir}/graph", window)
            graph_path = f"{output_dir}/graph"
        stats = summary_row["graph_stats"]
        messages.append(
            f"Graph analysis completed: {stats['nodes']} nodes, {stats['edges']} edges"
        )
    except Exception as e:  # a failed graph does not stop the run
        part = failed_graph_summary(graph, str(e))
        messages.append("Graph analysis encountered issues but the run continued")

    report_path = f"{output_dir}/report"
    write_report(report(rows, risks, part, name, window), report_path)
    messages.append(f"Report generated and saved to {report_path}")

    masked_path = f"{output_dir}/masked"
    masked = done.select("masked.*")
    write_masked(masked.drop(key) if keyless else masked, masked_path, masked_format)
    messages.append(f"Masked table saved to {masked_path}")
    return RunResult(
        True, None, report_path, masked_path, details, graph_path, messages
    )
