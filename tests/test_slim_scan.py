"""What the scan of the whole job need not hold, and the steps behind it need not read."""

from pyspark.sql import functions as F

from veilspark.operators.detect import entity_rows
from veilspark.operators.graph import components, graph_rows, graph_totals, risk_clusters, top_central
from veilspark.operators.proximity import assess, relations, spelled_out
from veilspark.plans.run import scan

TEXTS = [
    "John Doe, 123-45-6789, john@x.example.com, Jane Roe 555-123-4567, born 01/02/1990, Patient at home",
    "no one", None, "Jane Roe Jane Roe 12345 4111111111111111 salary",
]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_names_entities_of_pairs_by_place(texts):
    df = texts(TEXTS)
    slim = scan(df, "id", ["t"], pairs_with_entities=False)
    fields = {f.name for f in slim.schema["pairs"].dataType.elementType.fields}
    assert not fields & {"e1", "e2"}
    hits = slim.filter(F.col("risk.n_pairs").isNotNull())
    assert hits.count() == slim.filter(F.size("entities") > 0).count() == 2
    want = relations(entity_rows(df, "id"))
    got = spelled_out(hits)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 3
    assert sorted(map(str, assess(got).collect())) == sorted(map(str, assess(want).collect()))


def test_statistics_read_only_their_fields_of_a_node(spark, texts, tmp_path):
    path = str(tmp_path / "graph")
    graph_rows(entity_rows(texts(TEXTS), "id")).write.parquet(path)
    graph = spark.read.parquet(path)
    whole = graph.localCheckpoint()
    for step in (components, risk_clusters, graph_totals, top_central, lambda g: top_central(g, "closeness")):
        plan = _plan(step(graph))
        assert "ReadSchema" in plan and "confidence" not in plan and "risk_level" not in plan
        assert sorted(map(str, step(graph).collect())) == sorted(map(str, step(whole).collect()))
