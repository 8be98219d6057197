import glob
import json

import pytest

from tests import plain
from veilspark.plans.report import failed_graph_summary, text_summary
from veilspark.operators.gazetteer import measured
from veilspark.plans import run as R
from veilspark.sources.exports import read_report
from veilspark.sources.tables import load_csv

# A harbour log, made for what a job must meet in one file: free text with several findings
# in a cell, a quoted comma, doubled quotes, a quoted line break, gaps, a short row, a
# missing-value token, a column of bare numbers (not text) and one without any finding.
LOG = [
    ["berth", "watch", "entry", "signal", "tons"],
    ["North Quay 4", "", "Pilot Ivo Brandt asked for 07/04/1988 papers, mail ivo@skiff.example", "10.8.0.77", "410"],
    ["South Quay 1", "night", "crate 4929123412341234 held\nuntil noon", "", "22"],
    ["Basin", "NA", 'the "Gull" left; ring +1 303 555 0117 or 303.555.0118', "fog, 2 blasts", "9"],
    ["Basin", "day", "Lena Ortiz and Kofi Mensah swapped, ref 219-09-9999", "ok", "1300"],
    ["Mole", "day", "nothing to report"],
    ["Mole", "night", "send bills to 30117-2210, Lena Ortiz", "lena_o@gull.example", "75"],
]
TEXT = ["berth", "watch", "entry", "signal"]


def csv_text(rows):
    def cell(c):
        return '"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n') else c

    return "".join(",".join(map(cell, r)) + "\n" for r in rows)


def cells_of_log():
    """Text cells by row, missing ones as None."""
    known = [[c if c not in ("", "NA") else None for c in r] + [None] * (5 - len(r)) for r in LOG[1:]]
    return [r[:4] for r in known]


@pytest.fixture(scope="module")
def demo(spark, tmp_path_factory):
    home = tmp_path_factory.mktemp("demo")
    (home / "demo.csv").write_text(csv_text(LOG))
    stages = f"{spark.conf.get('spark.checkpoint.dir')}/_scan-*"
    before = set(glob.glob(stages))
    result = R.run(spark, str(home / "demo.csv"), str(home / "out"))
    return result, home, set(glob.glob(stages)) - before


def test_demo_outputs(spark, demo):
    result, home, left_behind = demo
    assert result.success and result.error is None
    assert result.messages[0] == "Validated input with 6 rows and 5 columns"
    report = json.loads(open(glob.glob(f"{result.report_path}/*.json")[0]).read())
    cells = cells_of_log()
    found_in = [sum(len(plain.entities(c)) for c in r if c) for r in cells]
    want = sum(found_in)
    assert report["ner_summary"]["total_detections"] == want
    assert report["ner_summary"]["n_rows_affected"] == sum(n > 0 for n in found_in) == 5
    assert report["proximity_summary"]["total_analyses"] == 5
    assert report["metadata"]["proximity_window"] == 50
    assert f"Found {want} PII entities." in report["recommendations"][0]
    found = spark.read.parquet(f"{result.details_path}/detections")
    assert found.count() == want
    masked, _, _ = load_csv(spark, result.masked_path, key=None)
    got = sorted((tuple(r[c] for c in TEXT) for r in masked.collect()), key=str)
    assert got == sorted((tuple(c and plain.mask_all(c) for c in r) for r in cells), key=str)
    assert sorted(r.tons or "" for r in masked.collect()) == sorted(r[4] if len(r) > 4 else "" for r in LOG[1:])
    for table, key in (("components", "component_id"), ("risk_clusters", "row_id")):
        rows = spark.read.parquet(f"{result.details_path}/{table}").orderBy("rank").collect()
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1)) and rows
        assert [(-round(r.risk_score, 9), r[key]) for r in rows] == sorted((-round(r.risk_score, 9), r[key]) for r in rows)
    assert spark.read.parquet(f"{result.details_path}/components").count() == report["graph_summary"]["n_components"]
    nodes = spark.read.json(f"{result.graph_path}/nodes")
    edges = spark.read.json(f"{result.graph_path}/edges")
    stats = report["graph_summary"]["graph_stats"]
    cliques = spark.read.json(f"{result.graph_path}/cliques")  # all edges without a weight of their own
    plain_ones = cliques.selectExpr("inline(links)").agg({"count": "sum"}).first()[0]
    assert (nodes.count(), edges.count() + plain_ones) == (stats["nodes"], stats["edges"])
    assert edges.count() < stats["edges"] and cliques.count() == report["graph_summary"]["n_components"]
    assert set(nodes.columns) == {"id", "data"} and set(edges.columns) == {
        "source", "target", "data",
    }
    assert left_behind == set()  # findings in clear do not stay behind


def test_report_text(spark, demo):
    result, _, _ = demo
    report = read_report(spark, result.report_path)
    assert report.count() == 1
    lines = [r.line for r in text_summary(
        report.withColumn("ner_summary", report["ner_summary"].withField(
            "detection_types", R.F.from_json(
                R.F.to_json("ner_summary.detection_types"), "map<string,bigint>")))
    ).orderBy("ord").collect()]
    assert lines[0].startswith("Total PII Entities Detected: ")
    assert any(x.startswith("Graph Density: 0.") for x in lines)
    assert any(x.startswith("Credit_Card: ") for x in lines) and any(x.startswith("Ip_Address: ") for x in lines)
    assert lines[-1].endswith("Regular PII audits should be conducted to maintain compliance.")


def test_errors_come_back_in_the_result(spark, tmp_path):
    (tmp_path / "r.csv").write_text("a,b\n1,2,3\n")
    bad = R.run(spark, str(tmp_path / "r.csv"), str(tmp_path / "o"))
    assert not bad.success and "more fields" in bad.error and bad.masked_path is None
    gone = R.run(spark, str(tmp_path / "x.csv"), str(tmp_path / "o"))
    assert "not found" in gone.error and gone.messages[-1].startswith("Error: ")
    df = spark.createDataFrame([(1, "x")], "id long, t string")
    assert "key" in R.run(spark, df, str(tmp_path / "o")).error


def test_table_without_findings(spark, tmp_path):
    df = spark.createDataFrame([(1, "nothing here", 5), (2, None, 6)], "id long, t string, n int")
    done = R.run(spark, df, str(tmp_path / "o"), key="id", masked_format="parquet")
    assert done.success, done.error
    assert sorted(spark.read.parquet(done.masked_path).collect()) == sorted(df.collect())
    report = json.loads(open(glob.glob(f"{done.report_path}/*.json")[0]).read())
    assert report["ner_summary"]["total_detections"] == 0
    assert report["graph_summary"]["error"] == "No entities found in graph"
    assert len(report["recommendations"]) == 3


def test_graph_failure_does_not_stop_the_run(spark, tmp_path, monkeypatch):
    def broken(*_a, **_k):
        raise RuntimeError("boom")

    monkeypatch.setattr(R, "export_graph", broken)
    df = spark.createDataFrame([(1, "John Doe 85001")], "id long, t string")
    done = R.run(spark, df, str(tmp_path / "o"), key="id")
    assert done.success
    report = json.loads(open(glob.glob(f"{done.report_path}/*.json")[0]).read())
    assert report["graph_summary"]["error"] == "boom"
    assert report["graph_summary"]["graph_stats"]["nodes"] == 0
    assert failed_graph_summary is R.failed_graph_summary
    assert done.graph_path is None  # nothing whole was written there


def test_columns_that_were_not_chosen_are_masked_too(spark, tmp_path):
    """Only the chosen column is searched; the other leaves without personal data all the same."""
    df = spark.createDataFrame([(1, "x", "mail bob@test.net Jane Smith", 5)], "id long, a string, b string, n int")
    done = R.run(spark, df, str(tmp_path / "o"), key="id", columns=["a"], masked_format="parquet")
    assert done.success, done.error
    row = spark.read.parquet(done.masked_path).first()
    assert (row.a, row.b, row.n) == ("x", "mail *** ***", 5)
    assert spark.read.parquet(f"{done.details_path}/detections").count() == 0
    (tmp_path / "t.csv").write_text("id,a,b,n\n1,x,mail bob@test.net Jane Smith,85001\n2,y,z,85002\n")
    done = R.run(spark, str(tmp_path / "t.csv"), str(tmp_path / "c"), key="id", columns=["a"])
    assert done.success, done.error
    back, _, _ = load_csv(spark, done.masked_path, key="id")
    assert sorted((r.a, r.b, r.n) for r in back.collect()) == [("x", "mail *** ***", "85001"), ("y", "z", "85002")]


def test_columns_of_any_name(spark, tmp_path):
    names = ["entities", "row_text", "texts", "passed", "masked", "_row_text", "row_id", "nodes"]
    df = spark.createDataFrame([(1, *["Jane Smith"] * len(names))], "id long, " + ", ".join(f"{n} string" for n in names))
    done = R.run(spark, df, str(tmp_path / "o"), key="id", masked_format="parquet")
    assert done.success, done.error
    row = spark.read.parquet(done.masked_path).first()
    assert row.__fields__ == ["id", *names] and set(row[1:]) == {"***"}


@pytest.mark.parametrize("large", [False, True])
def test_dictionary_in_the_whole_job(spark, tmp_path, large):
    terms = spark.createDataFrame(
        [("Gull", "ORG"), ("Lena Ortiz", "PERSON"), ("North Quay", "ADDRESS"), ("left ring", "GPE")], "term string, label string"
    )
    if large:
        terms = measured(terms, broadcast_terms=0)
    (tmp_path / "log.csv").write_text(csv_text(LOG))
    done = R.run(spark, str(tmp_path / "log.csv"), str(tmp_path / "o"), dictionary=terms)
    assert done.success, done.error
    found = spark.read.parquet(f"{done.details_path}/detections").filter("method = 'gazetteer'").collect()
    assert sorted((r.column, r.text, r.type, r.confidence) for r in found) == [
        ("berth", "North Quay", "address", 0.9), ("entry", "Gull", "organization", 0.9),
        ("entry", "Lena Ortiz", "name", 0.9), ("entry", "Lena Ortiz", "name", 0.9), ("entry", "left; ring", "location", 0.9),
    ]
    masked, _, _ = load_csv(spark, done.masked_path)
    entries = " ".join(r.entry for r in masked.collect())
    assert "Gull" not in entries and "Lena" not in entries and "left" not in entries
    assert sorted(r.berth for r in masked.collect()) == ["*** 1", "*** 4", "Basin", "Basin", "Mole", "Mole"]
    high = spark.read.parquet(f"{done.details_path}/assessments").filter("type1 = 'address' or type2 = 'address'")
    assert {r.risk_level for r in high.filter("type1 = 'name' or type2 = 'name'").collect()} == {"high"}
    nodes = spark.read.json(f"{done.graph_path}/nodes")
    assert nodes.filter("data.method = 'gazetteer' and data.type = 'address'").count() == 1
