import pytest

from veilspark.operators.detect import detect, entity_rows
from veilspark.operators.mask import mask
from veilspark.operators.risk import row_risk
from veilspark.streaming.stream import detect_stream, mask_stream, risk_stream

SF = "/root/testdata/sf0.001/documents.parquet"


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    """The documents as two files in a folder, plus their batch form."""
    home = tmp_path_factory.mktemp("stream")
    docs = spark.read.parquet(SF).select("doc_id", "text")
    docs.repartition(2, "doc_id").write.parquet(str(home / "in"))
    return docs, str(home / "in"), home


@pytest.mark.parametrize("start,batch", [
    (detect_stream, detect),
    (mask_stream, mask),
    (risk_stream, lambda df, key: row_risk(entity_rows(df, key))),
])
def test_stream_equals_batch(spark, source, start, batch):
    docs, folder, home = source
    stream = (
        spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    )
    out, checkpoint = str(home / start.__name__), str(home / f"{start.__name__}-cp")
    query = start(stream, "doc_id", out, checkpoint)
    query.awaitTermination(120)
    assert query.exception() is None
    got = spark.read.parquet(out)
    want = batch(docs, "doc_id")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(
        map(str, want.collect())
    )
