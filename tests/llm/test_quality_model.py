import zlib

import numpy as np

from veilspark.llm import quality_model as M


def test_gradients():
    rng = np.random.default_rng(0)
    per = np.array([1, 3, 2, 5])
    x, y = rng.standard_normal((11, M.WIDTH)), np.array([0.0, 1, 1, 0])
    model = M.Attention(hidden=5, gate=3)
    model.p = {k: v.astype(float) for k, v in model.p.items()}

    def loss():
        s = model.forward(x, per)[6]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    for k, g in model.gradients(x, per, y, 0.0).items():
        for at in [0, g.size // 2, g.size - 1]:
            value = model.p[k].flat[at]
            model.p[k].flat[at] = value + 1e-5
            up = loss()
            model.p[k].flat[at] = value - 1e-5
            down = loss()
            model.p[k].flat[at] = value
            assert abs((up - down) / 2e-5 - g.flat[at]) < 1e-4, k


def test_passages():
    texts = ["", "a b", "w " * 130, "x!! " * 64]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    x, per = M.passages(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    assert per.tolist() == [1, 1, 3, 1] and x[0, -1] == 1 and x[0, :-1].sum() == 0 and x[5, 6] > 0.4
    assert np.isfinite(x).all()


def test_held_out(spark):
    df, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in M.quality_scores(df, labels).collect()}
    assert len(got) == df.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got.values())
    held = [(got[r.doc_id], r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    right = sum(r.predicted == q for r, q in held) / len(held)
    good = [r.predicted for r, q in held if q == 1]
    bad = [r.predicted for r, q in held if q == 0]
    assert right > 0.96 and np.mean(good) > 0.98 and np.mean(bad) < 0.2, (right, np.mean(good), np.mean(bad))
    assert all(0 <= r.top_passage < r.n_passages for r in got.values())


def test_cases(spark, docs):
    df = docs([(None, "a b c"), (1, None), (1, "x " * 20000), (2, "x " * 20000), (3, "")]).withColumnRenamed("lang", "score")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (9, 1, 0), (3, None, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = M.quality_scores(df, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    long = [r.score for r in got if r.n_passages > 1]
    assert long[0] == long[1]
    assert {r.score for r in M.quality_scores(df, labels.limit(0)).collect()} == {0.5}
    assert M.quality_scores(df.limit(0), labels).count() == 0
