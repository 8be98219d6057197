"""Quality classifier by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` words.  Every passage is encoded, a
gated attention learnt from labels of whole texts weighs the passages, and the
weighted passage representation gives the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from veilspark.llm.frames import fold
from veilspark.llm.words import buffers, row_blocks, split_words

PASSAGE = 64
_CLASSES = np.zeros((9, 256), bool)
for _b in range(256):
    _c = chr(_b)
    _CLASSES[0, _b] = _b < 128 and _c.isupper()
    _CLASSES[1, _b] = _b < 128 and _c.islower()
    _CLASSES[2, _b] = _b < 128 and _c.isdigit()
    _CLASSES[3, _b] = _b >= 128
    _CLASSES[4, _b] = _c in "#*$%&<>"
    _CLASSES[5, _b] = _c == "|"
    _CLASSES[6, _b] = _c == "!"
    _CLASSES[7, _b] = _c in ".,;:?"
    _CLASSES[8, _b] = _c == "\n"
_BINS = np.array([1, 2, 3, 5, 8, 13, 21])
WIDTH = 9 + 5 + len(_BINS) + 1 + 2


def passages(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of a block of rows, and the passages of each row.
    A row without words has one passage, all zero but for a mark."""
    words = split_words(data, at)
    per = np.maximum(-(-words.counts // PASSAGE), 1)
    total = int(per.sum())
    x = np.zeros((total, WIDTH), np.float32)
    first = np.concatenate([[0], np.cumsum(per)])
    if not len(words.hash):
        x[:, -1] = 1
        return x, per
    row = words.row
    bag = first[row] + (np.arange(len(row)) - words.first[row]) // PASSAGE
    n = np.bincount(bag, minlength=total).astype(np.float32)
    full = n > 0
    heads = np.flatnonzero(np.append(True, bag[1:] != bag[:-1]))
    start, end = words.start[heads], words.end[np.append(heads[1:], len(bag)) - 1]
    size = np.maximum(end - start, 1)
    for k, table in enumerate(_CLASSES):
        seen = np.concatenate([[0], np.cumsum(table[data])])
        x[full, k] = (seen[end] - seen[start]) / size
    length = (words.end - words.start).astype(np.float32)
    mean = np.bincount(bag, length, total) / np.maximum(n, 1)
    x[:, 9] = np.log1p(mean)
    x[:, 10] = np.sqrt(np.maximum(np.bincount(bag, length * length, total) / np.maximum(n, 1) - mean**2, 0))
    x[:, 11] = np.log1p(n) / np.log1p(PASSAGE)
    same = np.zeros(len(bag), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (bag[1:] == bag[:-1])
    x[:, 12] = np.bincount(bag, same, total) / np.maximum(n, 1)
    order = np.lexsort((words.hash, bag))
    again = np.zeros(len(bag), bool)
    again[1:] = (words.hash[order][1:] == words.hash[order][:-1]) & (bag[order][1:] == bag[order][:-1])
    x[:, 13] = np.bincount(bag[order], again, total) / np.maximum(n, 1)
    bins = np.searchsorted(_BINS, length)
    shape = np.bincount(bag * (len(_BINS) + 1) + bins, minlength=total * (len(_BINS) + 1)).reshape(total, -1)
    x[:, 14 : 14 + len(_BINS) + 1] = shape / np.maximum(n, 1)[:, None]
    x[:, -2] = np.repeat(per > 1, per)
    x[:, -1] = ~full
    return x, per


def _bags(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    data, at = buffers(column)
    for first, last in row_blocks(at):
        yield passages(data[at[first] : at[last]], at[first : last + 1] - at[first])


class Attention:
    """Encoder, gated attention and output; sizes are fixed."""

    def __init__(self, hidden: int = 24, gate: int = 12, seed: int = 7):
        rng = np.random.Generator(np.random.PCG64(seed))
        draw = lambda a, b: (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.mean, self.scale = np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32)
        self.p = {
            "w1": draw(WIDTH, hidden), "b1": np.zeros(hidden, np.float32), "v": draw(hidden, gate), "u": draw(hidden, gate),
            "w": draw(gate, 1)[:, 0], "c": draw(hidden, 1)[:, 0], "c0": np.zeros(1, np.float32),
        }

    def forward(self, x: np.ndarray, per: np.ndarray):
        p = self.p
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["w1"] + p["b1"])
        av, au = np.tanh(h @ p["v"]), 1 / (1 + np.exp(-(h @ p["u"])))
        s = (av * au) @ p["w"]
        heads = np.concatenate([[0], np.cumsum(per)[:-1]])
        e = np.exp(s - np.repeat(np.maximum.reduceat(s, heads), per))
        a = e / np.repeat(np.add.reduceat(e, heads), per)
        z = np.add.reduceat(h * a[:, None], heads, axis=0)
        logit = np.clip(z @ p["c"] + p["c0"], -30, 30)
        return x, h, av, au, a, z, 1 / (1 + np.exp(-logit)), heads

    def gradients(self, x: np.ndarray, per: np.ndarray, y: np.ndarray, penalty: float) -> dict[str, np.ndarray]:
        p = self.p
        x, h, av, au, a, z, score, heads = self.forward(x, per)
        d = ((score - y) / len(y)).astype(np.float32)
        dz = np.repeat(d[:, None] * p["c"], per, axis=0)
        da = (dz * h).sum(1)
        ds = a * (da - np.repeat(np.add.reduceat(a * da, heads), per))
        dv = ds[:, None] * p["w"] * au * (1 - av * av)
        du = ds[:, None] * p["w"] * av * au * (1 - au)
        dh = (a[:, None] * dz + dv @ p["v"].T + du @ p["u"].T) * (1 - h * h)
        out = {
            "w1": x.T @ dh, "b1": dh.sum(0), "v": h.T @ dv, "u": h.T @ du, "w": (av * au).T @ ds,
            "c": z.T @ d, "c0": d.sum(keepdims=True),
        }
        return {k: g + penalty * p[k] for k, g in out.items()}

    def fit(self, x: np.ndarray, per: np.ndarray, y: np.ndarray, rounds: int = 250, penalty: float = 1e-4) -> "Attention":
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for t in range(1, rounds + 1):
            for k, g in self.gradients(x, per, y, penalty).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                self.p[k] = (self.p[k] - 0.02 * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
        return self


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = 4000,
    cut: float = 0.3,
) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages, top_passage`` for every row.

    Fitted on about ``sample`` labelled rows (the bound of the sample; chosen by
    a hash of the id, whole texts) among those whose crc32 of the id as text,
    modulo 5, is not 0.  Inputs of a score are the text's passages only.
    ``predicted`` is 1 from ``cut`` on; ``top_passage`` is the passage (from 0)
    that attention weighs most.

    A null, empty or wordless text is one empty passage and gets a score too.
    Null labels and labels without a text are ignored; several labels of one id
    all count.  Without labels, or with labels of one kind only, the score is
    the share of good labels (0.5 without any).  Equal texts get equal scores;
    an empty table gives an empty result.  Two passes, no shuffle of texts.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), (fold(doc_id, 5) == 0).alias("held_out"), F.col(f"`{text}`").alias("__text"))
    known = labels.filter(F.col(f"`{label}`").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", 5) != 0))
    share = sample / max(known.count(), sample)
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0 < share).select(
        F.col("doc_id").alias("__id"), (F.col(f"`{label}`") > 0).cast("int").alias("__label")
    )
    rows = source.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("__label", "__text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [x[a:b].tobytes() for x, per in _bags(batch.column(1)) for a, b in zip(np.cumsum(per) - per, np.cumsum(per), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["label", "x"])

    found = sorted((bytes(r["x"]), r["label"]) for r in rows.mapInArrow(extract, "label int, x binary").collect())
    model, base = None, 0.5
    if found:
        y = np.array([f[1] for f in found], np.float32)
        base = float(y.mean())
        if 0 < base < 1:
            per = np.array([len(f[0]) // (4 * WIDTH) for f in found])
            x = np.frombuffer(b"".join(f[0] for f in found), np.float32).reshape(-1, WIDTH)
            model = Attention().fit(x, per, y)
    shared = spark.sparkContext.broadcast((model, base))
    schema = source.drop("__text").schema.add("score", "double").add("predicted", "integer").add("n_passages", "long").add("top_passage", "long")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, base = shared.value
        for batch in batches:
            score, count, top = [np.zeros(0)], [np.zeros(0, int)], [np.zeros(0, int)]
            for x, per in _bags(batch.column(2)):
                count.append(per)
                heads = np.cumsum(per) - per
                if model is None:
                    score.append(np.full(len(per), base))
                    top.append(np.zeros(len(per), int))
                    continue
                *_, a, _, s, _ = model.forward(x, per)
                score.append(s.astype(float))
                best = np.flatnonzero(a == np.repeat(np.maximum.reduceat(a, heads), per))
                bag = np.repeat(np.arange(len(per)), per)[best]
                top.append((best - heads[bag])[np.unique(bag, return_index=True)[1]])
            score = np.concatenate(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array((score >= cut).astype(np.int32)),
                 pa.array(np.concatenate(count), pa.int64()), pa.array(np.concatenate(top), pa.int64())],
                names=schema.names,
            )

    return source.mapInArrow(predict, schema)
