"""Language identification with error-correcting output codes.

Every language has a codeword of bits.  One binary classifier per bit, over
hashed byte n-grams, predicts that bit of a text's codeword; loss-weighted
decoding chooses the language whose codeword costs least, and a small distance
to the second is flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from veilspark.llm.frames import fold
from veilspark.llm.words import buffers, lowered, row_blocks

DIMS = 8192
ROWS = 256
# Bytes that are no letters in UTF-8 texts count as one separator.
_GAP = np.arange(256, dtype=np.uint8)
for _b in range(128):
    if not chr(_b).isalpha():
        _GAP[_b] = 32


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of hashed byte 2- and 3-gram weights (square roots of shares, unit length)."""
    rows = len(at) - 1
    b = np.concatenate([_GAP[lowered(data)], [32, 32]]).astype(np.uint32)
    row = np.repeat(np.arange(rows, dtype=np.int64), np.diff(at))
    two = (b[:-2] * 257 + b[1:-1]) * np.uint32(2654435761) >> np.uint32(20)
    three = ((b[:-2] * 257 + b[1:-1]) * 257 + b[2:]) * np.uint32(2246822519) >> np.uint32(20)
    half = DIMS // 2
    counts = np.bincount(row * DIMS + two % half, minlength=rows * DIMS)
    counts += np.bincount(row * DIMS + half + three % half, minlength=rows * DIMS)
    x = np.sqrt(counts.reshape(rows, DIMS).astype(np.float32))
    x /= np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)
    return x


def feature_blocks(column: pa.Array) -> Iterator[np.ndarray]:
    data, at = buffers(column)
    for first, last in row_blocks(at):
        for a in range(first, last, ROWS):
            b = min(a + ROWS, last)
            yield features(data[at[a] : at[b]], at[a : b + 1] - at[a])


def codewords(n: int) -> np.ndarray:
    """``n`` codewords of +1 and -1: all useful columns up to 6 languages, else the
    random code (fixed seed) with the largest least distance of 200 tries."""
    if n <= 1:
        return np.ones((n, 1), np.float32)
    if n <= 6:
        columns = [[1 if i == 0 or (c >> (i - 1)) & 1 else -1 for i in range(n)] for c in range(2 ** (n - 1) - 1)]
        return np.array(columns, np.float32).T
    rng = np.random.Generator(np.random.PCG64(5))
    bits, best, least = int(np.ceil(8 * np.log2(n))), None, -1.0
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.float32), (n, bits))
        code = code[:, np.abs(code.sum(0)) < n]
        gram = code @ code.T
        np.fill_diagonal(gram, -np.inf)
        distance = (code.shape[1] - gram.max()) / 2
        if distance > least:
            best, least = code, distance
    return best


def fit(x: np.ndarray, y: np.ndarray, code: np.ndarray, steps: int = 200, penalty: float = 1e-4):
    """Logistic classifiers for all bits at once; also the weight of each bit."""
    target = code[y]
    share = 1.0 / np.bincount(y, minlength=len(code))[y]
    share = (share / share.sum()).astype(np.float32)[:, None]
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    first = [np.zeros_like(w), np.zeros_like(b)]
    second = [np.zeros_like(w), np.zeros_like(b)]
    for step in range(1, steps + 1):
        margin = target * (x @ w + b)
        g = -target * share / (1 + np.exp(np.clip(margin, -30, 30)))
        for k, (value, grad) in enumerate(((w, x.T @ g + penalty * w), (b, g.sum(0)))):
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.99 * second[k] + 0.01 * grad * grad
            value -= 0.2 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    loss = np.log1p(np.exp(-np.clip(target * (x @ w + b), -30, 30)))
    weight = 1.0 / (0.05 + (share * loss).sum(0))
    return w, b, (weight / weight.sum()).astype(np.float32)


def decode(margins: np.ndarray, code: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language, its share among all, and its lead over the second."""
    loss = np.stack([(weight * np.log1p(np.exp(-np.clip(margins * c, -30, 30)))).sum(1) for c in code], 1)
    p = np.exp(-4 * (loss - loss.min(1, keepdims=True)))
    p /= p.sum(1, keepdims=True)
    best = p.argmax(1)
    top = np.sort(p, 1)
    lead = top[:, -1] - top[:, -2] if p.shape[1] > 1 else np.ones(len(p))
    return best, p[np.arange(len(p)), best], lead


def _sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` rows of every language, chosen by a hash of their text:
    no sort, no group in one task."""
    counts = {r["__lang"]: r["n"] for r in labelled.groupBy("__lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return labelled
    share = F.element_at(F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, per_language / n))]), F.col("__lang"))
    return labelled.filter((F.pmod(F.xxhash64("__text"), F.lit(1_000_003)) / 1_000_003.0) < share)


def identify(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    doc_id: str = "doc_id",
    per_language: int = 400,
    ambiguous_below: float = 0.2,
) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, ambiguous`` for every row of ``docs``.

    Learnt from the text and non-null ``lang`` of rows whose crc32 of the id as
    text, modulo 3, is not 1: whole texts of about ``per_language`` rows of each
    language (the bound of the sample), chosen by a hash of the text.  Neither
    the language, nor the id nor any further column is an input of a
    prediction, so equal texts get equal results.

    A text that is null or holds no letter is ``und`` with score 0.  Without any
    labelled text all rows are ``und``; with one language every text with a
    letter is that language with score 1.  An empty table gives an empty result.
    Two passes over the text (sample, prediction), no shuffle of it.
    """
    source = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), (fold(doc_id, 3) == 1).alias("held_out"),
        F.col(f"`{lang}`").cast("string").alias("__lang"), F.col(f"`{text}`").alias("__text"),
    ).withColumn("__letter", F.coalesce(F.col("__text").rlike(r"\p{L}"), F.lit(False)))
    known = source.filter("not held_out and __lang is not null and __letter").select("__lang", "__text")
    schema = "__lang string, at array<int>, value array<float>"

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, value = [], []
            for x in feature_blocks(batch.column(1)):
                for line in x:
                    where = np.flatnonzero(line)
                    at.append(where.astype(np.int32))
                    value.append(line[where])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(at, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))],
                names=["__lang", "at", "value"],
            )

    rows = _sample(known, per_language).mapInArrow(extract, schema).collect()
    names = sorted({r["__lang"] for r in rows})
    order = sorted(rows, key=lambda r: (r["__lang"], r["at"][:8], r["value"][:8]))
    x = np.zeros((len(rows), DIMS), np.float32)
    for i, r in enumerate(order):
        x[i, r["at"]] = r["value"]
    code = codewords(len(names))
    model = (*fit(x, np.array([names.index(r["__lang"]) for r in order]), code), code) if len(names) > 1 else None
    shared = docs.sparkSession.sparkContext.broadcast((names, model))
    schema_out = source.select("doc_id", "held_out").schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, model = shared.value
        for batch in batches:
            letter = np.asarray(batch.column(3).to_numpy(zero_copy_only=False), bool)
            n = len(letter)
            best, share, lead = np.zeros(n, int), np.ones(n), np.ones(n)
            if model:
                w, b, weight, code = model
                made = [decode(x @ w + b, code, weight) for x in feature_blocks(batch.column(2))]
                if made:
                    best, share, lead = (np.concatenate(v) for v in zip(*made, strict=True))
            known = letter & bool(names)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1),
                    pa.array([names[i] if k else "und" for i, k in zip(best, known, strict=True)], pa.string()),
                    pa.array(np.where(known, share, 0.0).astype(float)),
                    pa.array(known & (lead < ambiguous_below)),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"],
            )

    return source.select("doc_id", "held_out", "__text", "__letter").mapInArrow(predict, schema_out)
