"""Exact top-k search by inner product: the threshold algorithm over sorted lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from veilspark.sources.stage import staged

BLOCK_ROWS = 8_192
FIRST_DEPTH = 32
_LONG = (-(2**63), 2**63 - 1)


class SortedLists:
    """Vectors of a block with one list a dimension, sorted by the component."""

    def __init__(self, rid: np.ndarray, ids: np.ndarray, values: np.ndarray):
        order = np.lexsort((rid, ids))
        self.rid, self.ids, self.values = rid[order], ids[order], values[order]
        self.order = np.argsort(self.values, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.values, self.order, axis=0)
        self.most = int(max(-int(values.min()), int(values.max()))) if values.size else 0
        self.real = self.values.astype(np.float64)

    def scores(self, rows: np.ndarray, query: np.ndarray, size: int) -> np.ndarray:
        """Exact inner products: in doubles while these hold every sum, then in 64 bits, then
        in whole numbers of any length, held to the range of 64 bits."""
        if size < 2**53:
            return (self.real[rows] @ query.astype(np.float64)).astype(np.int64)
        if size < 2**63:
            return self.values[rows] @ query
        exact = self.values[rows].astype(object) @ query.astype(object)
        return np.array([min(max(x, _LONG[0]), _LONG[1]) for x in exact], np.int64)

    def best(self, rid: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows and scores of the ``k`` best for a query (its own row left out, ties to the
        smaller id) and how deep the lists were read.

        All lists are read from the end that helps the query.  What they show is scored in
        full; what they have not shown scores at most the product of the query with the
        values last read.  Once the kth best score beats this bound, nothing unseen can enter.
        """
        n, d = self.values.shape
        query = np.concatenate([query[:d], np.zeros(max(0, d - len(query)), np.int64)])
        size = self.most * sum(map(abs, query.tolist()))
        used = np.flatnonzero(query)
        up = query[used] > 0
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        seen = np.zeros(n, bool)
        depth, last = 0, FIRST_DEPTH
        while depth < n:
            last = min(last, n) if len(used) else n
            fresh = np.zeros(n, bool)
            if last == n:
                fresh[:] = True
            else:
                fresh[self.order[n - last : n - depth, used[up]]] = True
                fresh[self.order[depth:last, used[~up]]] = True
            fresh &= ~seen
            seen |= fresh
            new = np.flatnonzero(fresh & (self.rid != rid))
            rows, scores = np.append(rows, new), np.append(scores, self.scores(new, query, size))
            if len(rows) > k:
                # Rows stand in order of their ids, so the row settles ties.
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                near = scores >= kth
                rows, scores = rows[near], scores[near]
                top = np.lexsort((rows, _down(scores)))[:k]
                rows, scores = rows[top], scores[top]
            depth, last = last, last * 2
            if depth < n and len(rows) >= k:
                edge = np.where(up, self.sorted[n - depth, used], self.sorted[depth - 1, used])
                bound = sum(x * y for x, y in zip(edge.tolist(), query[used].tolist(), strict=True))
                if int(scores.min()) > bound:
                    break
        top = np.lexsort((rows, _down(scores)))
        return rows[top], scores[top], depth


def _down(scores: np.ndarray) -> np.ndarray:
    """Keys that sort scores from the highest; the complement never overflows."""
    return ~scores


def whole_numbers(vector: Column, scale: float = 1024.0) -> Column:
    """``floor(scale * x)`` of every component, or null where the vector takes no part."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf")))
    )
    return F.when(~bad, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


def top_k(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10,
    scale: float = 1024.0, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` vectors of highest inner product
    for every vector whose id is divisible by ``every``, against all other rows.

    Components become ``floor(scale * x)`` (a long; held to its range), scores are exact;
    scores past 64 bits are held to their range.  Ties go to the smaller id.  Vectors that
    are null or hold null or non-finite components, and rows without an id, take no part;
    an empty vector scores 0 with all, and components that the shorter of two vectors
    lacks count as 0.  Every row with an id divisible by ``every`` is a query of its own
    and meets every other row, rows of the same id too.  An empty table gives no rows;
    other columns are not read, whatever their names.

    Rows are dealt into blocks of about ``block_rows``; each block sorts its lists once
    and the queries pass by as a stream, so memory holds one block however many queries
    there are.  What a task found for a query is cut to ``k`` before it is moved.
    """
    number = whole_numbers(F.col(f"`{vector}`"), scale)
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), number.alias("v"))
    rows = staged(rows.filter("vec_id is not null and v is not null").withColumn("rid", F.monotonically_increasing_id()))
    blocks = max(1, -(-rows.count() // block_rows))
    own = F.pmod(F.xxhash64("rid"), F.lit(blocks)).cast("int")
    asked = rows.filter(F.col("vec_id") % every == 0).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    both = rows.select(own.alias("block"), F.lit(0).alias("asks"), "rid", "vec_id", "v").unionByName(
        asked.select("block", F.lit(1).alias("asks"), "rid", "vec_id", "v")
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rid, ids, held, lists = None, [], [], [], None
        for batch in batches:
            found: list[list] = [[], [], [], [], []]
            columns = [batch.column(i).to_pylist() for i in range(4)]
            flat = batch.column(4)
            at = np.asarray(flat.offsets)
            values = np.asarray(flat.values, np.int64)
            for i, (b, asks, r, x) in enumerate(zip(*columns, strict=True)):
                v = values[at[i] : at[i + 1]]
                if b != block:
                    block, rid, ids, held, lists = b, [], [], [], None
                if not asks:
                    rid.append(r)
                    ids.append(x)
                    held.append(v.copy())
                    continue
                if not held:
                    continue
                if lists is None:
                    grid = np.zeros((len(held), max(map(len, held))), np.int64)
                    for row, y in zip(grid, held, strict=True):
                        row[: len(y)] = y
                    lists = SortedLists(np.array(rid, np.int64), np.array(ids, np.int64), grid)
                near, scores, _ = lists.best(r, v, k)
                for column, part in zip(
                    found, ([r] * len(near), [x] * len(near), lists.ids[near], lists.rid[near], scores), strict=True
                ):
                    column.extend(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in found], names=["asked", "query_id", "vec_id", "rid", "score"]
            )

    near = both.repartition("block").sortWithinPartitions("block", "asks").mapInArrow(
        task, "asked long, query_id long, vec_id long, rid long, score long"
    )
    best = Window.partitionBy("asked").orderBy(F.desc("score"), "vec_id", "rid")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
