"""Exact Jaccard join on word n-grams, with filters under several global orders.

Sets are the distinct word shingles of a text.  Under any total order of all
tokens, two sets of similarity ``t`` or more share a token among their first
``n - ceil(t n) + 1``.  Several orders are used: all begin with a class of the
token's corpus frequency (from a sketch of fixed size, counted over all texts),
so common passages come last; within a class each order has its own hash.

1. Texts with equal sets are one class; only classes are compared.
2. Classes meet in the buckets of their prefix tokens under the first order.
3. Pairs must also share prefix tokens under the further orders (bitmaps of the
   prefixes) and pass a bound on the overlap (counts of tokens in hash cells).
4. What is left is verified on the whole sets.

Buckets with more than ``wide`` classes (large groups of near copies) are not
paired up: classes that meet in such buckets form a group that is cut into
tiles, every two tiles are compared on whole sets in one task, and only a
spanning forest of their links comes out.  Both ways are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from veilspark.llm.components import connected
from veilspark.llm.frames import kept_names
from veilspark.llm.words import buffers, lowered, mixed, row_blocks, signed, split_words, window_hashes
from veilspark.sources.stage import drop_unread, live_stages, staged

ORDERS = 3
SKETCH_BITS = 22
SKETCH_PART = 1 << 16
CELLS = 64
MAP_BITS = 512
WIDE = 100
TILE = 256
BROADCAST_ROWS = 1_000_000
_salts = mixed(np.arange(1, ORDERS + 1, dtype=np.uint64))


def text_shingles(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct shingle hashes) of every row with a word, in row order.

    A-Z are lower-cased; with fewer words than ``width`` the whole sequence is
    the one shingle."""
    data, at = buffers(column)
    for first, last in row_blocks(at):
        words = split_words(lowered(data[at[first] : at[last]]), at[first : last + 1] - at[first])
        grams = window_hashes(words.hash, width)
        for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
            if b - a >= width:
                yield first + i, np.unique(grams[a : b - width + 1])
            elif b > a:
                yield first + i, window_hashes(words.hash[a:b], b - a) ^ np.uint64(b - a)


def _sketch(width: int):
    """Counts of shingles by hash slot, of one task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << SKETCH_BITS
        total = np.zeros(size, np.int32)
        for batch in batches:
            data, at = buffers(batch.column(0))
            for first, last in row_blocks(at):
                words = split_words(lowered(data[at[first] : at[last]]), at[first : last + 1] - at[first])
                grams = window_hashes(words.hash, width)
                total += np.bincount((grams & np.uint64(size - 1)).astype(np.int64), minlength=size).astype(np.int32)
        low = np.minimum(total, 255).astype(np.uint8)
        parts = [p for p in range(0, size, SKETCH_PART) if low[p : p + SKETCH_PART].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p // SKETCH_PART for p in parts], pa.int32()),
             pa.array([low[p : p + SKETCH_PART].tobytes() for p in parts], pa.binary())],
            names=["part", "counts"],
        )

    return task


def _add_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            here = sums.setdefault(part, np.zeros(SKETCH_PART, np.int64))
            here += np.frombuffer(raw, np.uint8)
    classes = [np.ceil(np.log2(v + 1)).astype(np.uint8).tobytes() for v in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(classes, pa.binary())], names=["part", "counts"])


def frequency_classes(texts: DataFrame, width: int) -> np.ndarray:
    """Class (power of two) of the corpus frequency of each hash slot.  Its size is
    fixed by ``SKETCH_BITS``, whatever the input; it orders tokens and decides
    nothing about links."""
    rows = (
        texts.select("text").mapInArrow(_sketch(width), "part int, counts binary")
        .repartition(1 << (SKETCH_BITS - 16), "part").mapInArrow(_add_sketches, "part int, counts binary").collect()
    )
    out = np.zeros(1 << SKETCH_BITS, np.uint8)
    for r in rows:
        out[r["part"] * SKETCH_PART : (r["part"] + 1) * SKETCH_PART] = np.frombuffer(r["counts"], np.uint8)
    return out


def prefix(tokens: np.ndarray, classes: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The first tokens of a set under one global order, as many as can decide."""
    n = len(tokens)
    p = n - -(-percent * n // 100) + 1
    if p >= n:
        return tokens
    rank = classes[(tokens & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)
    rank |= mixed(tokens ^ _salts[order]) >> np.uint64(8)
    return tokens[np.argpartition(rank, p - 1)[:p]]


def _bitmap(tokens: np.ndarray) -> bytes:
    bits = np.zeros(MAP_BITS, bool)
    bits[((tokens >> np.uint64(40)) % np.uint64(MAP_BITS)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _describe(width: int, percent: int, shared, n_kept: int):
    """Per row: set size, fingerprint, prefix tokens of the first order, filters."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared.value
        for batch in batches:
            n = len(batch)
            size, mark, tokens = np.zeros(n, np.int64), [None] * n, [None] * n
            maps, cells = [None] * n, [None] * n
            for row, s in text_shingles(batch.column(n_kept), width):
                size[row] = len(s)
                mark[row] = _mark(s)
                tokens[row] = signed(prefix(s, classes, 0, percent))
                maps[row] = b"".join(_bitmap(prefix(s, classes, k, percent)) for k in range(1, ORDERS))
                cells[row] = np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=CELLS).astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:n_kept], pa.array(size), pa.array(mark, pa.binary()),
                    pa.array(tokens, pa.list_(pa.int64())), pa.array(maps, pa.binary()), pa.array(cells, pa.binary()),
                ],
                names=[*batch.schema.names[:n_kept], "n", "mark", "tokens", "maps", "cells"],
            )

    return task


def _pairs(percent: int):
    """Rows sorted by token: pairs of a bucket whose sizes allow a link."""

    def of(marks: list[bytes], sizes: np.ndarray) -> tuple[list[bytes], list[bytes]]:
        order = np.argsort(sizes, kind="stable")
        a, b = [], []
        for x in range(len(order)):
            for y in range(x + 1, len(order)):
                i, j = order[x], order[y]
                if 100 * sizes[i] < percent * sizes[j]:
                    break
                low, high = sorted((marks[i], marks[j]))
                a.append(low)
                b.append(high)
        return a, b

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, marks, sizes = None, [], []
        for batch in batches:
            out_a, out_b = [], []
            for key, mark, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if key != held_key:
                    if len(marks) > 1:
                        a, b = of(marks, np.array(sizes))
                        out_a += a
                        out_b += b
                    held_key, marks, sizes = key, [], []
                marks.append(mark)
                sizes.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], names=["a", "b"])
        a, b = of(marks, np.array(sizes)) if len(marks) > 1 else ([], [])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return task


def _intersect_filters(percent: int):
    """Pairs that pass the prefixes of all further orders and the overlap bound."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = MAP_BITS // 8
        for batch in batches:
            if not len(batch):
                continue
            na, nb = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            maps = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(len(batch), ORDERS - 1, one) for c in (3, 6)]
            cells = [np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(len(batch), CELLS) for c in (4, 7)]
            most = np.minimum(*cells).sum(1)
            ok = (maps[0] & maps[1]).any(2).all(1) & (100 * most >= percent * (na + nb - most))
            at = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])

    return task


def _mark(s: np.ndarray) -> bytes:
    """Fingerprint (128 bits) of a set of hashes."""
    return np.add.reduce(mixed(s)).tobytes() + np.add.reduce(mixed(s ^ _salts[0])).tobytes()


def _sets(width: int):
    """Sets of the rows whose fingerprint is the wanted one."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(0).to_pylist()
            found = [(wanted[row], signed(s)) for row, s in text_shingles(batch.column(1), width) if _mark(s) == wanted[row]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([m for m, _ in found], pa.binary()), pa.array([s for _, s in found], pa.list_(pa.int64()))],
                names=["mark", "tokens"],
            )

    return task


def _tile_links(percent: int):
    """Links between the sets of two tiles (or within one), as a spanning forest."""

    def task(table: pa.Table) -> pa.Table:
        marks, side = table.column("mark").to_pylist(), np.array(table.column("side").to_pylist())
        same = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        column = table.column("tokens").combine_chunks()
        sizes = np.diff(column.offsets.to_numpy())
        flat = column.flatten().to_numpy()
        _, where, n = np.unique(flat, return_inverse=True, return_counts=True)
        useful = n[where] > 1
        dense = np.cumsum(n > 1) - 1
        col, row = dense[where[useful]], np.repeat(np.arange(len(marks)), sizes)[useful]
        left = np.arange(len(marks)) if same else np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        both = np.zeros((len(left), len(right)), np.float32)
        place = np.zeros((2, len(marks)), np.int64)
        place[0, left], place[1, right] = np.arange(len(left)), np.arange(len(right))
        order = np.argsort(col, kind="stable")
        col, row = col[order], row[order]
        step = 16384
        for start in range(0, int(col[-1]) + 1 if len(col) else 0, step):
            a, b = np.searchsorted(col, [start, start + step])
            c, r = col[a:b] - start, row[a:b]
            x = np.zeros((len(left), step), np.float32)
            ours = np.ones(len(r), bool) if same else side[r] == 0
            x[place[0, r[ours]], c[ours]] = 1
            if same:
                y = x
            else:
                y = np.zeros((len(right), step), np.float32)
                y[place[1, r[~ours]], c[~ours]] = 1
            both += x @ y.T
        both = both.astype(np.int64)
        union = sizes[left][:, None] + sizes[right][None, :] - both
        i, j = np.nonzero(100 * both >= percent * union)
        root = list(range(len(marks)))

        def find(k):
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        a, b = [], []
        for k, m in zip(left[i].tolist(), right[j].tolist(), strict=True):
            x, y = find(k), find(m)
            if x != y:
                root[max(x, y)] = min(x, y)
                a.append(marks[k])
                b.append(marks[m])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return task


def _wide_links(wide: DataFrame, sets, percent: int) -> DataFrame:
    """Links within groups of classes that meet in wide buckets."""
    head = wide.groupBy("token").agg(F.min("mark").alias("head"))
    groups = staged(connected(wide.join(head, "token").select(F.col("mark").alias("a"), F.col("head").alias("b"))))
    counts = groups.groupBy("root").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    placed = groups.join(counts, "root").select(
        F.col("node").alias("mark"), "root", "tiles", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int").alias("tile")
    )
    dealt = sets(placed.select("mark")).join(placed, "mark").select(
        "mark", "root", "tokens", "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    ).select(
        "mark", "root", "tokens", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
        F.when(F.col("tile") <= F.col("other"), 0).otherwise(1).alias("side"),
    )
    return dealt.groupBy("root", "i", "j").applyInArrow(_tile_links(percent), "a binary, b binary")


def _components(
    docs: DataFrame, doc_id: str, text: str, width: int, percent: int, keep: list[str], names: list[str], wide: int,
    tidy: bool = False,
) -> DataFrame:
    """Kept columns with ``n``, ``__doc``, ``__rid`` and ``best``: the first row
    (null ids last) of the component, null for texts without a shingle.  With ``tidy``
    the tables that led to the links are dropped once the components are known."""
    spark = docs.sparkSession
    before = live_stages()
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
        F.col(f"`{doc_id}`").alias("__doc"), F.xxhash64(F.col(f"`{text}`")).alias("__hash"),
        F.monotonically_increasing_id().alias("__rid"), F.col(f"`{text}`").alias("__text"),
    )
    texts = rows.select(F.col("__doc").alias("doc"), F.col("__hash").alias("hash"), F.col("__text").alias("text"))
    shared = spark.sparkContext.broadcast(frequency_classes(texts, width))
    schema = T.StructType([
        *rows.drop("__text").schema.fields, T.StructField("n", T.LongType()), T.StructField("mark", T.BinaryType()),
        T.StructField("tokens", T.ArrayType(T.LongType())), T.StructField("maps", T.BinaryType()), T.StructField("cells", T.BinaryType()),
    ])
    described = staged(rows.mapInArrow(_describe(width, percent, shared, len(keep) + 3), schema))
    whole = described.filter("mark is not null")
    classes = staged(whole.groupBy("mark").agg(
        F.min(F.struct(F.col("__doc").isNull().alias("no_id"), F.col("__doc").alias("doc"), F.col("__rid").alias("rid"))).alias("best"),
        F.min(F.struct(F.col("__hash").alias("hash"), F.col("__doc").alias("doc"))).alias("at"),
        F.first("n").alias("n"), F.first("maps").alias("maps"), F.first("cells").alias("cells"),
    ))
    member = whole.select(F.explode("tokens").alias("token"), "mark", "n").distinct()
    size = member.groupBy("token").agg(F.count("*").alias("m")).filter("m > 1")
    met = staged(member.join(size, "token").select("token", "mark", "n", "m"))
    narrow = (
        met.filter(F.col("m") <= wide).select("token", "mark", "n")
        .repartition("token").sortWithinPartitions("token").mapInArrow(_pairs(percent), "a binary, b binary").distinct()
    )

    def half(c: str) -> DataFrame:
        return classes.select(F.col("mark").alias(c), F.col("n").alias(f"n{c}"), F.col("maps").alias(f"maps{c}"), F.col("cells").alias(f"cells{c}"))

    pairs = staged(
        narrow.join(half("a"), "a").join(half("b"), "b")
        .select("a", "b", "na", "mapsa", "cellsa", "nb", "mapsb", "cellsb")
        .mapInArrow(_intersect_filters(percent), "a binary, b binary")
    )

    def sets(marks: DataFrame) -> DataFrame:
        """Whole sets of some classes, each read from the text of one of its rows."""
        wanted = staged(marks.distinct().join(classes.select("mark", "at.hash", F.col("at.doc").alias("first")), "mark"))
        small = wanted.count() <= BROADCAST_ROWS
        right = F.broadcast(wanted) if small else wanted
        found = texts.join(right, (texts["hash"] == wanted["hash"]) & texts["doc"].eqNullSafe(wanted["first"]))
        return found.select("mark", "text").mapInArrow(_sets(width), "mark binary, tokens array<bigint>").dropDuplicates(["mark"])

    chosen = staged(sets(pairs.select(F.col("a").alias("mark")).union(pairs.select("b"))))
    left = chosen.select(F.col("mark").alias("a"), F.col("tokens").alias("ta"))
    right = chosen.select(F.col("mark").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    links = (
        pairs.join(left, "a").join(right, "b").withColumn("both", both)
        .filter(100 * F.col("both") >= percent * (F.size("ta") + F.size("tb") - F.col("both"))).select("a", "b")
    )
    broad = met.filter(F.col("m") > wide)
    if broad.take(1):
        links = links.union(_wide_links(broad, sets, percent))
    roots = connected(links)
    if tidy:
        drop_unread(live_stages() - before, docs, described, classes, roots)
    named = classes.select("mark", "best").join(roots, classes["mark"] == roots["node"], "left").select(
        "mark", "best", F.coalesce("root", "mark").alias("root")
    )
    best = named.groupBy("root").agg(F.min("best").alias("best"))
    labels = named.select("mark", "root").join(best, "root").select("mark", "best")
    return described.join(labels, "mark", "left").select(
        *[F.col(f"k{i}").alias(n) for i, n in enumerate(names)], "n", "__doc", "__rid", "best"
    )


def jaccard_components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 3,
    percent: int = 90,
    keep: list[str] | None = None,
    wide: int = WIDE,
) -> DataFrame:
    """Columns ``keep`` (all by default) with ``n_shingles`` (set size) and
    ``component_id``: the smallest id reachable by links, itself included.

    Two rows link when ``100 * intersection >= percent * union`` of their sets
    of distinct ``width``-word shingles (A-Z lower-cased; words are runs of
    bytes outside ``[\\x20\\x09-\\x0D]``).  With fewer words the whole sequence is
    the one shingle.  A null, empty or wordless text has no shingles and links
    with nothing: its component is its own id.  Rows with equal sets are linked.
    A null id takes part like any other row and names a component only if no
    row of it has an id.  Kept columns called like a result get
    underscores in front until they differ.  An empty table gives an empty result.
    """
    keep = docs.columns if keep is None else keep
    names = kept_names(keep, ("n_shingles", "component_id", "n", "best", "__doc", "__rid"))
    found = _components(docs, doc_id, text, width, percent, keep, names, wide)
    return found.select(
        *[f"`{n}`" for n in names], F.col("n").alias("n_shingles"),
        F.when(F.col("best").isNull(), F.col("__doc")).otherwise(F.col("best.doc")).alias("component_id"),
    )


def one_per_component(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, percent: int = 90, wide: int = WIDE) -> DataFrame:
    """The rows of ``docs`` that stay when every component of linked rows keeps
    its row of smallest id (of several such rows, one).  Rows without a shingle
    all stay.  Cases as in ``jaccard_components``; columns unchanged."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    found = _components(docs, doc_id, text, width, percent, docs.columns, names, wide, tidy=True)
    kept = found.filter("best is null or best.rid = __rid")
    return kept.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])
