"""Collocations: frequent phrases whose words meet more often than chance has it.

Phrases are counted by sorting suffixes.  Every word of a piece of text begins a
suffix of up to ``longest`` words; suffixes are dealt out by their leading words,
sorted by a three-way partition of one word at a time, and the suffixes of an
equal partition are the occurrences of the phrase that they share.  Partitions
with too few suffixes are given up: nothing frequent lies in them.

Leading words are settled one after the other over the whole corpus: first which
words are frequent, then which leading pairs, so that only suffixes of frequent
pairs are ever moved.  What tasks know of this is a bitmap of hashes; it may let
an infrequent pair through, never the other way, so no count depends on it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from veilspark.llm.words import buffers, lowered, mixed, row_blocks
from veilspark.sources.stage import staged

BLOCK_BYTES = 4_000_000
MOST_BITS = 1 << 27
BUCKET = 300_000
HOT = 250_000
_MAP_BITS = 32_768  # of one value of bitmap_construct_agg

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True


@dataclass
class Block:
    """Words of a block of texts: their text, hash, language, and the piece each lies in."""

    words: pa.Array
    hash: np.ndarray
    lang: np.ndarray
    piece: np.ndarray


def _hashed(words: pa.Array, seed: int) -> np.ndarray:
    """64-bit hashes (never 0) of the values of a string array."""
    data, at = buffers(words)
    rng = np.random.Generator(np.random.PCG64(seed))
    table = rng.integers(0, 2**64, 256, np.uint64)
    factor = int(rng.integers(0, 2**62)) * 2 + 1
    size = np.diff(at)
    h = np.zeros(len(size), np.uint64)
    order = np.argsort(-size, kind="stable")  # longest first: the words that still have a byte are a prefix
    start, size = at[:-1][order], size[order]
    for i in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -i, "left"))
        h[:n] = mixed(h[:n] * np.uint64(factor) + table[data[start[:n] + i]])
    out = np.empty_like(h)
    out[order] = mixed(h + size.astype(np.uint64))
    out[out == 0] = 1
    return out


def _blocks(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[Block]:
    """Blocks of about ``BLOCK_BYTES`` of (lang, text) rows, or of one row."""

    def whole(rows: list[pa.RecordBatch]) -> Iterator[Block]:
        both = pa.Table.from_batches(rows)
        lang = both.column(0).combine_chunks().dictionary_encode()
        names = _hashed(lang.dictionary, seed)
        data, at = buffers(both.column(1))
        for first, last in row_blocks(at, BLOCK_BYTES):
            yield _split(data[at[first] : at[last]], at[first : last + 1] - at[first],
                         names[np.asarray(lang.indices)[first:last]], seed)

    rows, size = [], 0
    for batch in batches:
        rows.append(batch)
        size += batch.nbytes
        if size >= BLOCK_BYTES:
            yield from whole(rows)
            rows, size = [], 0
    if rows:
        yield from whole(rows)


def _split(data: np.ndarray, at: np.ndarray, lang: np.ndarray, seed: int) -> Block:
    data = lowered(data)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_GAP[data]
    begin = inside[1:-1] & ~inside[:-2]
    edge = at[1:-1][at[1:-1] < len(data)]
    begin[edge] = inside[1:-1][edge]
    start = np.flatnonzero(begin)
    held = data[inside[1:-1]]
    upto = np.cumsum(inside[1:-1]) - inside[1:-1]
    words = pa.Array.from_buffers(
        pa.large_string(), len(start), [None, pa.py_buffer(np.append(upto[start], len(held))), pa.py_buffer(held)]
    ).dictionary_encode()
    code = np.asarray(words.indices, np.int64)
    row = np.searchsorted(at, start, "right") - 1
    breaks = np.cumsum(_BREAK[data])
    return Block(words, _hashed(words.dictionary, seed)[code], lang[row], breaks[start] + row)


# --- filters -----------------------------------------------------------------------


@dataclass
class Filter:
    """A bitmap of hashes: what was put in is found, other things now and then."""

    bits: np.ndarray

    def has(self, h: np.ndarray) -> np.ndarray:
        place = h & np.uint64(len(self.bits) * 8 - 1)
        return (self.bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _filter(hashes: DataFrame, most_bits: int = MOST_BITS) -> Filter:
    """Bitmap of the column ``h``: 64 bits a hash, ``most_bits`` at most (rounded to a power of two)."""
    n = hashes.count()
    bits = _MAP_BITS
    while bits < min(64 * n, most_bits):
        bits *= 2
    place = F.col("h").bitwiseAND(bits - 1)
    parts = (
        hashes.select(F.shiftright(place, 15).alias("part"), (place % _MAP_BITS).alias("place"))
        .groupBy("part").agg(F.bitmap_construct_agg("place").alias("map")).collect()
    )
    out = np.zeros(bits // 8, np.uint8)
    for r in parts:
        first = r["part"] * (_MAP_BITS // 8)
        out[first : first + _MAP_BITS // 8] = np.frombuffer(r["map"], np.uint8)
    return Filter(out)


def _unpacked(parts: pa.ChunkedArray, width: int) -> np.ndarray:
    raw = b"".join(parts.to_pylist())
    return np.frombuffer(raw, np.int64).reshape(-1, width)


def _dealt(bucket: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row a bucket, with its rows of the columns packed."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, int)
    rows = np.stack([c.view(np.int64)[order] for c in columns], 1)
    last = np.append(first, len(bucket))[1:]
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[first], pa.int64()), pa.array([rows[a:b].tobytes() for a, b in zip(first, last, strict=True)], pa.binary())],
        names=["bucket", "packed"],
    )


# --- sorting -----------------------------------------------------------------------


def equal_partitions(
    words: np.ndarray, weight: np.ndarray, least: int | np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of pointers to the rows of ``words`` (word 0 ends a row).

    Yields (depth, pointers, weights): for every equal partition of ``depth`` words
    whose weights sum to ``least`` or more, a pointer into it and that sum.  Each
    round splits every open partition by one word about a pivot into smaller, equal
    and larger; equal ones go on to the next word, and those that sum to less than
    ``least`` (one value, or one for each row) are given up.  Partitions of all
    sizes are split in the same few array operations, so no recursion is needed.
    """
    n, deep = words.shape
    least = np.broadcast_to(np.asarray(least, np.int64), (n,))
    pointer = np.arange(n)
    size = np.array([n] if n else [], np.int64)
    depth = np.zeros(len(size), np.int64)
    while len(size):
        first = np.cumsum(size) - size
        segment = np.repeat(np.arange(len(size)), size)
        key = words[pointer, depth[segment]]
        pivot = key[first + size // 2]
        side = (key >= pivot[segment]).astype(np.int64) + (key > pivot[segment])
        # Stable distribution of the pointers over the three sides of their partition.
        where = segment * 3 + side
        count = np.bincount(where, minlength=3 * len(size))
        place = np.cumsum(count) - count
        target = np.empty(len(pointer), np.int64)
        for s in range(3):
            mine = np.flatnonzero(side == s)
            seg = segment[mine]
            held = count[s::3]
            target[mine] = place[where[mine]] + np.arange(len(mine)) - (np.cumsum(held) - held)[seg]
        moved = np.empty_like(pointer)
        moved[target] = pointer
        pointer, size = moved, count
        depth = np.repeat(depth, 3)
        equal = np.tile([False, True, False], len(size) // 3)
        some = size > 0
        size, depth, equal = size[some], depth[some], equal[some]
        first = np.cumsum(size) - size
        held = np.add.reduceat(weight[pointer], first)
        depth = depth + equal
        ends = equal & (words[pointer[first], depth - 1] == 0)
        full = (held >= least[pointer[first]]) & ~ends
        for d in np.unique(depth[equal & full]):
            hit = equal & full & (depth == d)
            yield int(d), pointer[first[hit]], held[hit]
        keep = full & (depth < deep)
        pointer = pointer[np.repeat(keep, size)]
        size, depth = size[keep], depth[keep]


# --- passes over the corpus --------------------------------------------------------


def _word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, word, h, n): words with their hash and count, added up within blocks first."""

    def task(batches):
        for block in _blocks(batches, seed):
            code = np.asarray(block.words.indices, np.int64)
            names, lang = np.unique(block.lang, return_inverse=True)
            key, first, n = np.unique(lang * max(len(block.words.dictionary), 1) + code, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block.lang[first].view(np.int64)), block.words.dictionary.take(pa.array(code[first])).cast(pa.string()),
                 pa.array(block.hash[first].view(np.int64)), pa.array(n, pa.int64())],
                names=["lang_h", "word", "h", "n"],
            )

    rows = docs.mapInArrow(task, "lang_h long, word string, h long, n long")
    return rows.groupBy("lang_h", "word").agg(F.first("h").alias("h"), F.sum("n").alias("n"))


def _pair_hash(lang: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mixed(mixed(lang + a * np.uint64(0x9E3779B97F4A7C15)) + b)


def _pairs(block: Block, words: Filter) -> tuple[np.ndarray, np.ndarray]:
    """Places of words that begin a pair of frequent words of one piece, and the hash of the pair."""
    known = words.has(mixed(block.lang + block.hash))
    here = np.flatnonzero(known[:-1] & known[1:] & (block.piece[:-1] == block.piece[1:]))
    return here, _pair_hash(block.lang[here], block.hash[here], block.hash[here + 1])


def _pair_counts(docs: DataFrame, seed: int, words, buckets: int, least: int) -> DataFrame:
    """(h, n) of the pairs, by hash, that occur ``least`` times."""

    def deal(batches):
        for block in _blocks(batches, seed):
            h, n = np.unique(_pairs(block, words.value)[1], return_counts=True)
            yield _dealt((h >> np.uint64(20)).astype(np.int64) % buckets, [h, n])

    def merge(table):
        h, n = _unpacked(table.column("packed"), 2).T
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        n = np.add.reduceat(n, first)
        return pa.table({"h": h[first][n >= least], "n": n[n >= least]})

    return docs.mapInArrow(deal, "bucket long, packed binary").groupBy("bucket").applyInArrow(merge, "h long, n long")


def _suffixes(block: Block, words: Filter, pairs: Filter, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct suffixes of frequent pairs: language and up to ``longest`` words (0 after
    the end), how often each occurs in the block, and the hash of its leading pair."""
    here, h = _pairs(block, words)
    kept = pairs.has(h)
    here, h = here[kept], h[kept]
    goes = np.zeros(len(block.hash) + longest, bool)
    goes[here] = True
    rows = np.zeros((len(here), longest + 1), np.uint64)
    rows[:, 0], rows[:, 1] = block.lang[here], block.hash[here]
    on = np.ones(len(here), bool)
    for i in range(1, longest):
        on &= goes[here + i - 1]
        rows[on, i + 1] = block.hash[here[on] + i]
    order = np.lexsort(rows.T[::-1])
    rows, h = rows[order], h[order]
    new = np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)]) if len(rows) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return rows[first], np.diff(np.append(first, len(rows))), h[first]


def _phrase_counts(
    docs: DataFrame, seed: int, words, pairs, hot, buckets: int, hot_buckets: int, longest: int, least: int
) -> DataFrame:
    """(key, a): phrases of 2 to ``longest`` words; ``key`` is the hash of the language and of each word.

    Suffixes of a pair go to one bucket, where partitions are complete.  Those of a
    hot pair are spread by all their words; their partitions are added up afterwards.
    """

    def deal(batches):
        for block in _blocks(batches, seed):
            rows, n, h = _suffixes(block, words.value, pairs.value, longest)
            bucket = (h >> np.uint64(20)).astype(np.int64) % buckets
            crowd = hot.value.has(h)
            spread = np.zeros(int(crowd.sum()), np.uint64)
            for column in rows[crowd].T:
                spread = mixed(spread * np.uint64(0x9E3779B97F4A7C15) + column)
            bucket[crowd] = buckets + (spread >> np.uint64(20)).astype(np.int64) % hot_buckets
            yield _dealt(bucket, [*rows.T, n])

    def sort(key, table):
        part = key[0].as_py() >= buckets
        rows = _unpacked(table.column("packed"), longest + 2)
        suffix, weight = np.ascontiguousarray(rows[:, :-1]).view(np.uint64), rows[:, -1]
        keys, counts = [], []
        for depth, pointer, total in equal_partitions(suffix, weight, 1 if part else least):
            if depth > 2:
                raw = np.ascontiguousarray(suffix[pointer, :depth]).astype(">u8").tobytes()
                keys += [raw[i : i + 8 * depth] for i in range(0, len(raw), 8 * depth)]
                counts.append(total)
        return pa.table({
            "key": pa.array(keys, pa.binary()),
            "a": pa.array(np.concatenate([np.zeros(0, np.int64), *counts]), pa.int64()),
            "part": pa.array([part] * len(keys), pa.bool_()),
        })

    found = staged(
        docs.mapInArrow(deal, "bucket long, packed binary").groupBy("bucket").applyInArrow(sort, "key binary, a long, part boolean")
    )
    added = found.filter("part").groupBy("key").agg(F.sum("a").alias("a")).filter(F.col("a") >= least)
    return found.filter("not part").select("key", "a").unionByName(added)


class HashClash(Exception):
    """Two words or languages share a hash under every seed tried."""


def _clashes(words: DataFrame, names: DataFrame) -> bool:
    def any_of(df: DataFrame, h: str, text: str) -> bool:
        return not df.groupBy(h).agg(F.min(text).alias("x"), F.max(text).alias("y")).filter("x <> y").isEmpty()

    return any_of(words, "h", "word") or any_of(names, "lang_h", "lang")


def _key(*hashes: str) -> Column:
    """Eight big-endian bytes a hash."""
    return F.concat(*[F.unhex(F.lpad(F.hex(h), 16, "0")) for h in hashes])


def _part(key: Column, first: Column, count: Column) -> Column:
    """The language of a key with ``count`` of its words from ``first`` (0 is the first word) on."""
    return F.concat(F.substring(key, 1, 8), F.substring(key, first * 8 + 9, count * 8))


def _named_languages(docs: DataFrame, seed: int) -> DataFrame:
    def task(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_hashed(batch.column(0), seed).view(np.int64))], names=["lang", "lang_h"]
            )

    return docs.select("lang").distinct().mapInArrow(task, "lang string, lang_h long")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5, top: int = 2000,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of every language.

    A-Z are lower-cased, texts split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and these into
    words ``[^\\x20\\x09]+``.  ``n``: all words of the language; ``a``: occurrences of the
    phrase (2 to ``longest`` words, ``least`` times or more) within pieces, overlaps
    included.  Cut after its first words, ``l`` and ``r`` are the occurrences of both
    parts and the score is floor(1000 a n / (l r)) in whole numbers of 38 digits; the
    cut of the lowest score counts, the shortest first part among equals.  Phrases
    that lie in a longer one of as many occurrences go.  Order: score and ``a``
    descending, then the phrase by its UTF-8 bytes.

    Null texts are empty, null languages ``und``, an empty table gives no rows.
    Repeated rows count each; ties are settled by the phrase.  Other columns are not
    read, whatever their names.  Texts are handled in blocks of ``BLOCK_BYTES``, so
    memory follows the block or the longest text.

    Words travel as 64-bit hashes; that no two words share one is checked on the table
    of all words, and other hashes are drawn if they do.  Counts are added up within a
    block before they move, and a pair of more than ``HOT`` occurrences is spread over
    tasks by all words of its suffixes, so no word or passage fills a task.
    """
    spark = docs.sparkSession
    docs = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    for seed in range(1, 9):
        names = staged(_named_languages(docs, seed))
        counted = staged(_word_counts(docs, seed))
        if not _clashes(counted, names):
            break
    else:
        raise HashClash("no seed gives every word its own hash")
    few = names.count() <= 100_000
    found = staged(_phrases(spark, docs, counted, seed, least, longest))
    return _ranked(found, counted, names, few, least, longest, top)


def _phrases(spark: SparkSession, docs, counted, seed, least, longest) -> DataFrame:
    """(key, a) of all candidates."""
    sc = spark.sparkContext
    frequent = counted.filter(F.col("n") >= least).select("lang_h", "h")
    size = counted.agg(F.sum("n")).first()[0] or 0

    def together(batches):
        for batch in batches:
            a, b = (np.asarray(c, np.int64).view(np.uint64) for c in batch.columns)
            yield pa.RecordBatch.from_arrays([pa.array(mixed(a + b).view(np.int64))], names=["h"])

    words = sc.broadcast(_filter(frequent.mapInArrow(together, "h long")))
    pairs = staged(_pair_counts(docs, seed, words, max(1, size // 1_000_000), least))
    hot = F.col("n") > HOT
    sums = pairs.agg(F.sum(F.when(~hot, F.col("n"))), F.sum(F.when(hot, F.col("n")))).first()
    buckets, hot_buckets = (max(1, -(-(s or 0) // BUCKET)) for s in sums)
    return _phrase_counts(
        docs, seed, words, sc.broadcast(_filter(pairs.select("h"))), sc.broadcast(_filter(pairs.filter(hot).select("h"))),
        buckets, hot_buckets, longest, least,
    )


def _ranked(found, counted, names, few, least, longest, top) -> DataFrame:
    key, length = F.col("key"), F.expr("cast(length(key) div 8 - 1 as int)")
    words = counted.filter(F.col("n") >= least).select(_key("lang_h", "h").alias("key"), F.col("n").alias("f"), "word")
    every = words.select("key", "f").unionByName(found.withColumnRenamed("a", "f"))

    # Phrases inside a longer one of the same count: one word longer is enough, as counts never grow with length.
    longer = found.filter(length > 2).select(
        F.explode(F.array(_part(key, F.lit(0), length - 1), _part(key, F.lit(1), length - 1))).alias("key"), "a"
    ).groupBy("key").agg(F.max("a").alias("most"))
    kept = found.join(longer, "key", "left").filter(F.col("most").isNull() | (F.col("most") < F.col("a"))).select("key", "a")

    cut = kept.select("key", "a", F.explode(F.sequence(F.lit(1), length - 1)).alias("k"), length.alias("m"))
    cut = cut.select(
        "key", "a", "k", _part(key, F.lit(0), F.col("k")).alias("lk"), _part(key, F.col("k"), F.col("m") - F.col("k")).alias("rk")
    )
    cut = cut.join(every.toDF("lk", "l"), "lk").join(every.toDF("rk", "r"), "rk")
    totals = counted.groupBy("lang_h").agg(F.sum("n").alias("n")).join(names, "lang_h")
    totals = totals.select(_key("lang_h").alias("lk"), "lang", "n")
    cut = cut.withColumn("lk", F.substring("key", 1, 8)).join(F.broadcast(totals) if few else totals, "lk")
    cut = cut.withColumn("score", F.expr(
        "(cast(a as decimal(19,0)) * cast(n as decimal(19,0)) * 1000BD) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    ))
    best = cut.groupBy("key", "a", "n", "lang").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))

    spelt = kept.select("key", F.posexplode(F.transform(
        F.sequence(F.lit(0), length - 1), lambda i: _part(key, i, F.lit(1)))).alias("i", "wk"))
    spelt = spelt.join(words.select(F.col("key").alias("wk"), "word"), "wk").groupBy("key").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase")
    )
    rows = best.join(spelt, "key").select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")

    # The top of a share of a language first, so that no task gets all phrases of one.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = (F.xxhash64("phrase") % 32).alias("share")
    rows = rows.select("*", share).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order)))
    rows = rows.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return rows.filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )

