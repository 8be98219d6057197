"""Substring dedup: words inside passages that appear more than once anywhere.

A window is ``window`` consecutive words of one text.  Each window is tied to
its anchor, the 8-word phrase of minimum hash inside it, so equal windows have
equal anchors.

1. *Confirm phrases*: anchors are counted over the whole corpus; a window can
   only recur if its anchor does.
2. *Locate*: texts are dealt to shards by a hash.  Each shard compiles the
   recurring anchors of its texts into one Aho-Corasick automaton over word
   codes and streams the texts through it; the matches mark candidate windows.
   A shard holds the phrases of its own texts only, so work and memory follow
   the input, not phrases times texts.
3. *Confirm passages*: candidate windows are compared by 64-bit hash among all
   windows with the same anchor.  Windows of an anchor with more than ``hot``
   occurrences are spread by their own hash and counted with partial
   aggregation instead; both ways are exact.
4. Words covered by a recurring window are removed from each text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from veilspark.llm.frames import fresh, kept_names
from veilspark.llm.words import (
    Words, buffers, mixed, row_blocks, signed, split_words, window_hashes,
)

PHRASE = 8
RUN = 31
_TOP = np.uint64(2**64 - 1)


def slide(x: np.ndarray, width: int, take) -> np.ndarray:
    """Minimum or maximum of every ``width`` consecutive values."""
    step = 1
    while step * 2 <= width:
        x = take(x[: len(x) - step], x[step:])
        step *= 2
    if step < width:
        x = take(x[: len(x) - (width - step)], x[width - step :])
    return x


class Anchors:
    """Phrases and windows of a block of rows."""

    def __init__(self, words: Words, window: int):
        self.words, self.span = words, window - PHRASE + 1
        n = len(words.hash)
        self.codes = (words.hash % np.uint64(255) + np.uint64(1)).astype(np.uint8)
        self.windows = max(0, n - window + 1)
        if not self.windows:
            return
        key = self.codes.astype(np.uint64)
        for step in (1, 2, 4):
            key = key[:-step] | (key[step:] << np.uint64(8 * step))
        self.key, self.rank = key, mixed(key)
        row = words.row
        self.row = row[: self.windows]
        self.inside = self.row == row[window - 1 :]
        self.least = slide(self.rank, self.span, np.minimum)

    def chosen(self) -> np.ndarray:
        """Positions of the phrases that are the anchor of some window."""
        least = np.where(self.inside, self.least, np.uint64(0))
        edge = np.zeros(self.span - 1, np.uint64)
        return np.flatnonzero(slide(np.concatenate([edge, least, edge]), self.span, np.maximum) == self.rank)


def _anchor_blocks(column: pa.Array, window: int) -> Iterator[tuple[int, Anchors]]:
    data, at = buffers(column)
    for first, last in row_blocks(at):
        words = split_words(data[at[first] : at[last]], at[first : last + 1] - at[first])
        yield first, Anchors(words, window)


def _count_phrases(window: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = batch.column(0).to_numpy()
            for first, a in _anchor_blocks(batch.column(1), window):
                if not a.windows:
                    continue
                at = a.chosen()
                part = shard[first + a.words.row[at]]
                both = mixed(a.key[at] + mixed(part.astype(np.uint64)))
                _, where, n = np.unique(both, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(a.key[at][where])), pa.array(part[where], pa.int32()), pa.array(n, pa.int64())],
                    names=["key", "shard", "n"],
                )

    return task


def _locate(window: int, want_hot: bool):
    """Rows sorted by shard, its phrases first: compile, then stream the texts."""
    import ahocorasick

    def compiled(keys: list[int]):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        text = np.array(keys, np.int64).tobytes().decode("latin-1")
        for i in range(0, len(text), PHRASE):
            automaton.add_word(text[i : i + PHRASE])
        if keys:
            automaton.make_automaton()
        return automaton

    def located(automaton, a: Anchors) -> np.ndarray:
        """Phrase positions of the block that the automaton finds."""
        text, mark = a.codes.tobytes().decode("latin-1"), np.zeros(len(a.key), bool)
        for start, end in zip(a.words.first[:-1], a.words.first[1:], strict=True):
            if end - start >= window:
                ends = np.fromiter((e for e, _ in automaton.iter(text, int(start), int(end))), np.int64)
                mark[ends - PHRASE + 1] = True
        return mark

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, keys, hot, automaton = None, [], [], None
        for batch in batches:
            shards = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if hi == lo:
                    continue
                if shards[lo] != now:
                    now, keys, hot, automaton = shards[lo], [], [], None
                part = batch.slice(lo, hi - lo)
                split = int((part.column(1).to_numpy() == 0).sum())
                keys += part.column(2).slice(0, split).to_pylist()
                hot += part.column(3).slice(0, split).to_pylist()
                if split == len(part) or not keys:
                    continue
                if automaton is None:
                    automaton = compiled(keys)
                    hot_ranks = np.sort(mixed(np.array(keys, np.int64).view(np.uint64)[np.array(hot, bool)]))
                docs = part.slice(split)
                k1, k2 = docs.column(2).to_numpy(zero_copy_only=False), docs.column(4).to_numpy(zero_copy_only=False)
                for first, a in _anchor_blocks(docs.column(5), window):
                    if not a.windows:
                        continue
                    seen = np.where(located(automaton, a), a.rank, _TOP)
                    found = np.flatnonzero(a.inside & (slide(seen, a.span, np.minimum) == a.least))
                    if not len(found):
                        continue
                    heat = np.isin(a.least[found], hot_ranks)
                    found = found[heat == want_hot]
                    if len(found):
                        yield _pieces(a, found, window, k1[first:], k2[first:], want_hot)

    return task


def _pieces(a: Anchors, found: np.ndarray, window: int, k1, k2, single: bool) -> pa.RecordBatch:
    """Candidate windows as rows: runs with one anchor (up to ``RUN``), or one by one."""
    hashes = window_hashes(a.words.hash, window)[found]
    row = a.row[found]
    start = found - a.words.first[row]
    if single:
        return pa.RecordBatch.from_arrays(
            [pa.array(signed(hashes)), pa.array(k1[row]), pa.array(k2[row], pa.int32()), pa.array(start, pa.int32())],
            names=["key", "k1", "k2", "at"],
        )
    new = np.ones(len(found), bool)
    new[1:] = (np.diff(found) != 1) | (row[1:] != row[:-1]) | (a.least[found][1:] != a.least[found][:-1])
    heads = np.flatnonzero(new)
    offset = np.arange(len(found)) - np.repeat(heads, np.diff(np.append(heads, len(found))))
    heads = np.flatnonzero(offset % RUN == 0)
    sizes = np.diff(np.append(heads, len(found)))
    raw = pa.Array.from_buffers(
        pa.binary(), len(heads),
        [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes * 8)]).astype(np.int32)), pa.py_buffer(hashes.tobytes())],
    )
    return pa.RecordBatch.from_arrays(
        [
            pa.array(signed(a.least[found][heads])), pa.array(k1[row[heads]]), pa.array(k2[row[heads]], pa.int32()),
            pa.array(start[heads], pa.int32()), raw,
        ],
        names=["key", "k1", "k2", "at", "hashes"],
    )


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor: mark the windows whose hash comes up more than once.
    Holds one batch and the rows of one anchor."""

    def marked(table: pa.Table) -> pa.RecordBatch | None:
        column = table.column("hashes").combine_chunks()
        sizes = np.asarray(pc.binary_length(column)) // 8
        hashes = np.frombuffer(b"".join(column.to_pylist()), np.uint64)
        _, inverse, n = np.unique(hashes, return_inverse=True, return_counts=True)
        heads = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        bit = np.arange(len(hashes)) - np.repeat(heads, sizes)
        mask = np.add.reduceat((n[inverse] > 1) * (np.int64(1) << bit), heads)
        keep = np.flatnonzero(mask)
        if not len(keep):
            return None
        out = table.select(["k1", "k2", "at"]).take(pa.array(keep)).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [*[c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in out.columns], pa.array(mask[keep], pa.int64())],
            names=["k1", "k2", "at", "mask"],
        )

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        key = batch.column(0).to_numpy()
        first_of_last = int(np.searchsorted(key, key[-1]))
        if first_of_last == 0 and held and held[-1].column(0)[0].as_py() == key[-1]:
            held.append(batch)
            continue
        out = marked(pa.Table.from_batches([*held, batch.slice(0, first_of_last)])) if held or first_of_last else None
        if out is not None:
            yield out
        held = [batch.slice(first_of_last)]
    if held:
        out = marked(pa.Table.from_batches(held))
        if out is not None:
            yield out


def _keyed(docs: DataFrame, doc_id: str, text: str, shards: int, names: tuple[str, str, str]) -> DataFrame:
    """Row keys (equal rows share them, and have the same repeats) and the shard."""
    k1, k2, shard = names
    given = [F.col(f"`{doc_id}`"), F.col(f"`{text}`")]
    return docs.withColumns({
        k1: F.xxhash64(*given), k2: F.hash(*reversed(given)),
        shard: F.pmod(F.hash(F.xxhash64(*given)), F.lit(shards)).cast("int"),
    })


def repeated_windows(
    docs: DataFrame, doc_id: str, text: str, window: int = 35, hot: int = 1000
) -> DataFrame:
    """``k1, k2, runs`` for rows with recurring windows: row keys and an array of
    (first word, bit mask of recurring windows from there on)."""
    if window < 2 * PHRASE:
        raise ValueError(f"window must be at least {2 * PHRASE} words")
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = _keyed(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), "doc_id", "text", shards, ("k1", "k2", "shard"))
    source = source.filter("text is not null")
    counted = source.select("shard", "text").mapInArrow(_count_phrases(window), "key long, shard int, n long")
    by_shard = counted.groupBy("key", "shard").agg(F.sum("n").alias("n"))
    total = by_shard.selectExpr("key", "shard", "sum(n) over (partition by key) as total").filter("total > 1")
    phrases = total.selectExpr("shard", "0 as kind", "key as k1", f"total > {hot} as hot", "0 as k2", "cast(null as string) as text")
    rows = phrases.union(source.selectExpr("shard", "1 as kind", "k1", "false as hot", "k2", "text"))
    dealt = rows.repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    cold = (
        dealt.mapInArrow(_locate(window, False), "key long, k1 long, k2 int, at int, hashes binary")
        .repartition("key").sortWithinPartitions("key")
        .mapInArrow(_confirm, "k1 long, k2 int, at int, mask long")
    )
    single = dealt.mapInArrow(_locate(window, True), "key long, k1 long, k2 int, at int")
    twice = single.groupBy("key").count().filter("count > 1").select("key")
    warm = single.join(twice, "key", "left_semi").selectExpr("k1", "k2", "at", "1L as mask")
    return cold.union(warm).groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "mask")).alias("runs"))


def _remove(window: int, n_kept: int, names: list[str]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = batch.column(n_kept + 1).to_pylist()
            data, at = buffers(batch.column(n_kept))
            for first, last in row_blocks(at):
                base = at[first]
                block = data[base : at[last]].copy()
                words = split_words(block, at[first : last + 1] - base)
                gone = np.zeros(len(words.hash) + 1, np.int64)
                for i in range(first, last):
                    for run in runs[i] or ():
                        left, mask = words.first[i - first] + run["at"], run["mask"]
                        while mask:
                            low = (mask & -mask).bit_length() - 1
                            gone[left + low] += 1
                            gone[left + low + window] -= 1
                            mask &= mask - 1
                removed = np.cumsum(gone)[:-1] > 0
                lost = np.concatenate([[0], np.cumsum(removed)])
                lost = lost[words.first[1:]] - lost[words.first[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.slice(first, last - first) for c in batch.columns[:n_kept]],
                        pa.array(words.counts, pa.int64()), pa.array(lost, pa.int64()),
                        _joined(block, at[first : last + 1] - base, words, ~removed),
                    ],
                    names=names,
                )

    return task


def _joined(block: np.ndarray, at: np.ndarray, words: Words, keep: np.ndarray) -> pa.Array:
    """Kept words of every row, joined by one space."""
    start, end, row = words.start[keep], words.end[keep], words.row[keep]
    more = np.append(row[1:] == row[:-1], False)[: len(row)]
    block[end[more]] = 0x20
    edge = np.zeros(len(block) + 2, np.int32)
    edge[start] += 1
    np.subtract.at(edge, end + more, 1)
    take = np.cumsum(edge[:-2]) > 0
    offsets = np.concatenate([[0], np.cumsum(take)])[at].astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(block[take].tobytes())])


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = 35,
    hot: int = 1000,
    keep: list[str] | None = None,
) -> DataFrame:
    """Columns ``keep`` (all but the text by default) with ``n_words``,
    ``n_removed`` and ``kept`` (the words left, joined by one space).

    Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``, taken unchanged.  A
    word goes if a window of ``window`` words around it also starts anywhere
    else, in the same or another row; windows are judged on the input.  All
    rows count, repeated rows too: each makes the other's windows recur.  A
    null or empty text has no words and keeps an empty string; texts shorter
    than the window are never touched.  A null id is allowed.  Kept columns
    called like a result get underscores in front until they differ.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    runs = repeated_windows(docs, doc_id, text, window, hot)
    k1, k2, shard = fresh(docs, "__k1", "__k2", "__shard")
    keyed = _keyed(docs, doc_id, text, 1, (k1, k2, shard))
    names = kept_names(keep, ("n_words", "n_removed", "kept", "__text", "runs", "k1", "k2"))
    left = keyed.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text}`").alias("__text"), F.col(k1).alias("k1"), F.col(k2).alias("k2"))
    joined = left.join(runs, ["k1", "k2"], "left").select(*[f"`{n}`" for n in names], "__text", "runs")
    schema = joined.drop("__text", "runs").schema.add("n_words", "long").add("n_removed", "long").add("kept", "string")
    return joined.mapInArrow(_remove(window, len(names), schema.names), schema)
