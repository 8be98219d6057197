"""Byte-level BPE, encoded in padded numpy matrices and decoded again.

Distinct pieces of a batch are bucketed by length into matrices of token ids,
one piece a row, padded on the right.  In each round every row merges its
leftmost pair of minimum rank; ranks come from a hash table over pairs, rows
without a further merge leave the matrix (compaction), and its width shrinks
with the longest row left.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from veilspark.llm.frames import kept_names, text_slices
from veilspark.llm.segments import segments

NO_RANK = np.int32(2**31 - 1)
CACHE_ENTRIES = 250_000
WIDE = 512
_loaded: dict[tuple[str, str], "Bpe"] = {}


class PairTable:
    """Open-addressed table from a pair of ids to the rank (and id) of their union."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, rank = [], [], []
        for token, r in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        keys = (np.array(left, np.uint64) << np.uint64(32)) | np.array(right, np.uint64)
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, 2**64 - 1, np.uint64)
        self.ranks = np.full(1 << self.bits, NO_RANK, np.int32)
        self.probes = 0
        todo, slot = np.arange(len(keys)), self._slot(keys)
        ranks_in = np.array(rank, np.int32)
        while len(todo):
            self.probes += 1
            free = self.keys[slot] == 2**64 - 1
            took, at = np.unique(slot[free], return_index=True)
            rows = todo[free][at]
            self.keys[took], self.ranks[took] = keys[rows], ranks_in[rows]
            left_over = np.ones(len(todo), bool)
            left_over[np.flatnonzero(free)[at]] = False
            todo, slot = todo[left_over], (slot[left_over] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; ``NO_RANK`` where they do not merge or an id is negative."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | (right.astype(np.uint64) & np.uint64(0xFFFFFFFF))
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.ranks[slot], NO_RANK)
        open_ = (self.keys[slot] != keys) & (self.keys[slot] != 2**64 - 1)
        todo = np.flatnonzero(open_.ravel())
        flat, wanted, place = out.ravel(), keys.ravel(), slot.ravel()
        for _ in range(self.probes):
            if not len(todo):
                break
            place = place.copy()
            place[todo] = (place[todo] + 1) & self.mask
            seen = self.keys[place[todo]]
            hit = seen == wanted[todo]
            flat[todo[hit]] = self.ranks[place[todo[hit]]]
            todo = todo[~hit & (seen != 2**64 - 1)]
        return np.where((left < 0) | (right < 0), NO_RANK, flat.reshape(out.shape))


class Bpe:
    """Ranks file in the ``base64 rank`` form, and a splitting pattern."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.pattern = regex.compile(pattern)
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs = PairTable(self.ranks)
        self.cache: dict[str, tuple[int, str, bytes]] = {}

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Token ids of each piece."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            known = self.ranks.get(p)
            if known is not None:
                out[i] = np.array([known], np.int32)
            elif p:
                buckets.setdefault(max(4, 1 << (len(p) - 1).bit_length()), []).append(i)
        for width, rows in sorted(buckets.items()):
            per = max(1, 1_000_000 // width)
            for k in range(0, len(rows), per):
                self._merge_matrix([pieces[i] for i in rows[k : k + per]], rows[k : k + per], out)
        return out

    def _merge_matrix(self, pieces: list[bytes], rows: list[int], out: list[np.ndarray]) -> None:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = int(sizes.max())
        ids = np.full((len(pieces), width + 1), -1, np.int32)
        ids[np.arange(width + 1) < sizes[:, None]] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = self.pairs(ids[:, :-1], ids[:, 1:])
        rows_left = np.array(rows)
        while len(rows_left):
            at = rank.argmin(1)
            best = rank[np.arange(len(at)), at]
            done = best == NO_RANK
            if done.any():
                for r, line, n in zip(rows_left[done], ids[done], sizes[done], strict=True):
                    out[r] = line[:n].copy()
                keep = ~done
                rows_left, sizes, at, best = rows_left[keep], sizes[keep], at[keep], best[keep]
                if not len(rows_left):
                    return
                wide = int(sizes.max())
                ids, rank = ids[keep, : wide + 1], rank[keep, :wide]
            n = np.arange(len(rows_left))
            # The pair at ``at`` becomes one token; what stands right of it moves left.
            if ids.shape[1] > WIDE and len(n) == 1:
                a = int(at[0])
                ids[0, a + 1 : -1] = ids[0, a + 2 :]
                rank[0, a + 1 : -1] = rank[0, a + 2 :]
                ids[0, -1], rank[0, -1] = -1, NO_RANK
            else:
                cols = np.arange(ids.shape[1])
                from_ = np.minimum(cols + (cols > at[:, None]), ids.shape[1] - 1)
                ids = np.take_along_axis(ids, from_, 1)
                rank = np.take_along_axis(rank, np.minimum(from_[:, : rank.shape[1]], rank.shape[1] - 1), 1)
                rank[:, -1] = NO_RANK
                ids[:, -1] = -1
            ids[n, at] = best
            sizes = sizes - 1
            before = np.maximum(at - 1, 0)
            rank[n, before] = np.where(at > 0, self.pairs(ids[n, before], ids[n, at]), rank[n, before])
            rank[n, at] = self.pairs(ids[n, at], ids[n, at + 1])

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids.tolist()])

    def learn(self, wanted: set[str]) -> None:
        """Put segments into the cache: number of ids, ids joined by commas, decoded bytes."""
        new = [s for s in wanted if s not in self.cache]
        if len(self.cache) + len(new) > CACHE_ENTRIES:
            self.cache.clear()
            new = list(wanted)
        cut = [self.pattern.findall(s) for s in new]
        distinct = list({p for c in cut for p in c})
        ids = dict(zip(distinct, self.merge([p.encode() for p in distinct]), strict=True))
        for s, c in zip(new, cut, strict=True):
            line = np.concatenate([ids[p] for p in c]) if len(c) != 1 else ids[c[0]]
            self.cache[s] = (len(line), ",".join(map(str, line.tolist())), self.decode(line))

    def encode(self, texts: list[str]) -> Iterator[list[tuple[int, str, bytes]]]:
        """Per text, its segments' entries of the cache."""
        cut = [segments(t) for t in texts]
        self.learn({s for c in cut for s in c})
        for c in cut:
            yield list(map(self.cache.__getitem__, c))


def _bpe(path: str, pattern: str) -> Bpe:
    if (path, pattern) not in _loaded:
        _loaded[path, pattern] = Bpe(path, pattern)
    return _loaded[path, pattern]


def bpe_round_trip(
    docs: DataFrame,
    path: str,
    pattern: str,
    text: str = "text",
    keep: list[str] | None = None,
    outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"),
) -> DataFrame:
    """Encode every whole text, then decode the ids.

    Result: the columns ``keep`` (all but the text by default) and those of
    ``outputs``: ``n_tokens`` (long), ``ids`` (array of int), ``decoded``
    (binary), ``ids_sha256`` (hex over the decimal ids joined by commas),
    ``decoded_sha256`` (hex over the decoded bytes).

    Every match of ``pattern`` is encoded by itself, without special tokens.
    Texts are first cut where a match boundary is certain, and equal segments
    of a worker are encoded and decoded once.  A null text is an empty one
    (no ids).  Repeated rows give repeated results, an empty table an empty
    result.  A kept column called like an output gets underscores in front
    until it differs.  Map-only, no shuffle; memory is bounded by the cache, by
    slices of a few MB and by the longest text.
    """
    types = {"n_tokens": "long", "ids": T.ArrayType(T.IntegerType()), "decoded": "binary", "ids_sha256": "string", "decoded_sha256": "string"}
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    source = docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, kept_names(keep, (*outputs, "__text")), strict=True)],
        F.col(f"`{text}`").alias("__text"),
    )
    names = source.columns[:-1]
    schema = source.drop("__text").schema
    for name in outputs:
        schema = schema.add(name, types[name])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(path, pattern)
        make = {
            "n_tokens": lambda e: sum(x[0] for x in e),
            "ids": lambda e: np.fromstring(",".join([x[1] for x in e]), np.int32, sep=","),
            "decoded": lambda e: b"".join([x[2] for x in e]),
            "ids_sha256": lambda e: hashlib.sha256(",".join([x[1] for x in e]).encode()).hexdigest(),
            "decoded_sha256": lambda e: hashlib.sha256(b"".join([x[2] for x in e])).hexdigest(),
        }
        kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "decoded": pa.binary(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
        for batch in batches:
            row = 0
            for part in text_slices(batch.column(len(names))):
                made: dict[str, list] = {name: [] for name in outputs}
                for entries in bpe.encode([t or "" for t in part.to_pylist()]):
                    for name in outputs:
                        made[name].append(make[name](entries))
                kept = [c.slice(row, len(part)) for c in batch.columns[: len(names)]]
                row += len(part)
                yield pa.RecordBatch.from_arrays(
                    [*kept, *[pa.array(made[n], kinds[n]) for n in outputs]], names=[*names, *outputs]
                )

    return source.mapInArrow(task, schema)
