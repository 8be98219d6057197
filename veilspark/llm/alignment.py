"""Alignment of two tokenizers: which of their tokens cover the same bytes.

The tokens of both tokenizers are rows of sparse matrices whose columns are the
bytes of the text.  The product of one with the other's transpose counts the
bytes that two tokens share (overlap links).  Places where tokens of both end
cut the text into groups; the product of the group incidences links all tokens
that share a group.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from veilspark.llm.frames import fresh, text_slices
from veilspark.llm.segments import segments
from veilspark.llm.sparse import csr, product, summed, transposed
from veilspark.sources.stage import staged

BLOCK_BYTES = 6_000_000
RUN_CHARS = 65_536
_SPACE = "▁"
_loaded: dict[str, object] = {}


def _byte_of() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones
    stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class ByteTokens:
    """A byte-level tokenizer of the ``tokenizers`` library; special strings are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        spec = json.loads(self.tok.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.cuts = (
            not spec.get("normalizer") and pre.get("type") == "ByteLevel"
            and bool(pre.get("use_regex", True)) and not pre.get("add_prefix_space")
        )
        self.tok.no_truncation()
        self.tok.no_padding()
        table = _byte_of()
        words = self.tok.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(words.values(), default=-1) + 1)
        for word, i in words.items():
            self.bytes[i] = bytes(table[c] for c in word) if all(c in table for c in word) else word.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]


class PieceTokens:
    """A ``sentencepiece`` model that puts a space before a text; parts come with that space."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace(_SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.mark = self.sp.piece_to_id(_SPACE)
        # No piece has a space or line break behind another character, nothing is rewritten,
        # and the leading mark joins no line break: then a text may be cut before white space.
        odd = " a  b \n\n c\n d  　ﬁé "
        self.cuts = (
            not any(re.search(f"[^{_SPACE} \n][{_SPACE} \n]|{_SPACE}\n", p) for p in pieces)
            and self.sp.normalize(odd) == _SPACE + odd.replace(" ", _SPACE)
            and self.sp.id_to_piece(self.mark) == _SPACE
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with a space (the one that the model adds) or a line break."""
        ids = self.sp.encode([t[1:] if t[:1] == " " else t for t in texts], num_threads=1)
        return [
            [self.mark] if t == " " and self.cuts else i if t[:1] == " " else i[1:]
            for t, i in zip(texts, ids, strict=True)
        ]


def _tokens(path: str):
    """A tokenizer, loaded once per Python worker."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _loaded[path] = PieceTokens(path) if path.endswith(".model") else ByteTokens(path)
    return _loaded[path]


def _run(tok, parts: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Ids of parts that may be encoded as one text, and the part of each; None if the
    tokens do not spell the parts."""
    raw = [p.encode() for p in parts]
    ids = np.asarray(tok.encode(["".join(parts)])[0], np.int64)
    if b"".join(map(tok.bytes.__getitem__, ids.tolist())) != b"".join(raw):
        return None
    ends, stop = np.cumsum(sizes[ids]), np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
    return (ids, np.searchsorted(stop, ends)) if np.isin(stop, ends).all() else None


def _encoded(tok, parts: list[str], joins: bool, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all parts, the part of each, and which parts the tokens spell.

    With ``joins``, parts that end in no white space are encoded many at a time: the
    next begins with white space, where both tokenizers cut.
    """
    ids, part = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    good = np.ones(len(parts), bool)
    alone, run, size = [], [], 0

    def flush():
        nonlocal run, size
        got = _run(tok, [parts[i] for i in run], sizes) if run else None
        if got is None:
            alone.extend(run)
        else:
            ids.append(got[0])
            part.append(np.asarray(run, np.int64)[got[1]])
        run, size = [], 0

    for i, p in enumerate(parts):
        if joins and p[-1] > " " and not p[-1].isspace():
            run.append(i)
            size += len(p)
            if size > RUN_CHARS:
                flush()
        else:
            alone.append(i)
    flush()
    for i, found in zip(alone, tok.encode([parts[i] for i in alone]) if alone else [], strict=True):
        good[i] = b"".join(map(tok.bytes.__getitem__, found)) == parts[i].encode()
        ids.append(np.asarray(found, np.int64))
        part.append(np.full(len(found), i))
    ids, part = np.concatenate(ids), np.concatenate(part)
    order = np.argsort(part, kind="stable")
    return ids[order], part[order], good


def _rows(part: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One matrix row for each id of a part: the row of every token, and the part and id of every row."""
    key, row = np.unique(part << 32 | ids, return_inverse=True)
    return row, key


_DIGITS = 11


def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ASCII digits of 0 to n - 1 in rows of fixed width, and their lengths."""
    text = [str(i).encode() for i in range(n)]
    grid = np.frombuffer(b"".join(t.ljust(_DIGITS, b" ") for t in text), np.uint8).reshape(n, _DIGITS)
    return grid, np.fromiter(map(len, text), np.int64, n)


class Aligned:
    """Tokens, groups and links of a list of parts (none of which is empty).

    ``counts``: for every part the numbers of A tokens, B tokens, groups, links
    and overlapping token pairs.  ``groups``: the written groups of every part.
    Links: ``link_a``, ``link_b`` (ids) and ``link_n`` (occurrences) in
    ``link_at[p]:link_at[p + 1]``.  ``good``: both spell the part.
    """

    def __init__(self, parts: list[str], a, b):
        n = len(parts)
        joins = a.cuts and b.cuts
        sizes = [np.fromiter(map(len, t.bytes), np.int64, len(t.bytes)) for t in (a, b)]
        sides = [_encoded(t, parts, joins, s) for t, s in zip((a, b), sizes, strict=True)]
        self.good = sides[0][2] & sides[1][2]
        (ia, pa_), (ib, pb) = ((i[self.good[p]], p[self.good[p]]) for i, p, _ in sides)
        ea, eb = np.cumsum(sizes[0][ia]), np.cumsum(sizes[1][ib])
        total = int(ea[-1]) if len(ea) else 0

        # Token-byte incidence and the overlap links.
        def incidence(i, size):
            return csr(np.repeat(np.arange(len(i)), size[i]), np.arange(total), len(i), total)

        overlap = product(incidence(ia, sizes[0]), transposed(incidence(ib, sizes[1])))
        overlaps = np.bincount(pa_, np.diff(overlap.at), n).astype(np.int64) if len(ia) else np.zeros(n, np.int64)

        # Common ends cut groups; a token lies in one group.
        common = np.zeros((2, total + 1), bool)
        common[0, ea] = common[1, eb] = True
        common = common[0] & common[1]
        ends = np.flatnonzero(common)
        upto = np.cumsum(common) - common
        ga, gb = upto[ea], upto[eb]
        row_a, key_a = _rows(pa_, ia)
        row_b, key_b = _rows(pb, ib)
        links = product(
            csr(row_a, ga, len(key_a), len(ends)), transposed(csr(row_b, gb, len(key_b), len(ends)))
        )
        part = key_a[links.row] >> 32
        self.link_a = key_a[links.row] & 0xFFFFFFFF
        self.link_b = key_b[links.index] & 0xFFFFFFFF
        self.link_n = links.value
        self.link_at = np.searchsorted(part, np.arange(n + 1))
        group_part = np.zeros(len(ends), np.int64)
        group_part[ga] = pa_
        n_links = np.bincount(part, self.link_n, n) if len(part) else np.zeros(n)
        self.counts = np.stack([
            np.bincount(pa_, minlength=n), np.bincount(pb, minlength=n), np.bincount(group_part, minlength=n),
            n_links.astype(np.int64), overlaps,
        ]).astype(np.int64) if n else np.zeros((5, 0), np.int64)
        self.groups = _written(ia, ga, ib, gb, group_part, n, len(ends))


def _written(ia, ga, ib, gb, group_part, n, n_groups) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` for every part: A ids of a group, a bar, its B ids, groups parted by semicolons."""
    if not n_groups:
        return [b""] * n
    grid, width = _decimals(int(max(ia.max(), ib.max())) + 1)
    na, nb = np.bincount(ga, minlength=n_groups), np.bincount(gb, minlength=n_groups)
    upto_a, upto_b = np.cumsum(na), np.cumsum(nb)
    place_a = np.arange(len(ia)) + (upto_b - nb)[ga]
    place_b = np.arange(len(ib)) + upto_a[gb]
    ids = np.empty(len(ia) + len(ib), np.int64)
    mark = np.full(len(ids), ord(","), np.uint8)
    ids[place_a], ids[place_b] = ia, ib
    mark[place_a[upto_a - 1]] = ord("|")
    mark[place_b[upto_b - 1]] = ord(";")
    size = width[ids]
    cells = np.zeros((len(ids), _DIGITS), np.uint8)
    cells[:] = grid[ids]
    cells[np.arange(len(ids)), size] = mark
    text = cells[np.arange(_DIGITS) <= size[:, None]].tobytes()
    upto = np.concatenate([[0], np.cumsum(size + 1)])
    last = np.searchsorted(group_part, np.arange(n), "right")
    tokens = np.concatenate([[0], (upto_a + upto_b)[last - 1] * (last > 0)])
    at = upto[tokens]
    return [text[at[i] : max(at[i], at[i + 1] - 1)] for i in range(n)]


_ODD = re.compile(r"[^\S \n]|[\x1c-\x1f\x85]")


def _parts(texts: list[str], cuts: bool) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct parts of all texts (each with a space in front), the part at every place, and its text.

    With ``cuts`` a text is cut as ``segments`` does: before white space; the bytes of
    texts without odd white space are cut at once.
    """
    raw = [f" {t}".encode() if t else b"" for t in texts]
    at = np.cumsum([0, *map(len, raw)])
    data = np.frombuffer(b"".join(raw), np.uint8)
    start = np.zeros(len(data), bool)
    if cuts:
        white = (data == 0x20) | (data == 0x0A)
        start[1:] = white[1:] & ~white[:-1]
    for i, t in enumerate(texts):
        if cuts and t and _ODD.search(t):
            start[at[i] : at[i + 1]] = False
            sizes = [len(p.encode()) for p in segments(f" {t}")]
            start[at[i] + np.cumsum([0, *sizes[:-1]])] = True
    start[at[:-1][np.diff(at) > 0]] = True
    first = np.flatnonzero(start)
    found = pa.Array.from_buffers(
        pa.large_string(), len(first), [None, pa.py_buffer(np.append(first, len(data))), pa.py_buffer(data)]
    ).dictionary_encode()
    return found.dictionary.to_pylist(), np.asarray(found.indices, np.int64), np.searchsorted(at, first, "right") - 1


def _of_documents(texts: list[str], a, b) -> dict[str, list]:
    """The columns of ``token_alignment`` for a block of texts."""
    parts, flat, doc = _parts(texts, a.cuts and b.cuts)
    done = Aligned(parts, a, b)
    bad = np.zeros(len(texts), bool)
    bad[doc[~done.good[flat]]] = True
    flat, doc = flat[~bad[doc]], doc[~bad[doc]]
    at = np.searchsorted(doc, np.arange(len(texts) + 1))
    codes = flat.tolist()
    groups = [b";".join(map(done.groups.__getitem__, codes[x:y])) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    sums = [np.bincount(doc, c[flat], len(texts)).astype(np.int64) for c in done.counts]
    # Links of a document: those of its parts, added up by pair of ids.
    pair, number = np.unique(done.link_a << 32 | done.link_b, return_inverse=True)
    n = np.diff(done.link_at)[flat]
    place = np.repeat(done.link_at[flat] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    width = max(len(pair), 1)
    key, times = summed(np.repeat(doc, n) * width + number[place], done.link_n[place])
    row, index = np.divmod(key, width)
    return {
        "counts": sums, "groups": groups, "n": times, "pair": pair[index],
        "at": np.searchsorted(row, np.arange(len(texts) + 1)),
    }


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")


def token_alignment(
    docs: DataFrame, path_a: str, path_b: str, text: str = "text", keep: list[str] | None = None,
    write_groups: bool = False,
) -> DataFrame:
    """Columns ``keep`` (all but the text by default) with what two tokenizers make of
    every text: ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_overlaps``
    (longs), ``groups_sha256`` or, with ``write_groups``, ``groups`` itself, and
    ``links``, an array of (pair, n): ``pair`` is the A id times 2**32 plus the B id,
    ``n`` the number of linked occurrences of the two.

    ``path_a`` names a byte-level ``.json`` (tokenizers), which reads a space and the
    text; ``path_b`` a ``.model`` (sentencepiece), which adds that space itself; every
    worker must be able to read both.  Special strings in a text are plain text.

    A text that is null, empty, or not spelled by the tokens of both (as one with
    U+2581) has no tokens: zeros, no links, an empty digest.  Repeated rows give
    repeated results, an empty table an empty result; columns that pass through may
    have any name, results that would clash get a leading underscore.  Where both
    tokenizers surely cut before white space, the distinct parts of a block of
    ``BLOCK_BYTES`` are tokenized and aligned once; memory follows the block or the
    longest text.  Within a group equal ids are counted, not paired one by one, so a
    long run without a common end stays linear.  Map-only.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    digest = "groups" if write_groups else "groups_sha256"
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("\x01text"))
    kept = source.drop("\x01text")
    names = fresh(kept, *FIELDS, digest, "links")
    schema = T.StructType([
        *kept.schema.fields,
        *[T.StructField(n, T.LongType()) for n in names[:5]],
        T.StructField(names[5], T.StringType()),
        T.StructField(names[6], T.ArrayType(T.StructType([
            T.StructField("pair", T.LongType()), T.StructField("n", T.LongType())]))),
    ])
    width = len(kept.columns)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _tokens(path_a), _tokens(path_b)
        for batch in batches:
            first = 0
            for part in text_slices(batch.column(width), BLOCK_BYTES):
                out = _of_documents([t or "" for t in part.to_pylist()], a, b)
                groups = [
                    (g.decode() if write_groups else sha256(g).hexdigest()) if g else "" for g in out["groups"]
                ]
                links = pa.ListArray.from_arrays(
                    pa.array(out["at"], pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array(out["pair"], pa.int64()), pa.array(out["n"], pa.int64())], ["pair", "n"]
                    ),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.slice(first, len(part)) for c in batch.columns[:width]],
                        *[pa.array(c, pa.int64()) for c in out["counts"]],
                        pa.array(groups, pa.string()), links,
                    ],
                    names=[f.name for f in schema.fields],
                )
                first += len(part)

    return source.mapInArrow(task, schema)


def pair_counts(aligned: DataFrame, links: str = "links") -> DataFrame:
    """(pair, docs, best): in how many documents a pair of ids is linked, and whether no
    pair of the same A id is in more.

    Counted before the shuffle.  The best count of every A id is sent to all tasks:
    one row for an id of the vocabulary of A, whatever the corpus.
    """
    counts = staged(
        aligned.select(F.explode(F.col(f"`{links}`.pair")).alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    )
    first = F.shiftright("pair", 32)
    top = counts.groupBy(first.alias("a")).agg(F.max("docs").alias("most"))
    return counts.join(F.broadcast(top), first == F.col("a")).select(
        "pair", "docs", (F.col("docs") == F.col("most")).alias("best")
    )


def _split_at(counts: DataFrame, most: int) -> tuple[int, bool]:
    """The least power of two that at most ``most`` pairs reach, and whether any pair lies below it."""
    bits = F.length(F.bin("docs"))
    sizes = {r["b"]: r["n"] for r in counts.groupBy(bits.alias("b")).agg(F.count("*").alias("n")).collect()}
    cut, held = 64, 0
    for b in sorted(sizes, reverse=True):
        if held + sizes[b] > most:
            break
        cut, held = b, held + sizes[b]
    return 1 << (cut - 1) if cut < 64 else 2**62, held < sum(sizes.values())


def alignment_scores(
    docs: DataFrame, path_a: str, path_b: str, text: str = "text", keep: list[str] | None = None,
    frequent: int = 500_000,
) -> DataFrame:
    """``token_alignment`` without the links, with ``n_best`` (links whose pair is linked
    in as many documents as any pair of its A id, ties included) and ``count_sum``
    (that number of documents, added over all links).

    The pairs met in most documents, at most ``frequent`` of them, are sent to all
    tasks; these hold nearly all links and every hot pair.  The links of all other
    pairs are joined by a shuffle on the pair.  Both ways give the same numbers.
    """
    aligned = token_alignment(docs, path_a, path_b, text, keep)
    rid, pair, n, docs_, best, n_best, count_sum = fresh(
        aligned, "rid", "pair", "n", "docs", "best", "n_best", "count_sum"
    )
    links = aligned.columns[-1]
    aligned = staged(aligned.withColumn(rid, F.monotonically_increasing_id()))
    counts = staged(pair_counts(aligned, links).toDF(pair, docs_, best))
    cut, rest = _split_at(counts.toDF("pair", "docs", "best"), frequent)
    flat = aligned.select(rid, F.inline(links)).toDF(rid, pair, n)

    def sums(hits: DataFrame) -> DataFrame:
        def total(x: Column, name: str) -> Column:
            return F.sum(x).alias(name)

        return hits.groupBy(rid).agg(
            total(F.when(F.col(best), F.col(n)).otherwise(F.lit(0)), n_best), total(F.col(n) * F.col(docs_), count_sum)
        )

    head = counts.filter(F.col(docs_) >= cut)
    found = sums(flat.join(F.broadcast(head), pair))
    if rest:
        tail = counts.filter(F.col(docs_) < cut)
        missed = flat.join(F.broadcast(head.select(pair)), pair, "left_anti")
        found = found.unionByName(sums(missed.join(tail.hint("shuffle_hash"), pair)))
        found = found.groupBy(rid).agg(F.sum(n_best).alias(n_best), F.sum(count_sum).alias(count_sum))
    kept = [c for c in aligned.columns if c not in (rid, links)]
    out = aligned.select(*[F.col(f"`{c}`") for c in [*kept, rid]]).join(found, rid, "left")
    zero = F.lit(0).cast("long")
    return out.select(
        *[F.col(f"`{c}`") for c in kept],
        F.coalesce(n_best, zero).alias(n_best), F.coalesce(count_sum, zero).alias(count_sum),
    )
