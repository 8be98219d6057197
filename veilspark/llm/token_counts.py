"""Token counts: how many tokens a library tokenizer makes of every text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from veilspark.llm.frames import kept_names, text_slices
from veilspark.llm.segments import segments

BATCH_BYTES = 262_144
CACHE_ENTRIES = 400_000
_loaded: dict[str, tuple] = {}


def _tokenizer(path: str):
    """The tokenizer and its segment cache, once per Python worker."""
    if path not in _loaded:
        if path.endswith(".model"):
            import sentencepiece

            _loaded[path] = (sentencepiece.SentencePieceProcessor(model_file=path), {})
        else:
            from tokenizers import Tokenizer

            _loaded[path] = (Tokenizer.from_file(path), {})
    return _loaded[path]


def _splits_freely(tok) -> bool:
    """True for byte-level BPE that cuts texts by the usual pattern and changes nothing else."""
    import json

    spec = json.loads(tok.to_str())
    pre = spec.get("pre_tokenizer") or {}
    plain = not spec.get("normalizer") and not spec.get("truncation") and not spec.get("padding")
    words = all(
        not a["lstrip"] and not a["rstrip"] and not any(c.isspace() for c in a["content"])
        for a in spec.get("added_tokens", [])
    )
    level = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    return bool(plain and words and level)


def _lengths(tok, texts: list[str]) -> list[int]:
    """Lengths only, in batches of about ``BATCH_BYTES`` characters."""
    out: list[int] = []
    batch: list[str] = []
    size = 0

    def flush():
        if hasattr(tok, "encode_batch_fast"):
            out.extend(len(e) for e in tok.encode_batch_fast(batch, add_special_tokens=False))
        else:
            out.extend(map(len, tok.encode(batch, num_threads=1)))
        batch.clear()

    for text in texts:
        batch.append(text)
        size += len(text)
        if size >= BATCH_BYTES:
            flush()
            size = 0
    if batch:
        flush()
    return out


def _counts(tok, cache: dict, texts: list[str]) -> list[int]:
    """Counts by distinct segments: every new segment is encoded once per worker."""
    cut = [segments(t) for t in texts]
    new = {s for c in cut for s in c if s not in cache}
    if len(cache) + len(new) > CACHE_ENTRIES:
        cache.clear()
        new = {s for c in cut for s in c}
    new = list(new)
    cache.update(zip(new, _lengths(tok, new), strict=True))
    return [sum(map(cache.__getitem__, c)) for c in cut]


def token_counts(
    docs: DataFrame,
    path: str,
    text: str = "text",
    keep: list[str] | None = None,
    limit: int = 512,
) -> DataFrame:
    """Columns ``keep`` (all but the text by default) with ``n_bytes`` (UTF-8),
    ``n_tokens`` and ``over_limit`` (``n_tokens > limit``).

    ``path`` names a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file
    that every worker can read.  No begin, end or added tokens are counted;
    special strings inside a text count as the library's default has it.  For
    byte-level BPE texts are split where a token boundary is certain, and equal
    segments are encoded once per worker; other models encode whole texts.

    A null text is an empty one: 0 bytes, 0 tokens.  Repeated rows give repeated
    results, an empty table an empty result; further columns pass through, and
    those called like a result get underscores in front until they differ.  Map-only, no shuffle.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    names = kept_names(keep, ("n_bytes", "n_tokens", "over_limit", "__text"))
    source = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{text}`").alias("__text"))
    schema = source.drop("__text").schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tok, cache = _tokenizer(path)
        free = not path.endswith(".model") and _splits_freely(tok)
        for batch in batches:
            column = batch.column(len(names))
            sizes, counts = [], []
            for part in text_slices(column):
                texts = [t or "" for t in part.to_pylist()]
                sizes += [len(t.encode()) for t in texts]
                counts += _counts(tok, cache, texts) if free else _lengths(tok, texts)
            n = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(sizes, pa.int64()), n,
                 pa.array([c > limit for c in counts], pa.bool_())],
                names=[*names, "n_bytes", "n_tokens", "over_limit"],
            )

    return source.mapInArrow(task, schema)

