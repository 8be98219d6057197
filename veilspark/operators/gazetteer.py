"""Dictionary entities: terms of a table (term, label) found in text cells.

A term is its words (``TOKEN``) joined by one space.  It is found where its words
follow one another with at most ``MAX_GAP`` characters between two of them.  At
every place the longest term counts, and a hit inside a longer hit is dropped;
hits that overlap in part both stay.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from veilspark import constants as K
from veilspark.functions.arrays import lookup
from veilspark.operators.cells import _named, cells, row_text
from veilspark.operators.keyfilter import crc_bitmap, in_bitmap, key_test
from veilspark.sources.stage import staged

TOKEN = r"[\p{L}\p{N}_]+"
MAX_GAP = 3
BROADCAST_TERMS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 16
RUN_CHARS = 4_000_000
LABELS = [*K.MODEL_LABELS, *K.OWN_LABELS]
HITS_DDL = "array<struct<text:string,label:string,start:int,end:int>>"

_WORD = re.compile(r"\w+")


def label_type(label: Column) -> Column:
    return F.coalesce(lookup(K.LABEL_TYPES | K.OWN_LABELS, label), F.lower(label))


def normalized_terms(dictionary: DataFrame) -> DataFrame:
    """``(norm, label, n_words)`` with one row per normalized term (least label wins)."""
    words = F.regexp_extract_all(F.col("term"), F.lit(TOKEN), F.lit(0))
    return (
        dictionary.filter(F.col("label").isin(LABELS))
        .select(F.array_join(words, " ").alias("norm"), F.size(words).alias("n_words"), "label")
        .filter("n_words > 0")
        .groupBy("norm")
        .agg(F.min("label").alias("label"), F.max("n_words").alias("n_words"))
    )


@dataclass(frozen=True)
class Terms:
    """A measured dictionary: its normalized terms, their number, bytes and longest."""

    frame: DataFrame
    n: int
    size: int
    longest: int
    small: bool


def measured(dictionary: DataFrame | Terms, broadcast_terms: int = BROADCAST_TERMS) -> Terms:
    """Normalize a dictionary once and measure whether it may be sent to every task."""
    if isinstance(dictionary, Terms):
        return dictionary
    frame = staged(normalized_terms(dictionary))
    got = frame.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.octet_length("norm") + F.octet_length("label")), F.lit(0)).alias("size"),
        F.coalesce(F.max("n_words"), F.lit(1)).alias("longest"),
    ).first()
    small = got["n"] <= broadcast_terms and got["size"] <= BROADCAST_BYTES
    return Terms(frame, got["n"], got["size"], got["longest"], small)


# --- in the task that has the text ----------------------------------------------------


def _table(terms: list[tuple[str, str]]) -> dict[str, list[tuple[int, list[str], str]]]:
    """First word -> (number of words, words, label), longest first."""
    table: dict[str, list[tuple[int, list[str], str]]] = {}
    for norm, label in terms:
        words = norm.split(" ")
        table.setdefault(words[0], []).append((len(words), words, label))
    for options in table.values():
        options.sort(key=lambda o: -o[0])
    return table


def _close(text: str, found: list[re.Match], first: int, last: int) -> bool:
    return all(found[k + 1].start() - found[k].end() <= MAX_GAP for k in range(first, last - 1))


def term_hits(text: str | None, table: dict) -> list[tuple[str, str, int, int]]:
    """(text, label, start, end) of the hits of one cell, in order."""
    if not text or table.keys().isdisjoint(_WORD.findall(text)):
        return []
    found = list(_WORD.finditer(text))
    words = [m.group() for m in found]
    hits, reach = [], 0
    for i, word in enumerate(words):
        for n, wanted, label in table.get(word, ()):
            if words[i : i + n] == wanted and _close(text, found, i, i + n):
                if i + n > reach:
                    start, end = found[i].start(), found[i + n - 1].end()
                    hits.append((text[start:end], label, start, end))
                    reach = i + n
                break
    return hits


def row_tagger(terms: Terms) -> Callable[[Column], Column]:
    """Array of texts -> array of their hits (``HITS_DDL`` each).

    One Arrow-batched function for all text columns of a row, so a task keeps one
    Python worker; the table of terms is built once per worker.
    """
    pairs = [(r["norm"], r["label"]) for r in terms.frame.select("norm", "label").toLocalIterator()]
    sent = terms.frame.sparkSession.sparkContext.broadcast(pairs)
    names = ("text", "label", "start", "end")

    def tag(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = _table(sent.value)
        for batch in batches:
            yield pd.Series([
                [[dict(zip(names, h, strict=True)) for h in term_hits(t, table)] for t in texts] for texts in batch
            ])

    return F.pandas_udf(tag, f"array<{HITS_DDL}>")


# --- a dictionary too large for that ----------------------------------------------------


def _term_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """CRC-32 of the beginnings of every term, word by word; ``whole`` marks the term itself."""
    for batch in batches:
        for norm in batch.column(0).to_pylist():
            hashes, words = [], norm.split(" ")
            for word in words:
                hashes.append(zlib.crc32(f" {word}".encode(), hashes[-1]) if hashes else zlib.crc32(word.encode()))
            whole = [False] * (len(words) - 1) + [True]
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(whole)], names=["crc", "whole"])


def _runs(texts: DataFrame, terms: Terms, most_chars: int = RUN_CHARS) -> DataFrame:
    """Runs of words that are a term, as (row_id, col_idx, column, start, end, text, norm).

    A run grows word by word while it begins like some term and is given out where it is
    one; two bitmaps decide, so a few others pass.  At most ``most_chars`` characters of
    runs (or one run) are held at a time.
    """
    hashes = terms.frame.select("norm").mapInArrow(_term_hashes, "crc long, whole boolean")
    known = staged(hashes.groupBy("crc").agg(F.max("whole").alias("whole")))
    maps = crc_bitmap(known), crc_bitmap(known.filter("whole"))
    sent = texts.sparkSession.sparkContext.broadcast(maps)
    longest = terms.longest
    key = texts.schema["row_id"]
    types = (pa.int32(), pa.int32(), pa.string(), pa.string())

    def found_in(text: str) -> Iterator[tuple[int, int, str, str]]:
        begins, wholes = sent.value
        found = list(_WORD.finditer(text))
        words = [m.group() for m in found]
        coded = [w.encode() for w in words]
        for i, word in enumerate(coded):
            crc = zlib.crc32(word)
            for n in range(1, min(longest, len(words) - i) + 1):
                if n > 1:
                    if found[i + n - 1].start() - found[i + n - 2].end() > MAX_GAP:
                        break
                    crc = zlib.crc32(coded[i + n - 1], zlib.crc32(b" ", crc))
                if not in_bitmap(begins, crc):
                    break
                if in_bitmap(wholes, crc):
                    start, end = found[i].start(), found[i + n - 1].end()
                    yield start, end, text[start:end], " ".join(words[i : i + n])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            out: list[tuple[int, int, str, str]] = []
            held = 0

            def packed() -> pa.RecordBatch:
                taken = batch.select([0, 1, 2]).take(pa.array(rows, pa.int64()))
                columns = list(zip(*out, strict=True)) or [(), (), (), ()]
                return pa.RecordBatch.from_arrays(
                    [*taken.columns, *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                    names=["row_id", "col_idx", "column", "start", "end", "text", "norm"],
                )

            for row, text in enumerate(batch.column(3)):
                for run in found_in(text.as_py()):
                    rows.append(row)
                    out.append(run)
                    held += len(run[2]) + len(run[3])
                    if held >= most_chars:
                        yield packed()
                        rows, out, held = [], [], 0
            yield packed()

    schema = f"row_id {key.dataType.simpleString()}, col_idx int, column string, start int, end int, text string, norm string"
    return texts.mapInArrow(task, schema)


def _joined_hits(texts: DataFrame, terms: Terms) -> DataFrame:
    """Hits by a join on the term; only runs are moved, a frequent term over ``SALTS`` tasks."""
    salt = F.pmod(F.xxhash64("row_id", "col_idx", "start"), F.lit(SALTS)).cast("int")
    spread = terms.frame.select("norm", "label").withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    hits = _runs(texts, terms).withColumn("salt", salt).join(spread, ["norm", "salt"])
    before = Window.partitionBy("row_id", "col_idx").orderBy("start", F.desc("end")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    reach = hits.withColumn("reach", F.max("end").over(before))
    return reach.filter(F.col("reach").isNull() | (F.col("end") > F.col("reach"))).drop("reach", "salt", "norm")


def _hits(df: DataFrame, key: str, terms: Terms, columns: Sequence[str] | None) -> DataFrame:
    """(row_id, col_idx, column, start, end, text, label), by whichever way fits the dictionary."""
    texts = cells(df, key, columns)
    if not terms.small:
        return _joined_hits(texts, terms)
    hits = F.get(row_tagger(terms)(F.array("text")), F.lit(0))
    found = texts.select("row_id", "col_idx", "column", F.explode(hits).alias("h"))
    return found.select("row_id", "col_idx", "column", "h.start", "h.end", "h.text", "h.label")


def gazetteer_entities(
    df: DataFrame,
    key: str,
    dictionary: DataFrame | Terms,
    columns: Sequence[str] | None = None,
    broadcast_terms: int = BROADCAST_TERMS,
) -> DataFrame:
    """Every dictionary term found in the text cells, with offsets.

    Up to ``broadcast_terms`` terms and ``BROADCAST_BYTES`` the dictionary is sent to
    the tasks and nothing moves; beyond it only runs of words that are a term (bitmaps
    of all beginnings and of whole terms decide) are shuffled, with their keys and offsets.
    """
    hits = _hits(df, key, measured(dictionary, broadcast_terms), columns)
    return hits.select(
        "row_id", "column", "col_idx", "start", "end", "text", "label",
        label_type(F.col("label")).alias("type"),
        F.lit(K.MODEL_CONFIDENCE).alias("confidence"),
        F.lit(K.TERM_METHOD).alias("method"),
    )


def attached(df: DataFrame, key: str, values: DataFrame, name: str) -> DataFrame:
    """``df`` with the column ``name`` of ``values`` (``row_id``, ``name``), NULL where there is none.

    A bitmap of the keys in ``values`` parts the table: rows that have none are never
    shuffled.  ``values`` should be staged, as it is read twice.
    """
    test = key_test(values, "row_id")(_named(key))
    touched = df.filter(test)
    rest = df.filter(~test).withColumn(name, F.lit(None).cast(values.schema[name].dataType))
    joined = touched.join(values.withColumnRenamed("row_id", f"{name}_of"), _named(key) == F.col(f"{name}_of"), "left")
    return joined.drop(f"{name}_of").unionByName(rest)


def with_term_hits(
    df: DataFrame, key: str, columns: Sequence[str], dictionary: DataFrame | Terms, prefix: str
) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with hidden columns from which the hits of every text column are read."""
    terms = measured(dictionary)
    if terms.small:
        texts = F.array(*[_named(c).cast("string") for c in columns]).cast("array<string>")
        tagged = df.select("*", row_tagger(terms)(texts).alias(prefix))
        return tagged, {c: F.get(F.col(prefix), F.lit(i)) for i, c in enumerate(columns)}
    hit = F.struct("column", "text", "label", F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    found = staged(
        _joined_hits(cells(df, key, columns), terms)
        .groupBy("row_id")
        .agg(F.array_sort(F.collect_list(hit), lambda a, b: F.signum(a["start"] - b["start"]).cast("int")).alias(prefix))
    )

    def of(column: str) -> Column:
        mine = F.filter(F.col(prefix), lambda h: h["column"] == column)
        return F.transform(mine, lambda h: F.struct(h["text"], h["label"], h["start"], h["end"]))

    return attached(df, key, found, prefix), {c: of(c) for c in columns}


def with_gazetteer(detections: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Union of dictionary and pattern detections; dictionary hits win a tie.

    Only detections are shuffled, never the text.
    """
    strong = gazetteer.withColumn("_rank", F.lit(-1))
    weak = detections.withColumn("_rank", F.col("ent_ord")).drop("ent_ord")
    span = ["row_id", "col_idx", "start", "end"]
    both = strong.unionByName(weak)
    rest = [c for c in both.columns if c not in span]
    unique = (
        both.groupBy(*span)
        .agg(F.min_by(F.struct(*rest), F.col("_rank")).alias("e"))
        .select(*span, "e.*")
    )
    order = Window.partitionBy("row_id").orderBy("col_idx", "start", "_rank", "end")
    return unique.withColumn("ent_ord", F.row_number().over(order) - 1).drop("_rank")


def rows_of(df: DataFrame, key: str, detections: DataFrame, with_text: bool = True) -> DataFrame:
    """Bring a detection frame back to ``entity_rows`` form (one join by row)."""
    fields = [
        "column", "col_idx", F.lit(0).alias("base"), "text", "label", "type",
        "start", "end", "confidence", "method",
    ]
    packed = F.struct("ent_ord", F.struct(*fields).alias("e"))
    grouped = detections.groupBy("row_id").agg(
        F.transform(F.array_sort(F.collect_list(packed)), lambda p: p["e"]).alias("entities")
    )
    if not with_text:
        return grouped
    texts = df.select(_named(key).alias("row_id"), row_text(df, key).alias("row_text"))
    return texts.join(grouped, "row_id").select("row_id", "row_text", "entities")
