"""Line dedup: near-duplicate lines across all texts, one line kept of each group.

DataFrame expressions only.  Signatures are minima of hashed character shingles
under many masks.  Lines of up to 160 characters take every 5-character shingle;
from 128 on they take 8-character shingles that start at a word, unless words
are very long (scripts without spaces), where every shingle counts.  The two
ranges overlap, so lines alike enough to link share a kind.  Bands of equal
minima give candidates, each is compared with the hubs of its bucket on the exact
Jaccard similarity of all 5-character shingles, and links are closed by a
distributed union-find.  Pairs of a bucket that this leaves apart are compared too.
There a bitmap of each line's shingles bounds the similarity from above, so the texts of
such a pair meet only where the bound allows a link.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, functions as F

from veilspark.functions.arrays import let
from veilspark.llm.components import connected
from veilspark.llm.frames import fresh, kept_names
from veilspark.sources.stage import staged

SPACE = " \t\n\x0b\x0c\r"
# 16 minima as a 4 x 4 square; its rows and columns are the bands.
MINIMA = 16
BANDS = [*[(4 * r, 4 * r + 1, 4 * r + 2, 4 * r + 3) for r in range(4)], *[(c, c + 4, c + 8, c + 12) for c in range(4)]]
SHINGLE = 5
SHORT = 160
BROADCAST_ROWS = 1_000_000
TILE = 500
_rnd = random.Random(20240607)
_MASKS = [_rnd.getrandbits(31) for _ in range(MINIMA)]
_EVERY = rf"(?s)(?=(.{{{SHINGLE}}}))"
_HUBS = [0, -1, _rnd.getrandbits(62), _rnd.getrandbits(62)]
WORDS = 32  # of 64 bits, in a line's bitmap


def line_ids(text: Column) -> Column:
    """Hash of every line, without its outer white space; null for lines without a word."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.transform(lines, lambda x: F.nullif(F.xxhash64(F.btrim(x, F.lit(SPACE))), F.xxhash64(F.lit(""))))


def _lines(texts: DataFrame) -> DataFrame:
    """``id, line`` of every line with a word."""
    rows = texts.select(F.explode(F.split("text", "\n")).alias("line")).select(F.btrim("line", F.lit(SPACE)).alias("line"))
    return rows.filter("line != ''").select(F.xxhash64("line").alias("id"), "line")


def _shingle_rows(texts: DataFrame) -> DataFrame:
    """``id, kind, s`` of every shingle that signatures are made of.

    Kind 0 cuts at every byte that begins a character (five take at most 20 bytes), kind 1 takes each
    word with the next one.  Rows of places are cut by compiled code; a pattern or a lambda would cost
    several times as much.  What a row needs is put into ``k``, or it would be made anew at every place.
    """
    size, octets = F.length("line"), F.octet_length("line")
    words = size - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    sized = _lines(texts).select("id", "line", size.alias("size"), words.alias("words"))
    size, words = F.col("size"), F.col("words")

    def of_kind(kind: int, raw: Column, split: Column, last: Column) -> Column:
        fields = {"kind": F.lit(kind), "raw": raw.cast("binary"), "words": split.cast("array<string>"), "ascii": size == octets, "last": last}
        return F.struct(*[c.alias(n) for n, c in fields.items()])

    none = F.lit(None)
    kinds = F.array(
        F.when((size <= SHORT) | (size > 12 * words), of_kind(0, F.col("line"), none, F.greatest(octets - SHINGLE, F.lit(0)))),
        F.when((size >= 0.8 * SHORT) & (size < 18 * words), of_kind(1, none, F.split("line", " "), words - 1)),
    )
    known = sized.select("id", F.explode(kinds).alias("k")).filter("k is not null").select("id", "k.*")
    at = known.select("id", "kind", "raw", "words", "ascii", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("at"))
    place = F.col("at")
    inside = F.substring("raw", place + 1, F.lit(1)).between(F.lit(b"\x80"), F.lit(b"\xbf"))
    begins = at.filter((place == 0) | (F.col("kind") == 1) | F.col("ascii") | ~inside)
    word = F.get("words", place)
    two = F.coalesce(F.concat(word, F.lit(" "), F.get("words", place + 1)), word)
    flat = F.substring("raw", place + 1, F.lit(SHINGLE)).cast("string")
    wide = F.substring(F.substring("raw", place + 1, F.lit(4 * SHINGLE)).cast("string"), 1, SHINGLE)
    s = F.when(F.col("kind") == 1, F.substring(two, 1, 8)).when(F.col("ascii"), flat).otherwise(wide)
    cut = begins.select("id", "kind", "ascii", "at", s.alias("s"))
    return cut.filter((F.col("kind") == 1) | F.col("ascii") | (F.col("at") == 0) | (F.length("s") == SHINGLE)).select("id", "kind", "s")


def signatures(texts: DataFrame) -> DataFrame:
    """``id, bands`` of every distinct line, by kind of shingle.  Minima are taken before the shuffle,
    so texts do not move and a line's copies meet as one row a task."""
    hashed = _shingle_rows(texts).select("id", "kind", F.shiftrightunsigned(F.xxhash64("s"), 33).cast("int").alias("v"))
    minima = hashed.groupBy("id", "kind").agg(*[F.min(F.col("v").bitwiseXOR(F.lit(m))).alias(f"m{i}") for i, m in enumerate(_MASKS)])
    bands = [F.xxhash64("kind", F.lit(b), *[f"m{k}" for k in line]) for b, line in enumerate(BANDS)]
    return minima.select("id", F.array(*bands).alias("bands"))


def buckets(signed: DataFrame) -> DataFrame:
    """``band, id`` of the bands that several lines share.  Bands are counted first, so
    only lines that meet another move further."""
    rows = signed.select(F.explode("bands").alias("band"), "id")
    shared = rows.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    return staged(rows.join(shared, "band"))


def _with_hubs(met: DataFrame) -> DataFrame:
    least = [F.min(F.col("id").bitwiseXOR(F.lit(m))).bitwiseXOR(F.lit(m)) for m in _HUBS]
    return met.join(met.groupBy("band").agg(F.array_distinct(F.array(*least)).alias("hubs")), "band")


def hub_pairs(met: DataFrame) -> DataFrame:
    """``a, b``: every line of a bucket with the bucket's hubs, its smallest ids under a
    few orders.  Never more pairs than lines times hubs; ``open_pairs`` has the others."""
    both = _with_hubs(met).select("id", F.explode("hubs").alias("hub")).filter("id != hub")
    return both.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()


def _total(terms: list[Column]) -> Column:
    """Their sum, as a flat tree."""
    while len(terms) > 1:
        terms = [sum(terms[i + 1 : i + 2], terms[i]) for i in range(0, len(terms), 2)]
    return terms[0]


def sketches(lines: DataFrame) -> DataFrame:
    """``id, n, spare, w0 ...``: the number of different shingles of a line, a bitmap of their
    hashes, and how many shingles more than bits it has.  Staged, as the optimizer would try
    all subsets of the words where it sees how ``spare`` is made of them."""
    hashed = lines.select("id", F.explode(_shingles("line")).alias("s")).select("id", F.xxhash64("s").alias("h"))
    bit = F.expr("shiftleft(1L, cast(pmod(shiftright(h, 8), 64) as int))")
    placed = hashed.select("id", F.pmod("h", F.lit(WORDS)).alias("word"), bit.alias("bit"))
    names = [f"w{k}" for k in range(WORDS)]
    words = [F.bit_or(F.when(F.col("word") == k, F.col("bit")).otherwise(F.lit(0).cast("long"))).alias(w) for k, w in enumerate(names)]
    found = placed.groupBy("id").agg(F.count("*").alias("n"), *words)
    return staged(found.select("id", "n", (F.col("n") - _total([F.bit_count(w) for w in names])).alias("spare"), *names))


def _sketch_of(sketch: DataFrame, side: str) -> DataFrame:
    return sketch.select(F.col("id").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in sketch.columns if c != "id"])


def _within_reach(least: float) -> Column:
    """Whether two lines can be alike: a bit that only one line has set is a shingle that the
    other one lacks, so shared bits and spare shingles bound the intersection."""
    shared = _total([F.bit_count(F.col(f"a_w{k}").bitwiseAND(F.col(f"b_w{k}"))) for k in range(WORDS)])
    most = shared + F.least("a_spare", "b_spare")
    return (1 + least) * most >= least * (F.col("a_n") + F.col("b_n")) - 1e-6


def reachable(pairs: DataFrame, sketch: DataFrame, least: float) -> DataFrame:
    """The pairs whose sketches do not rule out a similarity of ``least``."""
    both = pairs.join(_sketch_of(sketch, "a"), "a").join(_sketch_of(sketch, "b"), "b")
    return both.filter(_within_reach(least)).select("a", "b")


def open_pairs(met: DataFrame, roots: DataFrame, tile: int = TILE, sketch: DataFrame | None = None, least: float = 0.0) -> DataFrame:
    """``a, b``: all pairs of a bucket without its hubs that ``roots`` does not join yet
    and that ``sketch``, if given, does not rule out.

    Lines alike to one hub need not be alike to another, so none of these may be left
    out; pairs within one component change nothing.  A large bucket is cut into tiles
    and compared tile by tile, so no task holds it whole.
    """
    return _tile_pairs(_apart(met, roots, tile), sketch, least)


def _apart(met: DataFrame, roots: DataFrame, tile: int = TILE) -> DataFrame:
    """``band, id, root, tiles, t``: the lines, but for the hubs, of buckets that ``roots`` does not join, in tiles."""
    rest = _with_hubs(met).filter(~F.array_contains("hubs", F.col("id"))).select("band", "id")
    named = staged(rest.join(roots, rest["id"] == roots["node"], "left").select("band", "id", F.coalesce("root", "id").alias("root")))
    sizes = named.groupBy("band").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    mixed = sizes.filter("lo != hi").select("band", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    return staged(named.join(mixed, "band").withColumn("t", F.pmod(F.xxhash64("id"), "tiles").cast("int")))


def _tile_pairs(cut: DataFrame, sketch: DataFrame | None, least: float) -> DataFrame:
    test = F.expr("ra != rb and (i != j or a < b)")
    left = cut.select("band", F.col("t").alias("i"), F.explode(F.sequence("t", F.col("tiles") - 1)).alias("j"), F.col("id").alias("a"), F.col("root").alias("ra"))
    right = cut.select("band", F.explode(F.sequence(F.lit(0), "t")).alias("i"), F.col("t").alias("j"), F.col("id").alias("b"), F.col("root").alias("rb"))
    if sketch is not None:
        left, right = left.join(_sketch_of(sketch, "a"), "a"), right.join(_sketch_of(sketch, "b"), "b")
        test = test & _within_reach(least)
    both = left.hint("merge").join(right.hint("merge"), ["band", "i", "j"]).filter(test)
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def candidates(signed: DataFrame) -> DataFrame:
    """``a, b``: all pairs of lines that share a band; ``groups`` leaves out what it need not compare."""
    met = buckets(signed)
    none = met.sparkSession.createDataFrame([], "node long, root long")
    return hub_pairs(met).union(open_pairs(met, none)).distinct()


def _wanted_lines(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """``id, line`` of the lines in ``pairs``."""
    wanted = staged(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    right = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    return staged(_lines(texts).join(right, "id").groupBy("id", "line").count().select("id", "line"))


def _shingles(line: str) -> Column:
    return F.when(F.length(line) < SHINGLE, F.array(line)).otherwise(
        F.array_distinct(F.regexp_extract_all(line, F.lit(_EVERY), F.lit(1)))
    )


def verified(texts: DataFrame, pairs: DataFrame, least: float, lines: DataFrame | None = None) -> DataFrame:
    """The pairs whose lines have a Jaccard similarity of at least ``least`` over
    all their character shingles (a shorter line is one shingle).  ``lines`` may
    hold the lines of all pairs (``id, line``)."""
    if lines is None:
        pairs = staged(pairs)
        lines = _wanted_lines(texts, pairs)
    joined = pairs.join(lines.select(F.col("id").alias("a"), F.col("line").alias("la")), "a").join(
        lines.select(F.col("id").alias("b"), F.col("line").alias("lb")), "b"
    )

    def alike(x: Column) -> Column:
        both = F.size(F.array_intersect(x["a"], x["b"]))
        return let(both, lambda n: n >= least * (F.size(x["a"]) + F.size(x["b"]) - n))

    # bound to a lambda variable, or each set would be built several times
    return joined.filter(let(F.struct(_shingles("la").alias("a"), _shingles("lb").alias("b")), alike)).select("a", "b")


def groups(texts: DataFrame, signed: DataFrame, least: float) -> DataFrame:
    """``node, root`` of all lines linked with another.

    Lines are first compared with the hubs of their buckets and closed under these
    links; then all pairs of a bucket that are still apart are compared.
    """
    met = buckets(signed)
    pairs = staged(hub_pairs(met))
    lines = _wanted_lines(texts, pairs)  # each line of a bucket is in a pair with a hub
    roots = staged(connected(verified(texts, pairs, least, lines)))
    cut = _apart(met, roots)
    if cut.isEmpty():
        return roots
    # most buckets are joined by now, so few lines need a bitmap
    sketch = sketches(lines.join(cut.select("id").distinct(), "id", "left_semi"))
    more = staged(verified(texts, _tile_pairs(cut, sketch, least), least, lines))
    return roots if more.isEmpty() else _joined(roots, more)


def _joined(roots: DataFrame, more: DataFrame) -> DataFrame:
    """``node, root`` after further links ``a, b``; only the roots they touch are closed again."""

    def named(links: DataFrame, side: str) -> DataFrame:
        of = roots.select(F.col("node").alias(side), F.col("root").alias("r"))
        return links.join(of, side, "left").withColumn(side, F.coalesce("r", side)).drop("r")

    moved = staged(connected(named(named(more, "a"), "b")))
    to = moved.select(F.col("node").alias("root"), F.col("root").alias("to"))
    lone = moved.join(roots.select("node"), "node", "left_anti")
    return roots.join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root")).unionByName(lone)


def _removed(docs: DataFrame, doc_id: str, text: str, keep: list[str], names: list[str], least: float) -> DataFrame:
    """Kept columns with ``ids`` and ``gone``, the sorted numbers of removed lines."""
    rows = staged(docs.select(
        *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{doc_id}`").alias("__doc"),
        F.monotonically_increasing_id().alias("__rid"), line_ids(F.col(f"`{text}`")).alias("ids"),
    ))
    texts = docs.select(F.col(f"`{text}`").alias("text"))
    roots = groups(texts, staged(signatures(texts)), least)
    seen = rows.select(F.posexplode("ids").alias("at", "id"), "__doc", "__rid").filter("id is not null")
    spot = F.struct(F.col("__doc").isNull().alias("no_id"), F.col("__doc").alias("doc"), F.col("__rid").alias("rid"), F.col("at").alias("at"))
    first = seen.groupBy("id").agg(F.min(spot).alias("best"), F.count("*").alias("n"))
    named = staged(first.join(roots, first["id"] == roots["node"], "left").select("id", "best", "n", F.coalesce("root", "id").alias("root")))
    best = named.groupBy("root").agg(F.min("best").alias("best"), F.sum("n").alias("n")).filter("n > 1")
    repeated = named.select("id", "root").join(best, "root").select("id", F.col("best.rid").alias("rid"), F.col("best.at").alias("first"))
    lost = seen.join(repeated, "id").filter("rid != __rid or first != at").groupBy("__rid").agg(F.sort_array(F.collect_list("at")).alias("gone"))
    return rows.join(lost, "__rid", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))


def line_report(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, least: float = 0.8
) -> DataFrame:
    """Columns ``keep`` (all but the text by default) with ``n_lines`` (with a word),
    ``n_removed`` and ``removed`` (numbers of the removed lines, from 0).

    Lines end at ``\\n`` and are compared without their outer white space.  Equal
    lines, and lines whose 5-character shingles have a Jaccard similarity of at
    least ``least`` (found with high recall by 8 bands of 4 of 16 minima, then checked
    exactly), form groups, closed under links; of each group one line stays,
    the first of the row with the smallest id (null ids last, ties by row).
    Lines without a word are never removed.  A null or empty text has no lines.
    Equal rows: the first keeps its lines.  An empty table gives an empty
    result.  Kept columns called like a result get underscores in front until they differ.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    names = kept_names(keep, ("n_lines", "n_removed", "removed", "ids", "gone", "__doc", "__rid"))
    found = _removed(docs, doc_id, text, keep, names, least)
    return found.select(
        *[F.col(f"`{n}`") for n in names], F.size(F.array_compact("ids")).cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_removed"), F.col("gone").alias("removed"),
    )


def without_repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.8, drop_emptied: bool = True
) -> DataFrame:
    """``docs`` with the lines that ``line_report`` removes cut out of the text.

    With ``drop_emptied`` a row that had words and keeps none is left out (all it
    said stands elsewhere); rows that had none stay.  Columns are unchanged, null
    texts stay null.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    found = _removed(docs, doc_id, text, docs.columns, names, least)
    place = names[docs.columns.index(text)]
    gap, = fresh(found, "__lines")
    cut = found.withColumn(gap, F.split(place, "\n"))
    stay = F.array_except(F.sequence(F.lit(0), F.size(gap) - 1), F.col("gone"))
    left = F.array_join(F.transform(stay, lambda i: F.get(gap, i)), "\n")
    whole = F.size(F.array_compact("ids"))
    if drop_emptied:
        cut = cut.filter((whole == 0) | (whole > F.size("gone")))
    text_now = F.when(F.size("gone") == 0, F.col(place)).otherwise(left)
    return cut.select(*[(text_now if n == place else F.col(n)).alias(c) for n, c in zip(names, docs.columns, strict=True)])
