"""Entity pairs within a window, and the risk level of each pair."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from veilspark import constants as K
from veilspark.functions.arrays import let, lookup
from veilspark.functions.spans import blocks, piece

TILE = 32
ENTITY_FIELDS = ["text", "label", "type", "start", "end", "confidence", "method"]


def pair_in(type1: Column, type2: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Is the unordered type pair one of ``pairs``?"""
    known = ["|".join(sorted(p)) for p in pairs]
    return F.concat_ws("|", F.least(type1, type2), F.greatest(type1, type2)).isin(known)


_CODES = {t: 1 << i for i, t in enumerate(sorted({t for p in K.HIGH_RISK_PAIRS for t in p}))}


def type_code(type_: Column) -> Column:
    """One bit per type that occurs in a pair rule, 0 for all others.

    Taken once per entity, so that the test of a pair is one integer operation.
    """
    return lookup(_CODES, type_, 0)


def codes_in(code1: Column, code2: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """``pair_in`` on codes."""
    return code1.bitwiseOR(code2).isin([_CODES[a] | _CODES[b] for a, b in pairs])


def pair_risk(hot: Column, distance: Column, window: int) -> Column:
    """Level of a pair; ``hot`` says that its types form a high-risk combination."""
    return (
        F.when(hot, F.lit("high"))
        .when(distance < window // 2, F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def _rebased(e: Column) -> Column:
    """The entity as a struct with offsets on the chosen basis."""
    shift = e["base"]
    fields = {n: e[n] for n in ENTITY_FIELDS}
    fields["start"], fields["end"] = e["start"] + shift, e["end"] + shift
    return F.struct(*[fields[n].alias(n) for n in ENTITY_FIELDS])


def tiled_pairs(items: Column, window: int, pair: Callable[[Column, Column], Column]) -> Column:
    """``pair(a, b)`` of all items, sorted by their field ``at``, that lie within the window.

    The items are cut into tiles; a tile is only compared with the tiles that begin up
    to its last place plus the window, so the work grows with the number of pairs and
    not with the square of the items.  Tiles give places only, as what a nested function
    returns is copied once a level; the pairs are made of them at the end.
    """

    def tile_pairs(items: Column, starts: Column, begin: Column) -> Column:
        def against(head: Column) -> Column:
            limit = F.element_at(head, -1)["at"] + window
            reach = F.size(F.filter(starts, lambda s: s <= limit)) * TILE
            near = F.slice(items, begin + 1, reach - begin)
            return let(
                F.transform(near, lambda b: b["at"]),
                lambda cand: F.flatten(
                    F.transform(
                        head,
                        lambda a, i: F.transform(
                            F.filter(
                                F.sequence(i + 1, F.greatest(F.size(cand) - 1, i + 1)),
                                lambda j: F.get(cand, j) - a["at"] <= window,
                            ),
                            lambda j: F.struct((begin + i).alias("a"), (begin + j).alias("b")),
                        ),
                    )
                ),
            )

        return let(F.slice(items, begin + 1, F.lit(TILE)), against)

    def all_tiles(items: Column) -> Column:
        begins = F.sequence(F.lit(0), F.size(items) - 1, F.lit(TILE))
        starts = F.transform(begins, lambda b: F.get(items, b)["at"])
        places = let(
            starts,
            lambda s: F.flatten(F.transform(begins, lambda b: tile_pairs(items, s, b))),
        )
        return F.transform(
            places, lambda p: let(F.get(items, p["a"]), lambda a: let(F.get(items, p["b"]), lambda b: pair(a, b)))
        )

    return let(items, all_tiles)


def window_pairs(
    entities: Column, window: int, row_text: Column | None = None, with_entities: bool = True
) -> Column:
    """All pairs with ``|start1 - start2| <= window`` of one row, as an array.

    With ``row_text`` each pair also gets the text between its two entities, cut
    from a snippet of at most ``window`` characters kept per entity.  Without its
    entities a pair names them by their places; ``spelled_out`` puts them in.
    """
    with_text = row_text is not None

    def item(e: Column, ord_: Column, text: Column | None) -> Column:
        parts = [
            (e["start"] + e["base"]).alias("at"),
            ord_.alias("ord"),
            (_rebased(e) if with_entities else F.struct((e["end"] + e["base"]).alias("end"))).alias("e"),
            type_code(e["type"]).alias("code"),
        ]
        if with_text:
            parts.append(piece(text, e["end"] + e["base"], F.lit(window)).alias("after"))
        return F.struct(*parts)

    def pair(a: Column, b: Column) -> Column:
        first = a["ord"] < b["ord"]
        lo, hi = F.when(first, a["e"]).otherwise(b["e"]), F.when(first, b["e"]).otherwise(a["e"])
        parts = [
            F.least(a["ord"], b["ord"]).alias("ord1"),
            F.greatest(a["ord"], b["ord"]).alias("ord2"),
            *([lo.alias("e1"), hi.alias("e2")] if with_entities else []),
            (b["at"] - a["at"]).alias("distance"),
            codes_in(a["code"], b["code"], K.HIGH_RISK_PAIRS).alias("hot"),
        ]
        if with_text:
            ends_first = a["e"]["end"] <= b["e"]["end"]
            after = F.when(ends_first, a["after"]).otherwise(b["after"])
            room = b["at"] - F.least(a["e"]["end"], b["e"]["end"])
            parts.append(
                F.substring(after, F.lit(1), F.greatest(room, F.lit(0))).alias("text_between")
            )
        return F.struct(*parts)

    if with_text:
        located = let(
            blocks(row_text),
            lambda parts: F.transform(entities, lambda e, i: item(e, i, parts)),
        )
    else:
        located = F.transform(entities, lambda e, i: item(e, i, None))
    return F.when(F.size(entities) > 1, tiled_pairs(F.array_sort(located), window, pair))


def relations(rows: DataFrame, window: int = K.WINDOW) -> DataFrame:
    """One row per entity pair within the window (map-only)."""
    pairs = window_pairs(F.col("entities"), window, F.col("row_text"))
    return rows.select("row_id", F.inline(pairs)).drop("hot")


def spelled_out(rows: DataFrame) -> DataFrame:
    """``relations`` of rows whose ``pairs`` were made without their entities."""
    found = rows.select("row_id", "entities", F.inline("pairs"))
    return found.select(
        "row_id", "ord1", "ord2",
        *[_rebased(F.get("entities", F.col(f"ord{i}"))).alias(f"e{i}") for i in (1, 2)],
        "distance", "text_between",
    )


def band_pairs(detections: DataFrame, window: int = K.WINDOW) -> DataFrame:
    """The same pairs from a plain detection table, by a bucketed self join.

    For detections that come from elsewhere.  Both sides share the equi key
    (row, bucket), so one row with very many entities spreads over its buckets.
    Both are shuffled: a scan says little of how much is detected in it, and a side
    taken for small by the size of its scan would go whole through the driver.
    """
    width = window + 1
    bucket = F.floor(F.col("start") / width).cast("long")
    slim = detections.select("row_id", "ent_ord", "type", "start", "end")
    left = slim.select(
        "row_id",
        F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("bucket"),
        F.col("ent_ord").alias("ord1"),
        F.col("type").alias("type1"),
        F.col("start").alias("start1"),
    )
    right = slim.select(
        "row_id",
        bucket.alias("bucket"),
        F.col("ent_ord").alias("ord2"),
        F.col("type").alias("type2"),
        F.col("start").alias("start2"),
    )
    distance = F.abs(F.col("start1") - F.col("start2"))
    return (
        left.hint("merge").join(right.hint("merge"), ["row_id", "bucket"])
        .filter((F.col("ord1") < F.col("ord2")) & (distance <= window))
        .select("row_id", "ord1", "ord2", "type1", "type2", distance.alias("distance"))
    )


def assess(pairs: DataFrame, window: int = K.WINDOW) -> DataFrame:
    """Risk level and reason of each pair; accepts ``relations``, ``spelled_out`` or ``band_pairs``."""
    if "e1" in pairs.columns:
        pairs = pairs.select(
            "row_id", "ord1", "ord2",
            F.col("e1.type").alias("type1"), F.col("e2.type").alias("type2"), "distance",
        )
    known = pairs.filter(F.col("type1").isNotNull() & F.col("type2").isNotNull())
    return known.select(
        "row_id", "ord1", "ord2", "type1", "type2", "distance",
        pair_risk(
            pair_in(F.col("type1"), F.col("type2"), K.HIGH_RISK_PAIRS), F.col("distance"), window
        ).alias("risk_level"),
        F.concat(F.lit("Proximity of "), "type1", F.lit(" and "), "type2").alias("reason"),
    )
