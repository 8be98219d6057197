"""Bitmaps of hashed keys: what was put in is found, other keys now and then.

They let most rows pass by a join untouched.  A bitmap is bounded whatever it holds;
with more keys it only lets more rows through, so no result depends on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_KEY = 16
MOST_BITS = 1 << 27
WORD_BITS = 1 << 24
_PART = 32_768  # bits of one value of bitmap_construct_agg


def _bits(n: int, most: int) -> int:
    bits = _PART
    while bits < min(BITS_PER_KEY * n, most):
        bits *= 2
    return bits


def crc_bitmap(hashes: DataFrame, most_bits: int = MOST_BITS) -> bytes:
    """Bitmap of the CRC-32 values in the column ``crc``, for Python tasks (16 MB at most)."""
    bits = _bits(hashes.count(), most_bits)
    place = F.col("crc").bitwiseAND(bits - 1)
    parts = (
        hashes.select(F.shiftright(place, 15).alias("part"), (place % _PART).alias("place"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("place").alias("bits"))
        .collect()
    )
    out = bytearray(bits // 8)
    for r in parts:
        first = r["part"] * (_PART // 8)
        out[first : first + _PART // 8] = r["bits"]
    return bytes(out)


def word_bitmap(words: DataFrame, most_bits: int = MOST_BITS) -> bytes:
    """``crc_bitmap`` of the column ``word``."""
    return crc_bitmap(words.select(F.crc32(F.encode("word", "utf-8")).alias("crc")), most_bits)


def in_bitmap(bitmap: bytes, crc: int) -> bool:
    place = crc & (len(bitmap) * 8 - 1)
    return bool(bitmap[place >> 3] >> (place & 7) & 1)


def key_test(keys: DataFrame, name: str, most_bits: int = WORD_BITS) -> "callable":
    """A test of a column against the keys in column ``name`` of ``keys``.

    The bitmap is a scalar subquery: one array of at most 2 MB, sent once with the task.
    """
    bits = _bits(keys.count(), most_bits)
    spark = keys.sparkSession

    def place(key: Column) -> Column:
        return F.xxhash64(key).bitwiseAND(bits - 1)

    at = place(F.col(name))
    words = keys.select(
        F.shiftright(at, 6).alias("i"),
        F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int")).alias("w"),
    ).groupBy("i").agg(F.bit_or("w").alias("w"))
    dense = spark.range(bits // 64).toDF("i").join(words, "i", "left")
    row = dense.agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce("w", F.lit(0).cast("long")).alias("w")))).alias("a"))
    bitmap = row.select(F.col("a.w").alias("w")).scalar()

    def test(key: Column) -> Column:
        slot = place(key)
        word = F.get(bitmap, F.shiftright(slot, 6).cast("int"))
        return F.coalesce(F.getbit(word, (slot % 64).cast("int")) == 1, F.lit(False)) & key.isNotNull()

    return test
