"""A Bloom filter of fixed size as a table, made of built-in expressions.

The filter is a table of blocks, each an array of 64 words of 64 bits. A key has one block and sets a few of its bits,
so a lookup is a join with one row of a table that never has more than ``BLOCKS`` rows, whatever the number of
keys; it is always small enough to broadcast. Blocks are put together in tasks, by a bitwise or that is combined before
it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: blocks of 512 bytes; 64 MB in all
BLOCKS = 131_072
WORDS = 64
BITS_PER_KEY = 4


def block_of(place: Column) -> Column:
    """The block of keys that have this ``place``."""
    return F.pmod(F.xxhash64(place), F.lit(BLOCKS)).cast("int")


def _bits(place: Column, detail: Column) -> list[tuple[Column, Column]]:
    """Word and bit, in its block, of each hash of a key."""
    spots = [F.xxhash64(place, detail, F.lit(i)) for i in range(BITS_PER_KEY)]
    return [(F.pmod(s, F.lit(WORDS)).cast("int"), F.pmod(F.shiftright(s, 8), F.lit(64)).cast("int")) for s in spots]


def bloom_filter(keys: DataFrame, place: str, detail: str) -> DataFrame:
    """``(block, words)`` over the keys, each made of a ``place``, which names its block, and a ``detail``."""
    spots = F.array(
        *[F.struct(w.alias("word"), b.alias("bit")) for w, b in _bits(F.col(place), F.col(detail))]
    )
    words = (
        keys.select(block_of(F.col(place)).alias("block"), F.inline(spots))
        .groupBy("block", "word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    )
    found = words.groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("found")
    )
    every = F.sequence(F.lit(0), F.lit(WORDS - 1))
    return found.select(
        "block", F.transform(every, lambda w: F.coalesce(F.try_element_at("found", w), F.lit(0).cast("bigint"))).alias("words")
    )


def might_contain(words: Column, place: Column, detail: Column) -> Column:
    """Whether a key can be in the filter, given the ``words`` of its block. Never false for a key that is."""
    hit = F.lit(True)
    for word, bit in _bits(place, detail):
        hit = hit & (F.getbit(F.get(words, word), bit) == 1)
    return hit
