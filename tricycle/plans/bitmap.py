"""A bitmap of hashed keys, probed where rows are, in front of a shuffle join.

Rows whose key is not among the keys mostly fail the probe and are never shuffled. A row
whose key is there always passes: equal keys have equal hashes. The bitmap is broadcast
as blocks of fixed size, so its size is known from the number of bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Most bits of a bitmap (64 MB), and bits for each key up to there.
BITMAP_BITS = 1 << 29
BITS_PER_KEY = 8
# Where a key would have fewer bits than this, most places are taken and nothing is gained.
LEAST_BITS_PER_KEY = 2
BLOCK_BITS = 32_768  # of a value of bitmap_construct_agg
WORD_BITS = 64
# Never null, and known not to be: else the join would infer that it is not null on the side of
# the keys and push that below the shuffle that makes them, which would then not be shared.
_BLOCK = "coalesce(bitmap_bucket_number(place), 0L)"


def bits_for(n_keys: int, most: int = BITMAP_BITS) -> int:
    """How many bits to use for up to ``n_keys`` keys: a power of two, whole blocks, at most
    ``most``; 0 where that is too few to be of use.
    """
    wanted = max(BLOCK_BITS, 1 << (BITS_PER_KEY * n_keys - 1).bit_length())
    bits = min(wanted, most // BLOCK_BITS * BLOCK_BITS)
    return bits if bits >= LEAST_BITS_PER_KEY * n_keys else 0


def key_bitmap(keys: DataFrame, columns: list[str], bits: int) -> DataFrame:
    """``(block, words)``: the places of the keys, 64 to a LONG.

    Places are shuffled, not partial bitmaps: a task's keys touch most blocks, and a block of
    4 KB for each is more than the keys themselves.
    """
    words = (
        f"transform(sequence(0, {BLOCK_BITS // WORD_BITS - 1}),"
        " w -> cast(conv(hex(substr(bitmap, w * 8 + 1, 8)), 16, -10) AS LONG))"
    )
    return (
        keys.selectExpr(f"{_place(columns, bits)} AS place")
        .selectExpr(f"{_BLOCK} AS block", "bitmap_bit_position(place) AS position")
        .repartition("block")
        .groupBy("block")
        .agg(F.expr("bitmap_construct_agg(position) AS bitmap"))
        .selectExpr("block", f"{words} AS words")
    )


def maybe_among(rows: DataFrame, columns: list[str], bitmap: DataFrame, bits: int) -> DataFrame:
    """The rows whose key may be among the keys of ``bitmap``: all that are, and of the
    others as large a share as the bitmap has places taken. Keys have no nulls.
    """
    probed = rows.selectExpr("*", f"{_place(columns, bits)} AS place").selectExpr(
        *rows.columns, f"{_BLOCK} AS block", "int(bitmap_bit_position(place)) AS position"
    )
    # The first of a word's eight bytes is its highest.
    bit = f"(7 - position % {WORD_BITS} div 8) * 8 + position % 8"
    found = f"getbit(words[int(position div {WORD_BITS})], int({bit})) = 1"
    return probed.join(F.broadcast(bitmap), "block").where(found).select(rows.columns)


def _place(columns: list[str], bits: int) -> str:
    return f"pmod(xxhash64({', '.join(columns)}), {bits}L) + 1"
