"""Bloom filter of a key column, as DataFrame operations.

``KeyFilter.of`` sets ``hashes`` bits per key in a bit array of bounded size: keys become bit positions,
positions are combined by ``bit_or`` into 64-bit words (map-side first), words into blocks, blocks into
one array. ``may_hold`` tests a column against that array, which is a scalar subquery: it is computed once and
needs no join, so the test can stand anywhere in a plan, in particular right above a scan and below a
``Generate``. No key of the column is ever missed; of the others about ``(1 - e^(-hashes * keys / bits)) ^
hashes`` pass, which an exact join later takes out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: bits for each key, hash positions of each key
BITS_PER_KEY, HASHES = 10, 3
#: the most bits of a filter (32 MB); beyond 27 million keys more other rows pass, none is lost
MOST_BITS = 1 << 28
#: 64-bit words of a block (2^16 bits)
BLOCK = 1 << 10


def filter_bits(keys: int, bits_per_key: int = BITS_PER_KEY, most: int = MOST_BITS) -> int:
    """Bits for so many keys: whole blocks, at least one."""
    block = BLOCK * 64
    return block * max(1, min(-(-keys * bits_per_key // block), most // block))


def _positions(key: Column, bits: int) -> list[Column]:
    """Bit positions of a key: the two halves of one hash, combined."""
    h = F.xxhash64(key)
    low, high = h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32)
    return [F.pmod(high + low * F.lit(i), F.lit(bits)) for i in range(1, HASHES + 1)]


@dataclass
class KeyFilter:
    """The filter as one row, ``blocks array<array<long>>``, and its size in bits."""

    rows: DataFrame
    bits: int
    key_type: str

    @classmethod
    def of(cls, keys: DataFrame, key: str, count: int, most_bits: int = MOST_BITS) -> "KeyFilter":
        """Filter of the ``count`` keys in column ``key``; nulls are not keys."""
        bits = filter_bits(count, most=most_bits)
        spots = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_positions(F.col(key), bits))).alias("at"))
        word = F.shiftright("at", 6)
        bit = F.expr("shiftleft(1L, CAST(at % 64 AS INT))")
        words = spots.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("set"))
        empty = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("set"))
        block = F.shiftright("word", 10).alias("block")
        blocks = (
            words.unionByName(empty)
            .groupBy("word")
            .agg(F.bit_or("set").alias("set"))
            .groupBy(block)
            .agg(F.array_sort(F.collect_list(F.struct("word", "set"))).alias("words"))
            .select("block", F.col("words.set").alias("words"))
        )
        # one row of at most ``most_bits``
        row = blocks.agg(F.array_sort(F.collect_list(F.struct("block", "words"))).alias("b")).select(F.col("b.words").alias("blocks"))
        return cls(row.checkpoint(), bits, keys.schema[key].dataType.simpleString())

    def may_hold(self, column: str, df: DataFrame) -> Column:
        """False only where the column's value is no key; null is none. A column of another type isn't tested."""
        if df.schema[column].dataType.simpleString() != self.key_type:
            return F.col(column).isNotNull()
        blocks = self.rows.scalar()  # at most ``most_bits``, by way of the driver

        def is_set(at: Column) -> Column:
            block = F.get(blocks, F.shiftright(at, 16).cast("int"))
            word = F.get(block, F.shiftright(at, 6).bitwiseAND(BLOCK - 1).cast("int"))
            return F.call_function("getbit", word, at.bitwiseAND(63).cast("int")) == 1

        found = F.col(column).isNotNull()
        for at in _positions(F.col(column), self.bits):
            found = found & is_set(at)
        return found
