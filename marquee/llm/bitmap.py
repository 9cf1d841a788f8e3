"""A bitmap of key hashes that splits a scan: rows that cannot be members pass by, only possible ones are joined.

The bitmap is built by Spark from the keys' 64-bit hashes, two bits a key, and is
one row of a stated size (``MOST_BITS`` at most), so broadcasting it is bounded
whatever the number of keys. Beyond that size it fills up and more rows take the
exact join, which decides alone; a result never depends on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.scratch import written

#: Bits a key, and the smallest and largest bitmap as powers of two (the largest is 32 MB).
BITS_PER_KEY = 16
LEAST_BITS, MOST_BITS = 13, 28
_ROW_BITS = 1 << 16
_COLUMN = "_bitmap_words"


def _places(h: Column, n_bits: int) -> list[Column]:
    return [h.bitwiseAND(F.lit(n_bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(n_bits - 1))]


def bitmap(hashes: DataFrame, column: str = "h") -> tuple[DataFrame, int]:
    """(one-row table of the bitmap, its number of bits) of a written table's hashes (a long column)."""
    n = hashes.count()
    n_bits = 1 << min(MOST_BITS, max(LEAST_BITS, (BITS_PER_KEY * n).bit_length()))
    marks = hashes.select(F.explode(F.array(*_places(F.col(column), n_bits))).alias("p"))
    words = marks.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b"))
    per_row = min(_ROW_BITS, n_bits) // 64  # words of one piece of the bitmap
    every = hashes.sparkSession.range(n_bits // 64).withColumnRenamed("id", "w")
    dense = every.join(words, "w", "left").select("w", F.coalesce("b", F.lit(0)).alias("b"))
    row = lambda c: F.transform(F.sort_array(F.collect_list(c)), lambda x: x["b"])
    pieces = dense.groupBy(F.floor(F.col("w") / per_row).alias("w")).agg(row(F.struct("w", "b")).alias("b"))
    return written(pieces.agg(F.flatten(row(F.struct("w", "b"))).alias(_COLUMN)), "bitmap"), n_bits


def split(rows: DataFrame, h: Column, bits: DataFrame, n_bits: int) -> tuple[DataFrame, DataFrame]:
    """(possible members, certain non-members) of ``rows``; ``h`` is a row's hash. Two filters over the scan, no shuffle."""
    test = F.lit(True)
    for p in _places(h, n_bits):
        word = F.get(F.col(_COLUMN), F.shiftright(p, 6).cast("int"))
        test = test & (F.getbit(word, p.bitwiseAND(F.lit(63)).cast("int")) == 1)
    return rows.join(F.broadcast(bits), test, "left_semi"), rows.join(F.broadcast(bits), test, "left_anti")
