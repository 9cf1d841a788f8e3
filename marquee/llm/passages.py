"""Passages of fifty words that stand in more than one document (an addition to the removal of repeated bytes).

A passage of fifty words may be shorter than the byte length that ``repeats``
removes; it is counted here and left in the text. Words are compared lower-cased,
whatever white space stands between them.

Every window of ``WORDS`` words picks the ``GRAM`` words in it whose hash is lowest,
so equal windows pick the same gram; about one gram in thirteen words is picked.
Grams picked in one document only end here. A second scan looks up the others
in a bitmap of bounded size and hands on the runs of windows that picked them. A
run that two documents have is shared as a whole; only where a gram stands in
different runs are single windows compared, one copy of each run. So the many
copies of a text cost a row a run, not a row a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm import textnum as tn
from marquee.llm.bitmap import bitmap, split
from marquee.llm.ngram_join import GROUP_BYTES, GROUP_ROWS, _pieces
from marquee.llm.scratch import any_row, written

WORDS = 50
GRAM = 25
#: Windows handled at once; a place among them has 22 bits.
_WINDOWS = 1 << 20
_PLACE = np.uint64((1 << 22) - 1)


def packed(first: str, last: str) -> Column:
    """Two places of a text as one long that sorts by the first: sets and sorts of longs are cheaper than those of structs."""
    return F.shiftleft(F.col(first).cast("long"), 32).bitwiseOR(F.col(last).cast("long"))


def least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def picked(word: np.ndarray, bounds: np.ndarray, start: int, words: int, gram: int, hashed: bool = True) -> tuple[np.ndarray, ...]:
    """(window, its row, place and hash of the gram it picks, hash of the window where asked for) for windows from ``start`` on, ``_WINDOWS`` at most."""
    none = *(np.zeros(0, np.int64) for _ in range(3)), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    part = word[start : start + _WINDOWS + words - 1]
    n = len(part)
    if n < words:
        return none
    p = np.zeros(n + 1, np.uint64)
    np.cumsum(part * tn.powers(tn._BASE, n), dtype=np.uint64, out=p[1:])
    back = tn.powers(tn._INVERSE, n)
    grams = tn.mix((p[gram:] - p[:-gram]) * back[: n - gram + 1])
    window = np.arange(n - words + 1)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(np.clip(bounds, start, start + len(window))))
    inside = window + start + words <= bounds[row + 1]
    window, row = window[inside], row[inside]
    place = np.arange(len(grams), dtype=np.uint64)
    chosen = (least((grams & ~_PLACE) | place, words - gram + 1)[window] & _PLACE).astype(np.int64)
    hashes = tn.mix((p[window + words] - p[window]) * back[window]) if hashed else None
    return window + start, row, chosen, grams[chosen], hashes


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    data, offsets = tn.texts_of(batch.column("text"))
    for lo, hi in tn.chunks(offsets, GROUP_BYTES, GROUP_ROWS):
        word, bounds = _pieces(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        yield lo, word, bounds


def _grams(words: int, gram: int):
    """The picked grams of every text, once a text (of very long ones, once a piece)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, word, bounds in _groups(batch):
                for start in range(0, max(1, len(word)), _WINDOWS):
                    _, row, place, g, _ = picked(word, bounds, start, words, gram, hashed=False)
                    if len(g):
                        # neighbours mostly pick at one place
                        new = np.append(True, (place[1:] != place[:-1]) | (row[1:] != row[:-1]))
                        g, row = g[new], row[new]
                        order = np.lexsort((g, row))
                        g, row = g[order], row[order]
                        new = np.append(True, (g[1:] != g[:-1]) | (row[1:] != row[:-1]))
                        yield pa.RecordBatch.from_arrays([pa.array(g[new].view(np.int64))], names=["gram"])
    return run


def _runs(bits, n_bits: int, words: int, gram: int):
    """(gram, run, k1, k2, first, last, w) of the runs of windows whose gram the bitmap may hold; ``w`` are their windows' hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have, mask = bits.value, np.uint64(n_bits - 1)

        def held(p: np.ndarray) -> np.ndarray:
            return (have[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) == 1

        for batch in batches:
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            for lo, word, bounds in _groups(batch):
                for start in range(0, max(1, len(word)), _WINDOWS):
                    at, row, place, g, w = picked(word, bounds, start, words, gram)
                    hit = np.flatnonzero(held(g & mask))
                    hit = hit[held((g[hit] >> np.uint64(32)) & mask)]
                    if not len(hit):
                        continue
                    at, row, place, g, w = at[hit], row[hit], place[hit], g[hit], w[hit]
                    new = np.append(True, (place[1:] != place[:-1]) | (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1))
                    begin = np.flatnonzero(new)
                    end = np.append(begin[1:], len(at)) - 1
                    # a run's hash is that of its first and last window and its length: both hold the gram, so they hold all its words
                    name = tn.mix(w[begin] + tn.mix(w[end] + (end - begin).astype(np.uint64)))
                    own, base = lo + row[begin], bounds[row[begin]]
                    lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(at)).astype(np.int32)), pa.array(w.view(np.int64)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(g[begin].view(np.int64)), pa.array(name.view(np.int64)), pa.array(k1[own]), pa.array(k2[own]),
                         pa.array((at[begin] - base).astype(np.int32)), pa.array((at[end] - base).astype(np.int32)), lists],
                        names=["gram", "run", "k1", "k2", "first", "last", "w"])
    return run


_RUNS = "gram long, run long, k1 long, k2 long, first int, last int, w array<long>"


def shared_passages(rows: DataFrame, words: int = WORDS, gram: int = GRAM) -> DataFrame:
    """(k1, k2, n_passage_words): words of a text that a window of ``words`` words covers which another text's row has too.

    ``rows``: k1, k2 (a row's name, see ``repeats.keyed``), text. Rows without such
    a window are left out; rows equal in id and text have one name and are one document here.
    """
    spark = rows.sparkSession
    texts = rows.select("k1", "k2", "text").where(F.octet_length("text") >= 2 * words - 1)
    # of two texts or more, or of two pieces of one: the latter are told apart below
    grams = texts.select("text").mapInArrow(_grams(words, gram), "gram long").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    kept, n_bits = bitmap(written(grams.select("gram"), "passage-grams"), "gram")
    values = kept.toArrow().column(0).combine_chunks().flatten().to_numpy().view(np.uint64)
    sent = spark.sparkContext.broadcast(values)  # of the bitmap's fixed size
    seen = written(texts.mapInArrow(_runs(sent, n_bits, words, gram), _RUNS), "passage-runs")
    # every run with the least and greatest of its documents, and one place to read its windows from
    one = ("k1", "k2", "first")
    known = written(seen.groupBy("gram", "run").agg(
        F.min("k1").alias("lo"), F.max("k1").alias("hi"), *any_row(*one)), "passage-known")
    whole = seen.join(known.where("lo <> hi").select("gram", "run"), ["gram", "run"]).select("k1", "k2", "first", "last")
    # grams that stand in several runs, of which one is not shared as a whole
    mixed = written(known.groupBy("gram").agg(F.count(F.lit(1)).alias("m"), F.count_if(F.col("lo") == F.col("hi")).alias("single")).where(
        "m > 1 and single > 0").select("gram", F.xxhash64("gram").alias("h")), "passage-mixed")
    possible, _ = split(seen, F.xxhash64("gram"), *bitmap(mixed.select("h")))
    open_known = known.join(mixed.select("gram"), "gram")
    open_runs = written(possible.join(open_known.select("gram", "run", "lo", "hi", *(F.col(c).alias(f"one_{c}") for c in one)), ["gram", "run"]), "passage-open")
    copies = open_runs.where(F.struct(*one) == F.struct(*(f"one_{c}" for c in one))).dropDuplicates(["gram", "run"])
    shared = copies.select(F.explode("w").alias("w"), "lo", "hi").groupBy("w").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi")
    alone = open_runs.where("lo = hi").select("k1", "k2", "first", F.posexplode("w").alias("i", "w"))
    parts = alone.join(shared.select("w"), "w").select("k1", "k2", (F.col("first") + F.col("i")).alias("first"), (F.col("first") + F.col("i")).alias("last"))
    at = F.sort_array(F.collect_set(packed("first", "last")))  # places in one text
    begin = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    stop = lambda x: x.bitwiseAND(F.lit((1 << 32) - 1)) + F.lit(words)
    covered = F.aggregate(at, begin, lambda s, x: F.struct(
        (s["n"] + F.greatest(F.lit(0), stop(x) - F.greatest(s["end"], F.shiftright(x, 32)))).alias("n"),
        F.greatest(s["end"], stop(x)).alias("end")), lambda s: s["n"])
    return whole.unionByName(parts).groupBy("k1", "k2").agg(covered.cast("long").alias("n_passage_words"))
