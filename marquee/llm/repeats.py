"""Removal of long repeated byte strings over the whole corpus (suffix-array dedup by sampled suffixes).

A byte goes when a string of ``LENGTH`` bytes that covers it also starts anywhere
else, in the same document or another. Equal strings have the same common prefix
wherever they stand, so the work is the sorting of suffixes by common prefixes;
done for every byte that would move many times the input. As in induced sorting,
only sampled suffixes are sorted, and the rest is induced from them:

1. Sample. Every window of ``LENGTH`` bytes picks the suffix in it whose first
   ``GRAM`` bytes hash lowest. Equal windows pick at the same offset, so they
   meet at their samples; about one suffix in ``(LENGTH - GRAM + 1) / 2`` is taken.
   A sample answers for a run of windows, named by their offsets to it.
2. Sort of the samples by (first ``GRAM`` bytes, whole run) with Spark's external
   sort and aggregation. A gram that occurs once has no repeated window: most of
   a clean corpus ends here. A run that occurs twice is repeated as a whole.
3. Induction. The runs left share a gram but differ further out. They are split by
   offset into blocks of ``BLOCK`` windows and those into single windows. The bytes
   all windows of a block share decide whether any of them can be repeated, the
   bytes of all of them together whether all are; only blocks in between go on.
4. Removal. Intervals of repeated windows meet their text once more.

Bytes are compared by 64-bit hashes of ranges (prefix sums, see ``textnum``) within
a gram's group. Every count is an aggregate with map-side partial sums. Joins back
to a gram that a third of all documents share read written tables, whose plain
exchanges can be split; nothing is compared pair by pair, and a task holds no more
than a piece of text. Texts without a repeated gram pass by in the scan (a bitmap
of the others' keys, see ``bitmap``) and are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import textnum as tn
from marquee.llm.bitmap import bitmap, split
from marquee.llm.passages import packed, shared_passages
from marquee.llm.scratch import any_row, discard, documents, id_and_text, written

LENGTH = 400
GRAM = 200
BLOCK = 16
_SPREAD = LENGTH - GRAM + 1  # samples a window chooses from
_POSITION = np.uint64((1 << 22) - 1)
#: Windows of one long text that are handled at once.
_PIECE = 1 << 20
#: Bytes of shorter texts that are handled at once: their arrays stay in a core's cache.
_GROUP = 1 << 16

_SAMPLES = "k1 long, k2 long, first int, last int, at int, gram long, run long"
_EDGES = "k1 long, k2 long, at int, first int, last int, gram long, run long, bytes binary"


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k1, k2, doc_id, text): 128 hash bits of id and text name a row the same way in every scan; equal rows share a name."""
    d = id_and_text(docs, id_col, text_col)
    return d.select(F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64("text", "doc_id", F.lit(2)).alias("k2"), "doc_id", "text")


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (prefix and suffix minima of blocks)."""
    n = len(x)
    pad = -n % width
    blocks = np.concatenate([x, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    head = np.minimum.accumulate(blocks, axis=1).reshape(-1)[:n]
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)[:n]
    return np.minimum(tail[: n - width + 1], head[width - 1 :])


def samples_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first window, last window, sample, gram hash, run hash) of every run of windows in a piece of text.

    ``ends[p]`` is where p's text ends; windows reaching beyond it do not exist.
    """
    n = len(data)
    if n < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(3)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    p = tn.prefix(data)
    # range_hash of every place
    gram = tn.mix((p[GRAM:] - p[:-GRAM]) * tn.powers(tn._INVERSE, n + 1)[: n - GRAM + 1] + np.uint64(GRAM))
    chosen = (_least((gram & ~_POSITION) | np.arange(len(gram), dtype=np.uint64), _SPREAD) & _POSITION).astype(np.int64)
    window = np.flatnonzero(np.arange(n - LENGTH + 1) + LENGTH <= ends[: n - LENGTH + 1])
    if not len(window):
        return samples_of(data[:0], ends)
    chosen = chosen[window]
    new = np.ones(len(window), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (window[1:] != window[:-1] + 1)
    at = np.flatnonzero(new)
    first, last, sample = window[at], window[np.append(at[1:], len(window)) - 1], chosen[at]
    run = tn.mix(tn.range_hash(p, first, last + LENGTH) + (sample - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return first, last, sample, gram[sample], run


def _pieces(offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(row range, byte range) pieces; a longer text gives several that overlap by a window less one byte."""
    for lo, hi in tn.chunks(offsets, _GROUP):
        a, z = int(offsets[lo]), int(offsets[hi])
        if hi - lo == 1:
            for start in range(a, max(a + 1, z - LENGTH + 1), _PIECE):
                yield lo, hi, start, min(z, start + _PIECE + LENGTH - 1)
        else:
            yield lo, hi, a, z


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = tn.texts_of(batch.column("text"))
        rows, found = [], []
        for _, _, a, z in _pieces(offsets):
            inner = np.clip(offsets, a, z)
            row0 = int(np.searchsorted(offsets, a, side="right")) - 1
            row1 = int(np.searchsorted(offsets, z))
            ends = np.repeat(inner[row0 + 1 : row1 + 1] - a, np.diff(inner[row0 : row1 + 1]))
            first, last, at, gram, run = samples_of(data[a:z], ends)
            row = np.searchsorted(offsets, first + a, side="right") - 1
            base = (offsets[row] - a).astype(np.int64)
            rows.append(row)
            found.append([*((x - base).astype(np.int32) for x in (first, last, at)), gram.view(np.int64), run.view(np.int64)])
        if rows:
            row = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1").take(row), batch.column("k2").take(row), *(pa.array(np.concatenate(x)) for x in zip(*found, strict=True))],
                names=[c.split()[0] for c in _SAMPLES.split(", ")])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs that go to the induction, cut out of their texts."""
    names = [c.split()[0] for c in _EDGES.split(", ")]
    for batch in batches:
        out = [[] for _ in names]
        for k1, k2, text, runs in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "text", "runs")), strict=True):
            raw = text.encode("utf-8")
            for r in runs:
                row = (k1, k2, r["at"], r["first"], r["last"], r["gram"], r["run"], raw[r["first"] : r["last"] + LENGTH])
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            if len(out[0]) > 20_000:
                yield _edges(out, names)
                out = [[] for _ in names]
        yield _edges(out, names)


def _edges(out: list[list], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)


def _split(width: int):
    """Blocks of ``width`` windows of every run (or of its given blocks): shared bytes, all bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram = batch.column("gram").to_numpy().view(np.uint64)
            at, first, last = (batch.column(c).to_numpy().astype(np.int64) for c in ("at", "first", "last"))
            lo, hi = (batch.column(c).to_numpy().astype(np.int64) for c in ("from", "to"))  # offsets asked for
            salt = _salts(batch)
            # offsets of windows to the sample: from the last window's to the first one's
            a, z = np.maximum(lo, at - last), np.minimum(hi, at - first)
            n = np.where(a <= z, z // width - a // width + 1, 0)  # blocks of every run
            data, offsets = tn.texts_of(batch.column("bytes"))
            out = [[], [], [], [], [], []]
            for r0, r1 in tn.chunks(offsets, _GROUP):
                p = tn.prefix(data[offsets[r0] : offsets[r1]])
                k = np.repeat(np.arange(r0, r1), n[r0:r1])
                block = np.arange(len(k)) - np.repeat(np.cumsum(n[r0:r1]) - n[r0:r1], n[r0:r1]) + a[k] // width
                o1, o2 = block * width, block * width + width - 1
                c1, c2 = np.maximum(o1, a[k]), np.minimum(o2, z[k])
                # bytes that all windows of the whole block share, and those of all its windows
                base = (at - first)[k] + offsets[k] - offsets[r0]
                shared = tn.range_hash(p, base - o1, base - o2 + LENGTH)
                whole = (c1 == o1) & (c2 == o2)
                full = tn.range_hash(p, base - c2, base - c1 + LENGTH)
                own = tn.mix(full + salt[k])
                for column, value in zip(out, (k, block.astype(np.int32), tn.mix(shared ^ tn.mix(gram[k] + block.astype(np.uint64))).view(np.int64),
                                               np.where(whole, full, own).view(np.int64), c1.astype(np.int32), c2.astype(np.int32)), strict=True):
                    column.append(value)
            if out[0]:
                k, *made = (pa.array(np.concatenate(x)) for x in out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(k) for c in ("k1", "k2", "at", "first", "last")] + made,
                    names=["k1", "k2", "at", "first", "last", "block", "shared", "all", "c1", "c2"])
    return run


def _salts(batch: pa.RecordBatch) -> np.ndarray:
    """Bits of every run's own name, so that blocks cut short at a run's edge equal no other."""
    low = np.uint64((1 << 63) - 1)
    k1, k2, at = (batch.column(c).to_numpy().astype(np.int64).view(np.uint64) for c in ("k1", "k2", "at"))
    place = at * np.uint64(2654435761) + np.arange(1, len(at) + 1, dtype=np.uint64)
    return (place & low) + ((k1 & low) ^ (k2 & low))


_BLOCKS = "k1 long, k2 long, at int, first int, last int, block int, shared long, all long, c1 int, c2 int"


def repeated_windows(rows: DataFrame, made: list[DataFrame] | None = None) -> DataFrame:
    """(k1, k2, start, stop): byte intervals covered by repeated windows. ``rows`` as ``keyed`` gives them.

    The result reads written tables; they are added to ``made``.
    """
    made = [] if made is None else made

    def kept(df: DataFrame, name: str) -> DataFrame:
        made.append(written(df, name))
        return made[-1]

    texts = rows.select("k1", "k2", "text").where(F.octet_length("text") >= LENGTH)
    samples = kept(texts.mapInArrow(_sample, _SAMPLES), "samples")
    # grams that occur twice or more; all other samples leave here
    again = kept(samples.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram", F.xxhash64("gram").alias("h")), "again")
    possible, _ = split(samples, F.xxhash64("gram"), *bitmap(again))
    live = kept(possible.join(again.select("gram"), "gram", "left_semi"), "live-samples")
    runs = kept(live.groupBy("gram", "run").agg(F.count(F.lit(1)).alias("n"), *any_row("k1", "k2", "at", "first", "last")), "runs")
    several = kept(runs.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("gram"), "several")
    whole = live.join(runs.where("n > 1").select("gram", "run"), ["gram", "run"]).select(
        "k1", "k2", F.col("first").alias("start"), (F.col("last") + LENGTH).alias("stop"))
    # one of each run of a gram that has several runs: its bytes are cut out of its text once
    left = runs.join(several, "gram").select("k1", "k2", F.struct("at", "first", "last", "gram", "run").alias("r"))
    per_text = kept(left.groupBy("k1", "k2").agg(F.collect_list("r").alias("runs")).withColumn("h", F.xxhash64("k1")), "runs-by-text")  # bounded by the text's length
    possible, _ = split(texts, F.xxhash64("k1"), *bitmap(per_text.select("h")))
    cut = possible.join(per_text.drop("h"), ["k1", "k2"]).dropDuplicates(["k1", "k2"])
    edges = kept(cut.mapInArrow(_cut, _EDGES), "edges")
    found = [whole]
    asked = edges.withColumns({"from": F.lit(0), "to": F.lit(LENGTH)})
    one = ("k1", "k2", "at", "first")
    for width in (BLOCK, 1):
        blocks = kept(asked.mapInArrow(_split(width), _BLOCKS), "blocks")
        sums = kept(blocks.groupBy("shared", "all").agg(F.count(F.lit(1)).alias("same"), *(any_row(*one, "c1", "c2") if width > 1 else ())), "block-sums")
        found.append(blocks.join(sums.where("same > 1").select("shared", "all"), ["shared", "all"]).select(
            "k1", "k2", (F.col("at") - F.col("c2")).alias("start"), (F.col("at") - F.col("c1") + LENGTH).alias("stop")))
        if width > 1:
            open_ = sums.groupBy("shared").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("shared")
            ask = sums.join(open_, "shared").select(*one, F.col("c1").alias("from"), F.col("c2").alias("to"))
            asked = edges.join(ask, list(one))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _joined(gone: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, stop, row) of the maximal intervals of every row's packed ones, by row and place."""
    n = np.asarray(gone.value_lengths().fill_null(0)).astype(np.int64)
    both = gone.flatten().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((both, row))
    both, row = both[order], row[order]
    start, stop = both >> 32, both & 0xFFFFFFFF
    reach = np.maximum.accumulate((row << 32) + stop) if len(row) else stop  # of all intervals of the row so far
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] << 32) + start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return start[at], reach[np.append(at, len(row))[1:] - 1] & 0xFFFFFFFF, row[at]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = tn.texts_of(batch.column("text"))
        start, stop, row = _joined(batch.column("gone"))
        bounds = np.searchsorted(row, np.arange(batch.num_rows + 1))
        removed = np.append(0, np.cumsum(stop - start))
        digests = []
        for k in range(batch.num_rows):
            kept, at = hashlib.sha256(), int(offsets[k])
            for j in range(bounds[k], bounds[k + 1]):
                kept.update(data[at : offsets[k] + start[j]])
                at = offsets[k] + stop[j]
            kept.update(data[at : offsets[k + 1]])
            digests.append(kept.hexdigest())
        spans = pa.ListArray.from_arrays(pa.array(2 * bounds, pa.int32()), pa.array(np.stack([start, stop], 1).reshape(-1), pa.int32()))
        also = [c for c in batch.schema.names if c not in ("doc_id", "text", "gone")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed[bounds[1:]] - removed[bounds[:-1]]), pa.array(np.diff(bounds)),
             pa.array(digests, pa.string()), spans, *[batch.column(c) for c in also]],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", *also])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_passages: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, stop, ...): one row per input row.

    ``with_passages`` adds n_passage_words, which tells of passages that may be
    shorter than ``LENGTH`` bytes and stay in the text: words covered by fifty that
    another document has too.
    Edges: a null text is empty; texts shorter than ``LENGTH`` bytes lose
    nothing; rows that repeat, id and text alike, are documents of their own and
    repeat each other; a string may overlap its repeat in the same text; an
    empty table gives an empty result; other columns are ignored.
    """
    rows = keyed(docs, id_col, text_col)
    made: list[DataFrame] = []
    # an interval is one long; their number is bounded by the text's length
    gone = repeated_windows(rows, made).groupBy("k1", "k2").agg(F.collect_set(packed("start", "stop")).alias("gone"))
    if with_passages:
        gone = written(gone, "gone-bytes")
        discard(*made)  # the intervals are written; the samples' tables are the largest of this operator
        gone = gone.join(shared_passages(rows), ["k1", "k2"], "full")
    gone = written(gone.withColumn("h", F.xxhash64("k1")), "gone")
    possible, others = split(rows, F.xxhash64("k1"), *bitmap(gone.select("h")))
    schema = (f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, "
              "kept_sha256 string, spans array<int>")
    words = [F.coalesce("n_passage_words", F.lit(0)).cast("long").alias("n_passage_words")] if with_passages else []
    none = [F.lit(0).cast("long").alias("n_passage_words")] if with_passages else []
    schema += ", n_passage_words long" if with_passages else ""
    hit = possible.join(gone.drop("h"), ["k1", "k2"], "left").select("doc_id", "text", "gone", *words)
    # texts that lose nothing never leave the scan
    whole = others.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"), F.array().cast("array<int>").alias("spans"), *none)
    return hit.mapInArrow(_remove, schema).unionByName(whole)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir, "doc_id", "text"), with_passages=True).drop("spans")
