"""Toxicity scores by a factorization machine over hashed terms.

A document is the set of its hashed terms: every word, and the first bytes of
every word, so inflected forms share a term. The machine scores
``b + sum(w_i) + sum(<v_i, v_j>)`` over the terms present: besides one weight a
term it learns a weight for every pair through short factor vectors, so two
terms that are harmless alone can weigh together.

It is fitted in numpy on a bounded sample of labelled rows (``MAX_ROWS`` a class,
chosen by a hash of the id). Terms enter by either of two screens: how unevenly
the classes hold the term, or how unevenly they hold it close to another word, more
so than either of the two alone; so words that are harmless by themselves enter
with their partners, and the machine learns what their pairs weigh. Other terms
carry no weight. Pairs are counted by Spark. Scoring reads every whole text in
one pass, without a shuffle; the fitted model has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import textnum as tn
from marquee.llm.scratch import documents, id_and_text, written
from marquee.sources.tables import table

#: Labelled rows used for fitting, of each class at most.
MAX_ROWS = 4_000
#: Hashed term space, terms kept by the screen, factors of a term.
DIMENSIONS = 1 << 18
KEPT_TERMS = 2_048
#: Pairs of words that bring their terms in, and how far apart their words may stand.
KEPT_PAIRS = 512
NEAR = 8
#: Rows of the sample that a screened term or pair occurs in, at least.
SUPPORT = 3
FACTORS = 4
#: First bytes of a word that make terms of their own.
PREFIXES = (4, 6, 8)
STEPS = 200
THRESHOLD = 0.3


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(term, row) of every word and word beginning, not distinct."""
    data = tn._LOWER[data]
    start, end = tn.spans(data, offsets)
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    p = tn.prefix(data)
    row = np.searchsorted(offsets, start, side="right") - 1
    found = [tn.range_hash(p, start, end)]
    found += [tn.mix(tn.range_hash(p, start, np.minimum(start + k, end)) + np.uint64(k)) for k in PREFIXES]
    mask = np.uint64(DIMENSIONS - 1)
    return np.concatenate([(h & mask).astype(np.int64) for h in found]), np.concatenate([row] * len(found))


def _term_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = tn.texts_of(batch.column("text"))
        sets = []
        for lo, hi in tn.chunks(offsets):
            term, row = terms(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            pairs = np.unique(row * DIMENSIONS + term)
            cut = np.searchsorted(pairs, np.arange(hi - lo + 1) * DIMENSIONS)
            sets += [(pairs[cut[k] : cut[k + 1]] % DIMENSIONS).astype("<i4").tobytes() for k in range(hi - lo)]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(sets, pa.binary())], names=["label", "terms"])


def _near_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, a, b): documents of class 1 and 0 that hold both words less than ``NEAR`` words apart; a pair is two terms, the smaller first."""
    for batch in batches:
        data, offsets = tn.texts_of(batch.column("text"))
        label = batch.column("label").to_numpy()
        for lo, hi in tn.chunks(offsets, rows=1 << 12):
            h, _, bounds = tn.words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            term = (h & np.uint64(DIMENSIONS - 1)).astype(np.int64)
            row = np.repeat(np.arange(hi - lo), np.diff(bounds))
            found = []
            for k in range(1, NEAR):
                x, y = term[:-k], term[k:]
                use = (row[:-k] == row[k:]) & (x != y)
                found.append((row[:-k][use] << 36) | (np.minimum(x, y)[use] << 18) | np.maximum(x, y)[use])
            once = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
            toxic = label[lo:hi][once >> 36] == 1
            pair, at = np.unique(once & ((1 << 36) - 1), return_inverse=True)
            if len(pair):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair), *[pa.array(np.bincount(at, weights=w, minlength=len(pair)).astype(np.int64)) for w in (toxic, ~toxic)]],
                    names=["pair", "a", "b"])


def unevenness(a, b, pos: int, neg: int):
    """Log odds of occurring in class 1 against class 0 over their standard error; zero below ``SUPPORT`` documents."""
    pa_, pb = (a + 0.5) / (pos + 1), (b + 0.5) / (neg + 1)
    z = (np.log(pa_ / (1 - pa_)) - np.log(pb / (1 - pb))) / np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    return np.where(a + b < SUPPORT, 0, z)


def pair_terms(sample: DataFrame, z: np.ndarray, pos: int, neg: int) -> np.ndarray:
    """Terms of the ``KEPT_PAIRS`` most uneven pairs that tell more than either word alone; only those pairs reach the driver."""
    counts = sample.mapInArrow(_near_pairs, "pair long, a long, b long").groupBy("pair").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    odds = lambda c, n: F.log((F.col(c) + 0.5) / (n + 0.5 - F.col(c)))
    uneven = F.abs(odds("a", pos) - odds("b", neg)) / F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    pairs = counts.where(F.col("a") + F.col("b") >= SUPPORT).select("pair", uneven.alias("z"))
    known = np.flatnonzero(z)
    single = sample.sparkSession.createDataFrame(pd.DataFrame({"term": known, "own": np.abs(z[known])}), "term long, own double")  # DIMENSIONS rows at most
    for side, name in ((F.shiftright("pair", 18), "first"), (F.col("pair").bitwiseAND(F.lit(DIMENSIONS - 1)), "second")):
        pairs = pairs.withColumn(name, side).join(F.broadcast(single.withColumnsRenamed({"term": name, "own": f"own_{name}"})), name, "left")
    alone = F.greatest(F.coalesce("own_first", F.lit(0.0)), F.coalesce("own_second", F.lit(0.0)))
    top = pairs.where(F.col("z") > alone + 1).orderBy(F.desc("z"), "pair").limit(KEPT_PAIRS).select("first", "second").collect()
    return np.unique(np.array([t for r in top for t in r], np.int64))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(label, text) of at most ``max_rows`` labelled documents a class; their ids are the only thing broadcast."""
    lab = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    sample = None
    for c in (0, 1):
        one = lab.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
        sample = one if sample is None else sample.unionByName(one)
    rows = docs.join(F.broadcast(sample), "doc_id").select("doc_id", F.col("label").cast("int").alias("label"), "text")
    # an id that many rows share is one row of the sample: its smallest text, found by partial aggregation
    return rows.groupBy("doc_id").agg(F.min(F.struct("text", "label")).alias("r")).select("r.label", "r.text")


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> dict:
    """The model as plain arrays: kept terms, weights, factors, bias. ``docs``: doc_id, text; ``labels``: doc_id, label (0/1)."""
    counts = {r["label"]: r["n"] for r in labels.where("label is not null").groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = written(training_rows(docs, labels, max_rows), "toxic-sample")
    rows = sample.mapInArrow(_term_sets, "label int, terms binary").collect()
    rows.sort(key=lambda r: (r["label"], r["terms"]))  # the same order on every run
    y = np.array([r["label"] for r in rows], np.float64)
    total = max(1, sum(counts.values()))
    rate = (counts.get(1, 0) + 0.5) / (total + 1.0)
    if not (y == 1).any() or not (y == 0).any():
        return {"terms": np.zeros(0, np.int64), "w": np.zeros(0), "v": np.zeros((0, FACTORS)), "b": float(np.log(rate / (1 - rate)))}
    sets = [np.frombuffer(r["terms"], "<i4") for r in rows]
    at = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets).astype(np.int64)
    pos, neg = (y == 1).sum(), (y == 0).sum()
    a = np.bincount(flat[y[at] == 1], minlength=DIMENSIONS)
    b = np.bincount(flat[y[at] == 0], minlength=DIMENSIONS)
    z = unevenness(a, b, pos, neg)
    kept = np.union1d(np.argsort(-np.abs(z), kind="stable")[:KEPT_TERMS], pair_terms(sample, z, int(pos), int(neg)))
    slot = np.full(DIMENSIONS, -1)
    slot[kept] = np.arange(len(kept))
    use = slot[flat] >= 0
    weight = np.where(y == 1, rate / pos, (1 - rate) / neg)  # classes weigh as in all labelled rows
    w, v, bias = train(at[use], slot[flat[use]], y, weight / weight.sum(), len(kept), np.log(rate / (1 - rate)))
    return {"terms": kept, "w": w, "v": v, "b": bias}


def scores(row: np.ndarray, term: np.ndarray, n: int, w: np.ndarray, v: np.ndarray, b: float) -> tuple[np.ndarray, np.ndarray]:
    """(score before the sigmoid, factor sums) of n rows from their (row, term) pairs."""
    sums = np.stack([np.bincount(row, v[term, f], n) for f in range(v.shape[1])], 1) if len(row) else np.zeros((n, v.shape[1]))
    squares = np.bincount(row, (v[term] ** 2).sum(1), n) if len(row) else np.zeros(n)
    line = np.bincount(row, w[term], n) if len(row) else np.zeros(n)
    return b + line + 0.5 * ((sums**2).sum(1) - squares), sums


def train(row, term, y, weight, n_terms, bias, steps: int = STEPS, seed: int = 6):
    """Full-batch Adam on weighted log loss with shrinkage; deterministic."""
    rng = np.random.default_rng(seed)
    w, v, b = np.zeros(n_terms), rng.normal(0, 0.02, (n_terms, FACTORS)), float(bias)
    moments = [[np.zeros_like(w), np.zeros_like(w)], [np.zeros_like(v), np.zeros_like(v)], [0.0, 0.0]]
    for t in range(1, steps + 1):
        s, sums = scores(row, term, len(y), w, v, b)
        g = weight * (1 / (1 + np.exp(-np.clip(s, -40, 40))) - y)
        gr = g[row]
        grads = [np.bincount(term, gr, n_terms) + 1e-5 * w,
                 np.stack([np.bincount(term, gr * (sums[row, f] - v[term, f]), n_terms) for f in range(FACTORS)], 1) + 1e-4 * v, g.sum()]
        new = []
        for x, d, m in zip((w, v, b), grads, moments, strict=True):
            m[0], m[1] = 0.9 * m[0] + 0.1 * d, 0.999 * m[1] + 0.001 * d * d
            new.append(x - 0.05 * (m[0] / (1 - 0.9**t)) / (np.sqrt(m[1] / (1 - 0.999**t)) + 1e-8))
        w, v, b = new
    return w, v, float(b)


def _score(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = np.full(DIMENSIONS, -1, np.int32)
        slot[model["terms"]] = np.arange(len(model["terms"]))
        for batch in batches:
            data, offsets = tn.texts_of(batch.column("text"))
            out = np.zeros(len(offsets) - 1)
            for lo, hi in tn.chunks(offsets):
                term, row = terms(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                s = slot[term]
                n = max(1, len(model["terms"]))
                pairs = np.unique(row[s >= 0] * n + s[s >= 0])
                out[lo:hi] = scores(pairs // n, pairs % n, hi - lo, model["w"], model["v"], model["b"])[0]
            p = 1 / (1 + np.exp(-np.clip(out, -40, 40)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], names=["doc_id", "score"])
    return run


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row; texts without any kept term get the score of the bias."""
    d = id_and_text(docs, id_col, text_col)
    return d.mapInArrow(_score(model), f"doc_id {d.schema['doc_id'].dataType.simpleString()}, score double")


def held_out(doc_id) -> F.Column:
    """Rows kept out of fitting: crc32 of the id as text leaves 2 when divided by 4 (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
             label_col: str = "toxic", max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per input row.

    Edges: null and empty texts have no terms and score the bias; without labels
    of both classes every text scores the base rate; labels given twice count
    once (the highest); ids may repeat (of rows that share a labelled id one is
    fitted); an empty table gives an empty result.
    """
    lab = labels.select(F.col(f"`{label_id}`").alias("doc_id"), F.col(f"`{label_col}`").alias("label"))
    model = fit(id_and_text(docs, id_col, text_col), lab.where(~held_out(F.col("doc_id"))), max_rows)
    return score(docs, model, id_col, text_col).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "labels"))
