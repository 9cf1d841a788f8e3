"""Quality scores by Bradley-Terry pairwise ranking.

A document's score is linear in features of its whole text. The weights are
learned from preference pairs, a good document against a bad one: the chance that
the good one is preferred is the logistic function of the difference of their
scores, so the loss is the logistic loss on feature differences and no intercept
is learned. The cutoff is a quantile of the scores: the share of bad documents
among the labelled rows lies below it. Reported scores are the chance of being
preferred to a document at the cutoff, so 0.5 is the cutoff itself.

Features describe form, not topic: shares of byte classes, of the classes that
words begin and end with, hashed shapes of words (``Aa.``, ``A!``), word and line
repeats, lengths. They are made in numpy inside Arrow tasks; scoring is one pass
without a shuffle and the model has a fixed size. Fitting takes a bounded sample
of labelled rows, ``MAX_ROWS`` a class, chosen by a hash of the id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import textnum as tn
from marquee.llm.bitmap import bitmap, split
from marquee.llm.scratch import documents, id_and_text, written
from marquee.sources.tables import table

#: Labelled rows of a block, about; its pairs are a quarter of the square at most.
BLOCK_ROWS = 2_048
#: Pairs that ``train`` uses unless told otherwise; fitting uses all pairs of a block.
PAIRS = 1 << 18
STEPS = 300
SHRINKAGE = 1e-3
THRESHOLD = 0.5
#: Buckets of hashed word shapes.
SHAPES = 256
#: Standardised features are cut here, so one odd text has no boundless score.
CUT = 5.0
_CLASSES = 18
_N_STATS = 9
N_FEATURES = 3 * _CLASSES + SHAPES + _N_STATS


def _byte_classes() -> np.ndarray:
    """Class of every byte: blank, line end, a-z, A-Z, 0-9, beyond ASCII, and kinds of punctuation."""
    out = np.zeros(256, np.int64)
    for k, group in enumerate((" \t", "\n\x0b\x0c\r", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"), 1):
        out[[ord(c) for c in group]] = k
    out[128:] = 6
    for k, group in enumerate((".", ",", ";:", "?", "!", "'\"`", "()[]{}", "-_/\\", "|<>", "#*$%&", "@~^=+"), 7):
        out[[ord(c) for c in group]] = k
    return out


_CLASS = _byte_classes()


def _repeats(key: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: different values, the most frequent one's count, and the items whose value occurs twice or more."""
    if not len(key):
        return np.zeros(n), np.zeros(n), np.zeros(n)
    own = tn.mix(key + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))  # a value of this row
    _, first, times = np.unique(own, return_index=True, return_counts=True)
    most = np.zeros(n)
    np.maximum.at(most, row[first], times)
    return np.bincount(row[first], minlength=n), most, np.bincount(row[first], np.where(times > 1, times, 0), n)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One line of ``N_FEATURES`` values per text; a text without bytes is all zeros."""
    n = len(offsets) - 1
    out = np.zeros((n, N_FEATURES))
    if not len(data):
        return out
    size = np.diff(offsets)
    per_byte, per = 1 / np.maximum(size, 1)[:, None], lambda x, of: x / np.maximum(of, 1)
    kinds = _CLASS[data]
    row = np.repeat(np.arange(n), size)
    out[:, :_CLASSES] = np.bincount(row * _CLASSES + kinds, minlength=n * _CLASSES).reshape(n, -1) * per_byte
    start, end = tn.spans(data, offsets)
    word_row = np.searchsorted(offsets, start, side="right") - 1
    words = np.bincount(word_row, minlength=n)
    per_word = 1 / np.maximum(words, 1)[:, None]
    at = _CLASSES
    for byte in (start, end - 1):
        out[:, at : at + _CLASSES] = np.bincount(word_row * _CLASSES + kinds[byte], minlength=n * _CLASSES).reshape(n, -1) * per_word
        at += _CLASSES
    # shapes: runs of one class become one sign
    change = np.ones(len(data), bool)
    change[1:] = kinds[1:] != kinds[:-1]
    change[start] = True
    sign = np.cumsum(change)
    p = tn.prefix(kinds[change].astype(np.uint8))
    shape = (tn.range_hash(p, sign[start] - 1, sign[end - 1]) & np.uint64(SHAPES - 1)).astype(np.int64)
    out[:, at : at + SHAPES] = np.bincount(word_row * SHAPES + shape, minlength=n * SHAPES).reshape(n, -1) * per_word
    at += SHAPES
    h = tn.range_hash(tn.prefix(tn._LOWER[data]), start, end)
    distinct, most, _ = _repeats(h, word_row, n)
    runs, run_row = tn.shingles(h, np.searchsorted(start, offsets), 3)
    _, _, again = _repeats(runs, run_row, n)
    same = (h[1:] == h[:-1]) & (word_row[1:] == word_row[:-1]) if len(h) else np.zeros(0, bool)
    breaks = np.flatnonzero(data == 10)
    line_start = np.union1d(offsets[:-1][size > 0], breaks + 1)
    line_start = line_start[line_start < len(data)]
    line_row = np.searchsorted(offsets, line_start, side="right") - 1
    line_end = np.append(line_start[1:], len(data))
    lines = np.bincount(line_row, minlength=n)
    line_hash = tn.range_hash(tn.prefix(data), line_start, np.minimum(line_end, offsets[line_row + 1]))
    _, _, line_again = _repeats(line_hash, line_row, n)
    out[:, at : at + _N_STATS] = np.stack([
        np.log1p(words), per(size, words), per(distinct, words), per(most, words), per(again, np.bincount(run_row, minlength=n)),
        per(np.bincount(word_row[1:][same], minlength=n), words), np.log1p(per(size, lines)), per(line_again, lines),
        np.log1p(words) * per(distinct, words)], 1)
    return out


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = tn.texts_of(batch.column("text"))
        rows = []
        for lo, hi in tn.chunks(offsets):
            rows += [x.tobytes() for x in features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])]
        yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("label"), pa.array(rows, pa.binary())], names=["h", "label", "features"])


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(h, label, text) of every labelled document; h is a hash of its id.

    Other texts stay in the scan: only rows that a bitmap of the labelled ids may
    hold are joined. Ids of another type than the documents' are joined directly.
    """
    if docs.schema["doc_id"].dataType == labels.schema["doc_id"].dataType:
        ids = labels.where("doc_id is not null").select("doc_id").distinct().select(F.xxhash64("doc_id").alias("h"))
        docs, _ = split(docs, F.xxhash64("doc_id"), *bitmap(written(ids, "preference-ids")))
    rows = docs.join(labels, "doc_id").select("doc_id", F.col("label").cast("int").alias("label"), "text")
    # an id that many rows share is fitted as one row: its smallest text, found by partial aggregation
    one = rows.groupBy("doc_id").agg(F.min(F.struct("text", "label")).alias("r"))
    return one.select(F.xxhash64("doc_id").alias("h"), "r.label", "r.text")


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, text) of every labelled document."""
    return _labelled(docs, labels).select("label", "text")


def train(x: np.ndarray, good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, steps: int = STEPS, seed: int = 11) -> np.ndarray:
    """Weights of the linear score: Adam on the logistic loss of the pairs' feature differences, with shrinkage; deterministic.

    ``good`` and ``bad`` are row numbers of ``x``. All pairs are used where there
    are at most ``pairs``, else that many are drawn.
    """
    every = len(good) * len(bad) <= pairs
    if not every:
        rng = np.random.default_rng(seed)
        i, j = rng.choice(good, pairs), rng.choice(bad, pairs)
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for t in range(1, steps + 1):
        s = x @ w
        lead = s[good][:, None] - s[bad] if every else s[i] - s[j]
        pull = 1 / (1 + np.exp(np.clip(lead, -40, 40))) / lead.size  # chance that the worse one is preferred
        # sum over pairs of pull * (x_i - x_j), without the differences themselves
        up, down = (pull.sum(1), pull.sum(0)) if every else (pull, pull)
        total = np.bincount(good if every else i, up, len(x)) - np.bincount(bad if every else j, down, len(x))
        g = SHRINKAGE * w - x.T @ total
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def quantile(score: np.ndarray, weight: np.ndarray, share: float) -> float:
    """A cutoff with ``share`` of the weight below it, halfway between two scores."""
    order = np.argsort(score, kind="stable")
    below = np.cumsum(weight[order]) / weight.sum()
    k = int(np.argmin(np.abs(below - share)))
    return float((score[order[k]] + score[order[min(k + 1, len(order) - 1)]]) / 2)


def moments(parts: list[tuple[float, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of all rows from (rows, mean, squared deviations) of disjoint parts."""
    n, mean, squares = 0.0, 0.0, 0.0
    for m, a, b in parts:
        squares = squares + b + (a - mean) ** 2 * (n * m / (n + m))
        mean = mean + (a - mean) * (m / (n + m))
        n += m
    return mean, np.sqrt(squares / n)


def cutoff(scored: DataFrame, weight: dict[int, float], share: float, bins: int = 1 << 12) -> float:
    """``quantile`` of a table (label, s) of any size, a row weighing by its label.

    Counts in equal bins narrow down the score at which the weight reaches the
    share, until one is left; its neighbours are then looked up.
    """
    counted = [F.count_if(F.col("label") == c).alias(f"n{c}") for c in (0, 1)]
    weigh = lambda r: r["n0"] * weight[0] + r["n1"] * weight[1]
    whole = scored.agg(*counted, F.min("s").alias("low"), F.max("s").alias("high")).first()
    total, below, low, high, here = weigh(whole), 0.0, whole["low"], whole["high"], weigh(whole)
    while low < high:
        place = F.least(F.floor((F.col("s") - low) / (high - low) * bins), F.lit(bins - 1))
        rows = scored.where(F.col("s").between(low, high)).groupBy(place.alias("k")).agg(*counted, F.min("s").alias("low"), F.max("s").alias("high"))
        rows = sorted(rows.collect(), key=lambda r: r["k"])
        for r in rows:
            here, low, high = weigh(r), r["low"], r["high"]
            if below + here >= share * total or r is rows[-1]:
                break
            below += here
    near = scored.agg(F.max(F.when(F.col("s") < low, F.col("s"))).alias("p"), F.min(F.when(F.col("s") > low, F.col("s"))).alias("q")).first()
    steps = [(near["p"], below), (low, here), (near["q"], total - below - here)]
    score, its = zip(*[x for x in steps if x[0] is not None], strict=True)
    return quantile(np.array(score), np.array(its), share)


def _block(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of a block, its rows in the same order on every run."""
    table = table.sort_by([("h", "ascending"), ("label", "ascending"), ("features", "ascending")])
    return np.frombuffer(b"".join(table.column("features").to_pylist())).reshape(-1, N_FEATURES), table.column("label").to_numpy()


def _by_block(rows: DataFrame, n_blocks: int, work) -> list[tuple[float, np.ndarray, np.ndarray]]:
    """``work(features, labels)`` of every block, in order: a weight and two lines of ``N_FEATURES`` values each."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        n, a, b = work(*_block(table))
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "n": [float(n)], "a": [a.tobytes()], "b": [b.tobytes()]})

    dealt = rows.withColumn("block", F.pmod("h", F.lit(n_blocks))).repartition(n_blocks, "block")
    out = dealt.groupBy("block").applyInArrow(run, "block long, n double, a binary, b binary").collect()
    return [(r["n"], np.frombuffer(r["a"]), np.frombuffer(r["b"])) for r in sorted(out, key=lambda r: r["block"])]


def _moments(x: np.ndarray, y: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    return len(x), x.mean(0), ((x - x.mean(0)) ** 2).sum(0)


def _standard(x: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.clip((x - centre) / spread, -CUT, CUT)


def _learned(centre: np.ndarray, spread: np.ndarray):
    def work(x: np.ndarray, y: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        """Pairs of the block, and the weights that they teach (none without both classes)."""
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        pairs = len(good) * len(bad)
        w = train(_standard(x, centre, spread), good, bad, pairs) if pairs else np.zeros(N_FEATURES)
        return pairs, w, w[:0]
    return work


def _linear(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("features").to_pylist())).reshape(-1, N_FEATURES)
            s = (_standard(x, model["centre"], model["spread"]) * model["weights"]).sum(1)  # the same for a row in any batch
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(s)], names=["label", "s"])
    return run


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """The model as plain arrays: centre, spread, weights, cutoff, rate. ``docs``: doc_id, text; ``labels``: doc_id, label (0/1)."""
    lab = labels.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").alias("label")).where("label in (0, 1)")
    counts = {r["label"]: r["n"] for r in lab.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = counts.get(0, 0) + counts.get(1, 0)
    none = {"weights": None, "rate": counts.get(1, 0) / total if total else 0.5}
    if len(counts) < 2:
        return none
    rows = written(_labelled(docs, lab).mapInArrow(_feature_rows, "h long, label int, features binary"), "preference-features")
    found = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(found) < 2:
        return none
    n_blocks = -(-sum(found.values()) // BLOCK_ROWS)
    centre, spread = moments(_by_block(rows, n_blocks, _moments))
    spread[spread < 1e-9] = np.inf  # constant features say nothing
    learned = _by_block(rows, n_blocks, _learned(centre, spread))
    if not any(n for n, _, _ in learned):  # no block has both classes
        return none
    w = sum(n * a for n, a, _ in learned) / sum(n for n, _, _ in learned)
    model = {"weights": w, "centre": centre, "spread": spread, "rate": counts[1] / total}
    share = counts[0] / total
    scored = written(rows.mapInArrow(_linear(model), "label int, s double"), "preference-scores")
    # classes weigh as in all labelled rows
    return {**model, "cutoff": cutoff(scored, {0: share / found[0], 1: (1 - share) / found[1]}, share)}


def scores(model: dict, x: np.ndarray) -> np.ndarray:
    """Chance of every line of features to be preferred to a document at the cutoff."""
    if model["weights"] is None:
        return np.full(len(x), model["rate"])
    s = _standard(x, model["centre"], model["spread"]) @ model["weights"]
    return 1 / (1 + np.exp(-np.clip(s - model["cutoff"], -30, 30)))


def _score(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tn.texts_of(batch.column("text"))
            out = np.zeros(len(offsets) - 1)
            for lo, hi in tn.chunks(offsets, rows=1 << 12):
                out[lo:hi] = scores(model, features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], names=["doc_id", "score"])
    return run


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    d = id_and_text(docs, id_col, text_col)
    return d.mapInArrow(_score(model), f"doc_id {d.schema['doc_id'].dataType.simpleString()}, score double")


def held_out(doc_id) -> F.Column:
    """Rows kept out of fitting: crc32 of the id as text leaves 1 when divided by 3 (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
                   label_col: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted: one row per input row.

    Edges: null and empty texts have all features zero and a score of their own;
    without labels of both classes every text scores the share of good labels
    (0.5 without labels); labels given twice count once (the lowest), null labels
    and labels of unknown ids not at all; ids may repeat (of rows that share a
    labelled id one is fitted); an empty table gives an
    empty result; other columns are ignored.
    """
    lab = labels.select(F.col(f"`{label_id}`").alias("doc_id"), F.col(f"`{label_col}`").alias("label"))
    model = fit(id_and_text(docs, id_col, text_col), lab.where(~held_out(F.col("doc_id"))))
    return score(docs, model, id_col, text_col).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op11_preference_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "labels"))
