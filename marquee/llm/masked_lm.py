"""Language-model scores by masked pseudo-likelihood.

Every word of a text is predicted from the ``SIDE`` words on both sides of it, as
if it alone were masked; the sum of the conditional log-probabilities scores the
document. Words are hashed to ``CODES`` codes, each two digits of base ``DIGIT``. The
network adds the neighbours' embeddings, gated by position, into a hidden vector
and predicts the first digit, then, with the first digit's embedding added, the
second: two small softmaxes instead of one over all codes, and the probabilities
of all codes still add up to one.

Words that share a code are told apart by the corpus's word counts: a table of every
different word, made and kept by Spark, gives each word its share of its code, and
``log P(word | code)`` is added to the network's ``log P(code | both sides)``. Of a
code's occurrences one more is set aside for all words the table lacks. Words that
make up ``2**-FREQUENT_BITS`` of the corpus or more (so there are at most
``2**FREQUENT_BITS``) are sent to the tasks; all others are joined by shuffle, and
none of those is a hot key.

Training is numpy inside Spark tasks, over the whole corpus: every task trains a copy of the network on its texts, and the copies are averaged by
Spark, weighted by words. Every word is a target once: each of the ``rounds`` rounds
takes the words of its own offset, that many apart. The word table grows with the
corpus's vocabulary, the averaged copies with the number of tasks; the network has a
fixed size, and a retried task repeats its own steps exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import textnum as tn
from marquee.llm.scratch import documents, id_and_text, written

DIGIT = 64
CODES = DIGIT * DIGIT
WIDTH = 16
SIDE = 2
#: Rounds of training, and the distance of one round's words: together the rounds visit every word.
ROUNDS = 2
BATCH = 2048
RATE = 0.15
#: Floats of one row of a sent network, and first-level sums of the average.
_SLICE = 4096
_FAN = 64
FREQUENT_BITS = 17
#: Words that a task counts before it hands on what it has.
_COUNTED = 1 << 22
#: Logarithms are added up as whole multiples of this, so that their order does not matter.
_GRAIN = 1e-9
#: Words scored at once.
_BLOCK = 1 << 11
#: Rows of one matrix product: so small that the numeric library adds no threads of its own, which would only spin beside Spark's tasks.
_ROWS = 128
_PLACES = [k for k in range(-SIDE, SIDE + 1) if k]
_STEPS = np.array(_PLACES)


def start(seed: int = 7) -> dict[str, np.ndarray]:
    """The untrained network (the extra embedding is "outside the text")."""
    rng = np.random.default_rng(seed)
    normal = lambda *s: (rng.normal(0, 0.1, s)).astype(np.float32)
    return {
        "words": normal(CODES + 1, WIDTH), "gates": np.ones((len(_PLACES), WIDTH), np.float32), "first": normal(DIGIT, WIDTH),
        "out1": normal(WIDTH, DIGIT), "bias1": np.zeros(DIGIT, np.float32), "out2": normal(WIDTH, DIGIT), "bias2": np.zeros(DIGIT, np.float32),
    }


def flat(net: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([net[k].reshape(-1) for k in sorted(net)])


def shaped(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    like = start()
    for k in sorted(like):
        n = like[k].size
        out[k] = values[at : at + n].reshape(like[k].shape).astype(np.float32)
        at += n
    return out


def codes_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of every word, words before each row)."""
    h, _, bounds = tn.words(data, offsets)
    return _codes(h.view(np.int64)), bounds


def _codes(h: np.ndarray) -> np.ndarray:
    return h & (CODES - 1)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` in products of ``_ROWS`` rows."""
    whole = len(a) // _ROWS * _ROWS
    if whole == 0:
        return a @ b
    out = np.matmul(a[:whole].reshape(-1, _ROWS, a.shape[1]), b).reshape(whole, -1)
    return out if whole == len(a) else np.concatenate([out, a[whole:] @ b])


def _crossed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` in products of ``_ROWS`` rows."""
    whole = len(a) // _ROWS * _ROWS
    rest = a[whole:].T @ b[whole:]
    if whole == 0:
        return rest
    parts = np.matmul(a[:whole].reshape(-1, _ROWS, a.shape[1]).transpose(0, 2, 1), b[:whole].reshape(-1, _ROWS, b.shape[1]))
    return parts.sum(0) + rest


def contexts(code: np.ndarray, bounds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Codes of the neighbours of the words ``at``, one column a place; ``CODES`` outside the text."""
    wide, place = spaced(code, bounds)
    return wide[place[at][:, None] + _STEPS]


def spaced(code: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes with ``SIDE`` times ``CODES`` around every row, place of every word among them)."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    place = np.arange(len(code)) + SIDE * (row + 1)
    wide = np.full(len(code) + SIDE * len(bounds), CODES, np.int16)
    wide[place] = code
    return wide, place


#: Outputs within this distance of zero are exponentiated as they are.
_SAFE = 60.0
_ONES = np.ones((DIGIT, 1), np.float32)


def _centred(x: np.ndarray) -> np.ndarray:
    """``x``, or where an exponential could overflow ``x`` less every row's maximum."""
    return x if not x.size or (x.max() < _SAFE and x.min() > -_SAFE) else x - x.max(1, keepdims=True)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(_centred(x))
    x /= _times(x, _ONES)  # sums of rows
    return x


def forward(net: dict, ctx: np.ndarray, code: np.ndarray, squash):
    """(embedded neighbours, hidden 1, hidden 2, both digits' outputs after ``squash``)."""
    e = net["words"][ctx]
    h = np.einsum("bpd,pd->bd", e, net["gates"])
    h2 = h + net["first"][code // DIGIT]
    return e, h, h2, squash(_times(h, net["out1"]) + net["bias1"]), squash(_times(h2, net["out2"]) + net["bias2"])


def log_probability(net: dict, ctx: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Conditional log-probability of every code given its neighbours."""
    _, _, _, x1, x2 = forward(net, ctx, code, lambda x: x)
    return _log_share(x1, code // DIGIT) + _log_share(x2, code % DIGIT)


def _log_share(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Logarithm of the chosen one's share of the exponentials of every row."""
    x = _centred(x)
    own = x[np.arange(len(x)), chosen].astype(np.float64)
    return own - np.log(_times(np.exp(x), _ONES)[:, 0]).astype(np.float64)


def step(net: dict, seen: dict, ctx: np.ndarray, code: np.ndarray, rate: float = RATE) -> None:
    """One AdaGrad step on a batch of masked words, in place."""
    e, h, h2, g1, g2 = forward(net, ctx, code, _softmax)
    i, n = np.arange(len(code)), np.float32(len(code))
    g1[i, code // DIGIT] -= 1
    g2[i, code % DIGIT] -= 1
    g1, g2 = g1 / n, g2 / n
    d2 = _times(g2, net["out2"].T)
    d1 = _times(g1, net["out1"].T) + d2
    digit = np.zeros((len(code), DIGIT), np.float32)
    digit[i, code // DIGIT] = 1
    first = _crossed(digit, d2)
    near = ctx.reshape(-1)
    order = np.argsort(near, kind="stable")
    starts = np.flatnonzero(np.diff(near[order], prepend=-1))
    at = near[order[starts]]
    words = np.add.reduceat((d1[:, None, :] * net["gates"]).reshape(-1, WIDTH)[order], starts, axis=0)
    grads = {"out1": _crossed(h, g1), "bias1": g1.sum(0), "out2": _crossed(h2, g2), "bias2": g2.sum(0), "first": first,
             "gates": np.einsum("bpd,bd->pd", e, d1)}
    for k, g in grads.items():
        seen[k] += g * g
        net[k] -= rate * g / np.sqrt(seen[k] + 1e-8)
    seen["words"][at] += words * words
    net["words"][at] -= rate * words / np.sqrt(seen["words"][at] + 1e-8)


def _word_pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(64-bit hash of every word, words before each row) of about a megabyte of text each."""
    data, offsets = tn.texts_of(batch.column("text"))
    for lo, hi in tn.chunks(offsets):
        h, _, bounds = tn.words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        yield h.view(np.int64), bounds


def _sent(values: np.ndarray, words: int) -> pa.RecordBatch:
    part = TaskContext.get().partitionId()
    cuts = [values[a : a + _SLICE].astype("<f8") * words for a in range(0, len(values), _SLICE)]
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(cuts)), pa.int32()), pa.array([part % _FAN] * len(cuts), pa.int32()), pa.array([words] * len(cuts), pa.int64()),
         pa.array([c.astype("<f4").tobytes() for c in cuts], pa.binary())], names=["slice", "fan", "words", "sums"])


def _added(table: pa.Table) -> pa.Table:
    """Sum of rows of one slice, in a fixed order."""
    total = None
    for x in sorted(table.column("sums").to_pylist()):
        v = np.frombuffer(x, "<f4").astype(np.float64)
        total = v if total is None else total + v
    first = table.slice(0, 1)
    return pa.Table.from_arrays(
        [first.column("slice"), first.column("fan"), pa.array([sum(table.column("words").to_pylist())], pa.int64()),
         pa.array([total.astype("<f4").tobytes()], pa.binary())], names=["slice", "fan", "words", "sums"])


_SENT = "slice int, fan int, words long, sums binary"


def _average(sent: DataFrame) -> np.ndarray | None:
    """Word-weighted mean of what the tasks sent, added up in two levels; a fixed number of values reaches the driver."""
    once = sent.groupBy("slice", "fan").applyInArrow(_added, _SENT)
    rows = once.groupBy("slice").applyInArrow(_added, _SENT).collect()
    rows = sorted((r for r in rows if r["words"]), key=lambda r: r["slice"])
    if not rows:
        return None
    return np.concatenate([np.frombuffer(r["sums"], "<f4").astype(np.float64) / r["words"] for r in rows])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted() -> pa.RecordBatch:
        h, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(n, pa.int64())], names=["h", "n"])

    held, size = [], 0
    for batch in batches:
        for h, _ in _word_pieces(batch):
            held.append(h)
            size += len(h)
            if size >= _COUNTED:
                yield counted()
                held, size = [], 0
    if size:
        yield counted()


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(h, n): hash and number of every different word of all texts. Written; it grows with the vocabulary."""
    texts = id_and_text(docs, text_col, text_col).select("text")
    return written(texts.mapInArrow(_count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "word-counts")


def code_totals(words: DataFrame) -> np.ndarray:
    """Words of the corpus by code."""
    out = np.zeros(CODES, np.int64)
    for r in words.groupBy(F.col("h").bitwiseAND(F.lit(CODES - 1)).alias("code")).agg(F.sum("n").alias("n")).collect():
        out[r["code"]] = r["n"]
    return out


def _frequent(words: DataFrame, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, count) of the words that make up ``2**-FREQUENT_BITS`` of the corpus or more, by hash; bounded."""
    rows = sorted(words.where(F.col("n") >= max(1, -(-int(totals.sum()) >> FREQUENT_BITS))).select("h", "n").collect())
    return np.array([r["h"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64)


def _train(values: np.ndarray, turn: int, rounds: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shaped(values)
        seen = {k: np.zeros_like(v) for k, v in net.items()}
        rng = np.random.default_rng([turn, TaskContext.get().partitionId()])
        words = 0
        for batch in batches:
            for h, bounds in _word_pieces(batch):
                code = _codes(h)
                words += len(code)
                # the rounds' offsets together are all words; the order is mixed
                at = rng.permutation(np.arange(turn, len(code), rounds))
                wide, place = spaced(code, bounds)
                for a in range(0, len(at), BATCH):
                    some = at[a : a + BATCH]
                    step(net, seen, wide[place[some][:, None] + _STEPS], code[some])
        if words:
            yield _sent(flat(net), words)
    return run


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, totals: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """The network fitted on all texts. Its first biases are the corpus's own digit frequencies."""
    texts = id_and_text(docs, text_col, text_col).select("text")
    net = start()
    totals = code_totals(word_counts(docs, text_col)) if totals is None else totals
    if not totals.sum():
        return net
    table = (totals / totals.sum()).reshape(DIGIT, DIGIT)
    net["bias1"] = np.log(table.sum(1) + 1e-6).astype(np.float32)
    net["bias2"] = np.log(table.sum(0) + 1e-6).astype(np.float32)
    for turn in range(rounds):
        net = shaped(_average(texts.mapInArrow(_train(flat(net), turn, rounds), _SENT)))
    return net


def _score(values: np.ndarray, totals: np.ndarray, often: np.ndarray, counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shaped(values)
        # one more occurrence of every code stands for the words that the table lacks
        whole, share = np.log(totals + 1.0), np.log(counts)
        row = TaskContext.get().partitionId() << 40
        index = pd.Index(often)
        for batch in batches:
            n, total, sizes, rare, times = [], [], [], [], []
            for h, bounds in _word_pieces(batch):
                code = _codes(h)
                logs = np.zeros(len(code) + 1)
                wide, place = spaced(code, bounds)
                for a in range(0, len(code), _BLOCK):
                    at = np.arange(a, min(len(code), a + _BLOCK))
                    logs[at + 1] = log_probability(net, wide[place[at][:, None] + _STEPS], code[at])
                logs[1:] -= whole[code]
                at = index.get_indexer(h)
                known = at >= 0
                logs[1:][known] += share[at[known]]
                n.append(np.diff(bounds))
                # added up text by text, so that a text scores the same wherever it stands
                total += [float(logs[bounds[k] + 1 : bounds[k + 1] + 1].sum()) for k in range(len(bounds) - 1)]
                left = np.flatnonzero(~known)
                text = np.searchsorted(bounds, left, side="right") - 1
                order = np.lexsort((h[left], text))
                left, text = h[left][order], text[order]
                first = np.flatnonzero((np.diff(left, prepend=0) != 0) | (np.diff(text, prepend=-1) != 0))
                rare.append(left[first])
                times.append(np.diff(first, append=len(left)))
                sizes.append(np.bincount(text[first], minlength=len(bounds) - 1))
            whole_of = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
            ends = pa.array(np.concatenate([[0], np.cumsum(whole_of(sizes))]), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(whole_of(x), pa.int64())) for x in (rare, times)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(row, row + batch.num_rows), pa.int64()), batch.column("doc_id"), pa.array(whole_of(n), pa.int64()),
                 pa.array(total, pa.float64()), *lists], names=["row", "doc_id", "n_words", "logs", "rare", "times"])
            row += batch.num_rows
    return run


def masked_lm_scores(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", net: dict | None = None, words: DataFrame | None = None,
) -> DataFrame:
    """doc_id, n_words, log_likelihood (summed), mean_log_likelihood: one row per input row.

    ``words`` is the word table (``word_counts``), by default that of ``docs``. Texts
    are read once more; only hashes of words that are not frequent are shuffled.
    Edges: null, empty and wordless texts have 0 words, a sum of 0 and a null
    mean; ids may repeat or be null; an empty table gives an empty result (and an
    untrained network); other columns are ignored.
    """
    words = word_counts(docs, text_col) if words is None else words
    totals = code_totals(words)
    net = train(docs, text_col, totals=totals) if net is None else net
    d = id_and_text(docs, id_col, text_col)
    schema = f"row long, doc_id {d.schema['doc_id'].dataType.simpleString()}, n_words long, logs double, rare array<long>, times array<long>"
    scored = written(d.mapInArrow(_score(flat(net), totals, *_frequent(words, totals)), schema), "masked-scores")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("h"), F.col("x.times").alias("times"))
    # a word that the table lacks adds log 1
    shares = rare.join(words, "h").select("row", (F.col("times") * F.round(F.log("n") / _GRAIN).cast("long")).alias("add"))
    added = shares.groupBy("row").agg(F.sum("add").alias("add"))
    whole = scored.select("row", "doc_id", "n_words", "logs").join(added, "row", "left").withColumn(
        "log_likelihood", F.col("logs") + F.coalesce(F.col("add"), F.lit(0)) * _GRAIN)
    return whole.select("doc_id", "n_words", F.round("log_likelihood", 3).alias("log_likelihood"),
                        F.round(F.try_divide("log_likelihood", "n_words"), 5).alias("mean_log_likelihood"))


def op7_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masked_lm_scores(documents(spark, sf_dir, "doc_id", "text"))
