"""The factorization machine where only pairs tell, among more terms than the screen keeps; scores against plain loops."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from marquee.llm import toxicity
from marquee.sources.tables import table


def xor_rows(n, noise, seed):
    """Toxic: a stands by b, or c by d. Clean: a by c, or b by d. So every one of the four words is as frequent in both classes."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        toxic = i % 2
        pair = rng.choice([("insulta", "groupb"), ("gruntc", "folkd")] if toxic else [("insulta", "gruntc"), ("groupb", "folkd")])
        words = [f"n{rng.randrange(noise)}x" for _ in range(40)]
        at = rng.randrange(len(words))
        rows.append((i, " ".join(words[:at] + list(pair) + words[at:]), toxic))
    return rows


def test_fit_learns_pairs_beyond_the_screen_of_single_terms(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "KEPT_TERMS", 64)  # the noise words alone fill it
    monkeypatch.setattr(toxicity, "KEPT_PAIRS", 16)
    rows = xor_rows(1200, 400, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    model = toxicity.fit(docs, labels)
    assert len(model["terms"]) > 64
    test = xor_rows(300, 400, 2)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame([r[:2] for r in test], "doc_id long, text string"), model).collect()}
    good = np.mean([(got[i] > 0.5) == bool(t) for i, _, t in test])
    assert good > 0.95
    # without the pairs' screen the four words do not enter, and nothing is learned
    monkeypatch.setattr(toxicity, "pair_terms", lambda *a: np.zeros(0, np.int64))
    blind = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark.createDataFrame([r[:2] for r in test], "doc_id long, text string"), blind).collect()}
    assert np.mean([(got[i] > 0.5) == bool(t) for i, _, t in test]) < 0.7


def test_scores_against_plain_loops(spark):
    rng = np.random.default_rng(3)
    terms = np.sort(rng.choice(toxicity.DIMENSIONS, 4000, replace=False))
    model = {"terms": terms, "w": rng.normal(size=4000), "v": rng.normal(0, 0.3, (4000, toxicity.FACTORS)), "b": -0.5}
    texts = ["", "one word", "Words words WORDS and more of them " * 3, " ".join(f"w{i}" for i in range(3000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    slot = {int(t): i for i, t in enumerate(terms)}
    for i, t in enumerate(texts):
        b = t.encode()
        found, _ = toxicity.terms(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
        held = sorted({slot[x] for x in found.tolist() if x in slot})
        s = model["b"] + sum(model["w"][k] for k in held)
        s += sum(float(model["v"][x] @ model["v"][y]) for n, x in enumerate(held) for y in held[:n])
        assert abs(got[i] - 1 / (1 + math.exp(-max(-40, min(40, s))))) < 1e-6


def test_pairs_are_counted_once_a_document(spark):
    sample = spark.createDataFrame([(1, "a b a b a b"), (0, "a x x x x x x x x b"), (1, "b a"), (0, "")], "label int, text string")
    rows = sample.mapInArrow(toxicity._near_pairs, "pair long, a long, b long").groupBy("pair").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).collect()

    def term(w):
        return int(toxicity.terms(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0][0])

    low, high = sorted((term("a"), term("b")))
    assert {(r["a"], r["b"]) for r in rows if r["pair"] == low << 18 | high} == {(2, 0)}


def test_held_out_accuracy(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    seen = toxicity.toxicity(docs, labels).where("held_out").join(labels, "doc_id").toPandas()
    caught = seen[seen["toxic"] == 1]["predicted"].mean()
    alone = 1 - seen[seen["toxic"] == 0]["predicted"].mean()
    assert caught >= 0.8 and alone >= 0.99, (caught, alone)
    assert seen["score"].max() <= 1 and seen["score"].min() >= 0
