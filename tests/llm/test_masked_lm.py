"""The masked pseudo-likelihood against plain Python, and the products that take no threads of their own."""

import math
from collections import Counter

import numpy as np
import pytest

from marquee.llm import masked_lm


def code_of(word: str) -> int:
    b = word.encode()
    return int(masked_lm.codes_of(np.frombuffer(b, np.uint8), np.array([0, len(b)]))[0][0])


def by_hand(net, text, counts, totals):
    """Sum over all words of log P(code | two neighbours a side) + log P(word | code), in plain loops."""
    words = text.lower().split()
    codes = [code_of(w) for w in words]
    total = 0.0
    for i, c in enumerate(codes):
        hidden = [0.0] * masked_lm.WIDTH
        for p, k in enumerate(masked_lm._PLACES):
            near = codes[i + k] if 0 <= i + k < len(codes) else masked_lm.CODES
            for d in range(masked_lm.WIDTH):
                hidden[d] += float(net["words"][near][d]) * float(net["gates"][p][d])
        for out, bias, digit in (("out1", "bias1", c // masked_lm.DIGIT), ("out2", "bias2", c % masked_lm.DIGIT)):
            if out == "out2":
                hidden = [x + float(y) for x, y in zip(hidden, net["first"][c // masked_lm.DIGIT], strict=True)]
            s = [sum(hidden[d] * float(net[out][d][j]) for d in range(masked_lm.WIDTH)) + float(net[bias][j]) for j in range(masked_lm.DIGIT)]
            total += s[digit] - math.log(sum(map(math.exp, s)))
        total += math.log(counts.get(words[i], 1)) - math.log(totals[c] + 1)
    return total


def test_scores_against_plain_python(spark):
    texts = ["the cat sat on the mat", "one", "", "Dogs and cats and dogs " * 9, "ünïcode wörds hére\tand\nthere"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = masked_lm.word_counts(docs)
    net = masked_lm.train(docs, rounds=2)
    counts = Counter(w for t in texts for w in t.lower().split())
    totals = Counter()
    for w, n in counts.items():
        totals[code_of(w)] += n
    got = {r.doc_id: r for r in masked_lm.masked_lm_scores(docs, net=net, words=words).collect()}
    for i, t in enumerate(texts):
        assert got[i].n_words == len(t.split())
        assert abs(got[i].log_likelihood - by_hand(net, t, counts, totals)) < 0.02, t


def test_contexts_stop_at_the_text():
    code, bounds = np.arange(1, 8), np.array([0, 3, 3, 4, 7])
    out = masked_lm.CODES
    got = masked_lm.contexts(code, bounds, np.arange(7))
    want = [[out, out, 2, 3], [out, 1, 3, out], [1, 2, out, out], [out] * 4, [out, out, 6, 7], [out, 5, 7, out], [5, 6, out, out]]
    assert got.tolist() == want


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 300])
def test_products_in_parts(n):
    rng = np.random.default_rng(n)
    a, b, c = rng.normal(size=(n, 5)), rng.normal(size=(5, 7)), rng.normal(size=(n, 3))
    assert np.allclose(masked_lm._times(a, b), a @ b) and masked_lm._times(a, b).shape == (n, 7)
    assert np.allclose(masked_lm._crossed(a, c), a.T @ c)


def test_one_step_follows_the_gradient():
    """A step lowers the loss of its own batch, and the embedding of a code outside the batch stays."""
    rng = np.random.default_rng(0)
    net = masked_lm.start()
    seen = {k: np.zeros_like(v) for k, v in net.items()}
    code = rng.integers(0, 50, 400)
    ctx = rng.integers(0, 50, (400, 4))
    far = net["words"][4000].copy()
    before = masked_lm.log_probability(net, ctx, code).sum()
    for _ in range(20):
        masked_lm.step(net, seen, ctx, code)
    assert masked_lm.log_probability(net, ctx, code).sum() > before + 100
    assert (net["words"][4000] == far).all()
