"""Quality ranking, collocations and the manifest against brute force on small tables with nulls, ties, repeats and clashing names."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import bpe_automaton, collocations, merkle, preference, textnum, toxicity
from marquee.sources.tables import table

SF = "/root/testdata/sf0.001"
CLASHING = ("grp", "idx", "n", "child", "path", "label", "score", "key", "cnt", "since", "shard", "size", "_at", "_part")


def clash(df):
    return df.withColumns({c: F.lit(0) for c in CLASHING})


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


# -- manifest ---------------------------------------------------------------


def merkle_by_hand(rows, fanout=8):
    """rows: (doc_id, source, lang, n_chars, text) → sorted tuples as the query returns them."""
    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r):
        return sha("".join(map(enc, r)))

    def tree(nodes):
        """(root, siblings before and after per level and node)."""
        paths = [[] for _ in nodes]
        at, level = list(range(len(nodes))), nodes
        while len(level) > 1:
            for k, i in enumerate(at):
                run = level[i // fanout * fanout : (i // fanout + 1) * fanout]
                paths[k].append(("".join(run[: i % fanout]), "".join(run[i % fanout + 1 :])))
            level = [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
            at = [i // fanout for i in at]
        return level[0], paths

    first = lambda v: (v is not None, v if v is not None else 0)
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (first(r[0]), leaf(r))) for g in langs}
    trees = {g: tree([leaf(r) for r in groups[g]]) for g in langs}
    root, upper = tree([trees[g][0] for g in langs])
    out = []
    for g, over in zip(langs, upper, strict=True):
        for r, own in zip(groups[g], trees[g][1], strict=True):
            path = own + over
            seen = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                seen = (*r[:4], re.sub("[A-Z]", lambda m: m[0].lower(), r[4]))
            h = leaf(seen)
            for a, b in path:
                h = sha(a + h + b)
            out.append((r[0], leaf(r), trees[g][0], root, sha("".join(a + b for a, b in path)), h, h == root))
    return sorted(map(str, out))


def merkle_rows(n=150):
    rng = random.Random(3)
    rows = [(i, rng.choice(["s", None, "é"]), rng.choice(["en", "en", "en", "de", None]), i if i % 5 else None, f"Text {i} A") for i in range(n)]
    return rows + [(7, "s", "en", 7, "Twice"), (7, "s", "en", 7, "Twice"), (None, None, None, None, None), (3, "", "fr", 0, ""), (900, "s", "", 1, "x" * 200_000)]


@pytest.mark.parametrize("part_rows", [1 << 17, 9])
def test_manifest_against_hand(spark, part_rows, monkeypatch):
    rows = merkle_rows()
    df = clash(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))
    monkeypatch.setattr(merkle.numbered, "__defaults__", (part_rows,))
    tampered, changed = merkle.tampering(F.col("doc_id"), F.col("text"))
    got = merkle.manifest(df, tampered=tampered, changed=changed)
    assert sorted(str(tuple(r)) for r in got.collect()) == merkle_by_hand(rows)


def test_manifest_of_one_row_and_of_none(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    one = merkle.manifest(spark.createDataFrame([(1, None, "en", 3, "abc")], schema)).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] and one["verified"] and one["proof_sha256"] == sha("")
    assert merkle.manifest(spark.createDataFrame([], schema)).count() == 0


def test_manifest_fails_for_any_changed_column(spark):
    df = table(spark, SF, "documents")
    got = merkle.manifest(df, tampered={"source": F.lit("other")}, changed=F.col("doc_id") % 7 == 0)
    assert got.where((F.col("doc_id") % 7 == 0) == F.col("verified")).count() == 0


# -- collocations -----------------------------------------------------------


def collocations_by_hand(rows, least, top, longest=4):
    """rows: (lang, text) → sorted result tuples, by plain counting."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    return n, {p: a for p, a in f.items() if a >= least}, top


def ranked_by_hand(n, f, top):
    out, dropped = {}, set()
    for (lang, p), a in f.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                if (lang, p[i : i + k]) in f and 100 * a >= 80 * f[lang, p[i : i + k]]:
                    dropped.add((lang, p[i : i + k]))
    for (lang, p), a in f.items():
        if len(p) < 2 or (lang, p) in dropped:
            continue
        cuts = [(math.floor(Fraction(2_000_000 * a, f[lang, p[:j]] + f[lang, p[j:]])), j) for j in range(1, len(p))]
        score, j = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:j]], f[lang, p[j:]]))
    rows = []
    for lang, found in out.items():
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            rows.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(rows)


def phrase_rows():
    rng = random.Random(5)
    words = ["New", "york", "city", "hall", "é", "the", "of", "a", "b", "c#", " x"]
    rows = []
    for i in range(160):
        w = []
        for _ in range(rng.randint(0, 40)):
            w += ["new", "york", "city"] if rng.random() < 0.15 else [rng.choice(words)]
            w[-1] += rng.choice(["", "", "", ",", "\n", "\t", ". "])
        rows.append((rng.choice(["en", "en", "d e", None, "und", ""]), " ".join(w)))
    return [*rows, ("en", None), (None, ""), ("fr", "solo"), ("en", rows[0][1]), ("en", rows[0][1]), ("en", " ".join(["long", "text", "of", "x"] * 300))]


@pytest.mark.parametrize("shards,bits,chunk", [(1, 20, 1 << 20), (3, 20, 1 << 20), (4, 6, 1 << 20), (3, 20, 64)])
def test_collocations_against_hand(spark, shards, bits, chunk):
    """Also with a bitmap so small that everything collides, and with every text cut into small parts."""
    rows = phrase_rows()
    df = clash(spark.createDataFrame(rows, "lang string, text string"))
    got = collocations.collocations(df, least=6, top=12, shards=shards, bits=bits, chunk=chunk)
    assert sorted(map(tuple, got.collect())) == ranked_by_hand(*collocations_by_hand(rows, 6, 12))


def test_phrases_are_not_activated_early(spark):
    """Only phrases whose subphrases are frequent are ever counted."""
    rows = [("en", "a b c d"), ("en", "a b x y"), ("en", "q a b")] * 4 + [("en", "z a")]
    counts = collocations.phrase_counts(spark.createDataFrame(rows, "lang string, text string"), least=5, shards=2)
    assert {(r["phrase"], r["a"]) for r in counts.collect()} == {("", 46), ("a", 13), ("b", 12), ("a b", 12)}


def test_scores_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    f = {("en", ("a",)): big, ("en", ("b",)): big - 7, ("en", ("c",)): big - 1, ("en", ("a", "b")): big - 9, ("en", ("b", "c")): big // 2, ("en", ("a", "b", "c")): big // 3}
    counts = spark.createDataFrame([(g, " ".join(p), a) for (g, p), a in f.items()] + [("en", "", big)], "lang string, phrase string, a long")
    got = sorted(map(tuple, collocations.ranked(counts, 10).collect()))
    assert got == ranked_by_hand({"en": big}, f, 10)


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None), ("en", " ,. ")], "lang string, text string")).count() == 0


def test_cut_parts_hold_every_phrase_once():
    data = np.frombuffer(b"aa bb,cc  dd ee\tff gg hh. ii jj kk ll " * 9, np.uint8)
    whole = collocations._words(data, np.array([0, len(data)]))
    seen = []
    for begin, own, end in collocations._cut(data, 10):
        start, stop, _, piece = collocations._words(data[begin:end], np.array([0, end - begin]))
        for i in np.flatnonzero(start < own - begin):
            same = piece[i : i + 4] == piece[i]
            seen.append((start[i] + begin, tuple((stop - start)[i : i + 4][same])))
    start, stop, _, piece = whole
    assert sorted(seen) == [(start[i], tuple((stop - start)[i : i + 4][piece[i : i + 4] == piece[i]])) for i in range(len(start))]


# -- quality ranking --------------------------------------------------------


def test_pairwise_training_ranks_by_what_differs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 6))
    truth = np.array([2.0, -1.0, 0, 0, 0.5, 0])
    y = (x @ truth > 0).astype(int)
    w = preference.train(x, np.flatnonzero(y == 1), np.flatnonzero(y == 0))
    s = x @ w
    wins = (s[y == 1][:, None] > s[y == 0][None, :]).mean()
    assert wins > 0.99 and np.corrcoef(w, truth)[0, 1] > 0.95
    drawn = preference.train(x, np.flatnonzero(y == 1), np.flatnonzero(y == 0), pairs=2000)
    assert np.corrcoef(drawn, w)[0, 1] > 0.95


def test_pairwise_gradient_is_that_of_the_feature_differences():
    """One Adam step from zero has the sign of the summed differences."""
    x = np.array([[1.0, 0, 2], [0, 3, 1], [2, 2, 2]])
    w = preference.train(x, np.array([0, 2]), np.array([1]), steps=1)
    assert (np.sign(w) == np.sign((x[0] - x[1]) + (x[2] - x[1]))).all()


def test_quantile_cutoff():
    s, ones = np.array([3.0, 1, 2, 4]), np.ones(4)
    assert preference.quantile(s, ones, 0.25) == 1.5 and preference.quantile(s, ones, 0.5) == 2.5
    assert preference.quantile(s, np.array([1.0, 3, 1, 1]), 0.5) == 1.5


def features_by_hand(text: str) -> dict:
    b = text.encode()
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
    tri = Counter(zip(low, low[1:], low[2:], strict=False)) if len(low) > 2 else Counter([tuple(low)] if low else [])
    again = sum(c for c in tri.values() if c > 1)
    n = len(words)
    c = Counter(low)
    return {"upper": sum(65 <= x <= 90 for x in b) / max(1, len(b)), "words": math.log1p(n), "size": len(b) / max(n, 1), "distinct": len(c) / max(n, 1),
            "most": max(c.values(), default=0) / max(n, 1), "again": again / max(1, sum(tri.values())),
            "same": sum(x == y for x, y in zip(low, low[1:], strict=False)) / max(n, 1)}


def test_features_against_hand():
    texts = ["", "One one two THREE! a b c a b c", "é" * 9, " \n\t ", "x", "A b\nA b\nc", "word " * 40, "tab\tand\nlines\n\n"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    got = preference.features(data, offsets)
    at = preference.N_FEATURES - preference._N_STATS
    for x, t in zip(got, texts, strict=True):
        want = features_by_hand(t)
        if not t:
            assert (x == 0).all()
            continue
        mine = {"upper": x[4], "words": x[at], "size": x[at + 1], "distinct": x[at + 2], "most": x[at + 3], "again": x[at + 4], "same": x[at + 5]}
        for k in want:
            assert abs(mine[k] - want[k]) < 1e-9, (t, k)
        # a text's features do not depend on its neighbours
        alone = preference.features(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
        assert np.allclose(alone[0], x)


def test_quality_scores_on_held_out_rows(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    got = preference.quality_scores(docs, labels)
    seen = got.where("held_out").join(labels, "doc_id").toPandas()
    assert len(seen) > 60 and (seen["predicted"] == seen["quality"]).mean() > 0.97
    assert seen["score"].between(0, 1).all()
    ids = got.select("doc_id", "held_out").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in ids)
    # held-out labels are never seen
    flipped = labels.withColumn("quality", F.when(preference.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert preference.quality_scores(docs, flipped).exceptAll(got).count() == 0


def test_quality_scores_edges(spark):
    good, bad = "Plain words that follow each other here. " * 3, "A!! B!! A!! B!! $$$ ### " * 4
    rows = [(i, good if i % 2 else bad) for i in range(40)] + [(None, good), (50, None), (51, ""), (52, " \n"), (53, "é" * 100_000), (1, good)]
    docs = clash(spark.createDataFrame(rows, "doc_id long, text string"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(2, 1), (3, None), (None, 1), (999, 0)], "doc_id long, quality int")
    got = preference.quality_scores(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got if r["doc_id"] is not None and r["doc_id"] < 40)
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]
    one = preference.quality_scores(docs, labels.where("quality = 1")).select("score").distinct().collect()
    assert [r["score"] for r in one] == [1.0]
    assert preference.quality_scores(docs, labels.limit(0)).select("score").distinct().first()["score"] == 0.5
    assert preference.quality_scores(docs.limit(0), labels).count() == 0


def test_a_labelled_id_of_very_many_rows_is_one_row_of_the_sample(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "other"), (3, None)], "doc_id long, text string").fillna({"text": ""})
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, label int")
    for module in (preference, toxicity):
        got = sorted(map(tuple, module.training_rows(docs, labels).collect()))
        assert got == [(0, ""), (0, "other"), (1, "text 0")]


# -- memory of an encoding worker -------------------------------------------


def test_an_encoding_worker_holds_a_small_tokenizer():
    """All that a worker keeps, compiled tokenizer and remembered runs, fits beside what earlier stages left on an executor."""
    tracemalloc.start()
    try:
        t = bpe_automaton.WordTokenizer(bpe_automaton.word_bpe_path())
        compiled = tracemalloc.get_traced_memory()[0]
        left = t.memo_left
        t.digest(" ".join(f"w{i * 7919 % 99991}ord{i}" for i in range(20_000)))
        used, counted = tracemalloc.get_traced_memory()[0] - compiled, left - t.memo_left
    finally:
        tracemalloc.stop()
    assert len(t.memo) == 20_000 and used < 1.5 * counted + (2 << 20)
    assert compiled + 1.5 * bpe_automaton.MEMO_BYTES < 90 << 20


def test_memory_given_back_is_made_again():
    data = np.frombuffer(b"some words and more words", np.uint8)
    before = textnum.words(data, np.array([0, len(data)]))
    textnum.give_back()
    assert not textnum._POWERS
    for a, b in zip(before, textnum.words(data, np.array([0, len(data)])), strict=True):
        assert (a == b).all()


def test_every_labelled_row_is_fitted(spark, monkeypatch):
    """More labelled rows than a block has: moments, weights and cutoff are those of all of them."""
    monkeypatch.setattr(preference, "BLOCK_ROWS", 100)
    good, bad = "Plain words that follow each other here. ", "A!! B!! $$$ ### "
    rows = [(i, (bad if i % 5 == 0 else good) * (1 + i % 7) + "x" * (i % 11)) for i in range(9_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i, _ in rows], "doc_id long, label int")
    assert preference.training_rows(docs, labels).count() == 9_000
    model = preference.fit(docs, labels)
    x = np.concatenate([preference.features(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])) for _, t in rows])
    assert np.allclose(model["centre"], x.mean(0)) and np.allclose(np.where(np.isinf(model["spread"]), 0, model["spread"]), x.std(0), atol=1e-8)
    s = preference.scores(model, x)
    assert ((s >= 0.5) == [i % 5 > 0 for i, _ in rows]).all()


def test_cutoff_of_a_table_is_the_quantile_of_its_rows(spark):
    rng = np.random.default_rng(3)
    for s in (rng.normal(size=500), np.round(rng.normal(size=500), 1), np.zeros(20), np.array([1.0, 2.0]), rng.normal(size=300) ** 9):
        y = (rng.random(len(s)) < 0.7).astype(int)
        scored = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s, strict=True)], "label int, s double").repartition(3)
        for share in (0.01, 0.3, 0.99):
            got = preference.cutoff(scored, {0: 1.0, 1: 1.0}, share, bins=4)
            different = np.unique(s)
            below = np.array([(s <= d).mean() for d in different])
            k = int(np.argmin(np.abs(below - share)))
            assert got == (different[k] + different[min(k + 1, len(different) - 1)]) / 2
