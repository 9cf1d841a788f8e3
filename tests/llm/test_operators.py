"""Training-data operators against brute force on small hand-made tables with nulls, ties, repeats and clashing names."""

import hashlib
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import (
    bpe_automaton,
    chat_format,
    exact_dedup,
    license_scan,
    masked_lm,
    mixing,
    ngram_join,
    quality_rules,
    registry,
    repeats,
    toxicity,
)
from marquee.sources.tables import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i * i % 997}" for i in range(400))
TEXTS = [
    (1, LONG, "a"), (2, LONG + " tail", "a"), (3, LONG, None), (4, None, "b"), (5, "", "b"), (6, "one two", "b"), (7, "one two", "c"),
    (8, " \t\n ", "c"), (9, "x " + LONG[300:1200] + " y", "c"), (None, LONG, "c"), (10, "é" * 500 + " ü", "d"), (10, "é" * 500 + " ü", "d"),
    (11, "the same five words here " * 40, "d"), (12, "Licensed under the Apache License, Version 2.0. and more", "d"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Extra columns carry names that the operators use inside."""
    df = spark.createDataFrame(TEXTS, "doc_id long, text string, source string")
    return df.withColumns({c: F.lit(0) for c in ("k1", "grp", "token", "stratum", "size", "score", "_cap", "node")}).withColumn("lang", F.col("source"))


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_exact_dedup(docs, empty):
    got = sorted(map(tuple, exact_dedup.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept").collect()), key=str)
    groups = {}
    for d, t, _ in TEXTS:
        groups.setdefault(t or "", []).append(d)
    want = []
    for ids in groups.values():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(d, keep, len(ids), d == keep) for d in ids]
    assert got == sorted(want, key=str)
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert exact_dedup.keep_first(docs).columns == docs.columns


def _components(texts):
    sets = []
    for _, t, _ in texts:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                label = [label[j] if x == label[i] else x for x in label]
    out = []
    for k, (d, _, _) in enumerate(texts):
        ids = [texts[m][0] for m in range(len(texts)) if label[m] == label[k] and texts[m][0] is not None]
        out.append((d, len(sets[k]), min(ids, default=None) if sets[k] else d))
    return out


def test_ngram_join(docs, empty):
    assert sorted(map(tuple, ngram_join.ngram_join(docs).collect()), key=str) == sorted(_components(TEXTS), key=str)
    assert ngram_join.ngram_join(empty).count() == 0


def test_ngram_join_near_copies_and_many_common_shingles(spark):
    rng = np.random.default_rng(3)
    rows = []
    for g in range(6):
        base = rng.integers(0, 500, 120)
        for _ in range(14):
            w = base.copy()
            w[rng.integers(0, 120, rng.integers(0, 9))] = rng.integers(500, 900)
            rows.append((len(rows), "shared words in every single text here " + " ".join(f"v{x}" for x in w), "s"))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert sorted(map(tuple, ngram_join.ngram_join(df).collect())) == sorted(_components(rows))


def test_repeats(docs, empty):
    raw = [(t or "").encode() for _, t, _ in TEXTS]
    n = repeats.LENGTH
    seen = Counter(b[p : p + n] for b in raw for p in range(len(b) - n + 1))
    want = []
    for (d, _, _), b in zip(TEXTS, raw, strict=True):
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - n + 1):
            if seen[b[p : p + n]] > 1:
                gone[p : p + n] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        want.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = repeats.remove_repeats(docs).drop("spans").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert repeats.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("name", sorted(set(registry.SQL)))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(registry.SQL[name]).df()
    got = registry.QUERIES[name](spark, SF).toPandas()[list(want.columns)]
    cut = lambda f: sorted(map(str, f.itertuples(index=False, name=None)))
    assert cut(got) == cut(want)


def test_quality_rules_edges(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (1, 1), (None, 0)], "doc_id long, quality int")
    got = {(r.doc_id, r.n_words) for r in quality_rules.quality_rules(docs, labels).collect()}
    assert got == {(d, len(WORD.findall(t or ""))) for d, t, _ in TEXTS}
    assert quality_rules.quality_rules(empty, labels).count() == 0
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 3, 9, None}


def test_binomial_tail_is_exact(spark):
    from math import comb

    rows = [(k, n) for n in (50, 400, 2000) for k in (0, 1, 3)]
    got = spark.createDataFrame(rows, "k long, n long").select("k", "n", quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.01).alias("p")).collect()
    for r in got:
        want = 1.0 if r.k > r.n * 0.01 else sum(comb(r.n, i) * 0.01**i * 0.99 ** (r.n - i) for i in range(r.k + 1))
        assert abs(r.p - want) < 1e-9


def test_license_scan_edges(docs, empty):
    assert [(r.doc_id, r.template) for r in license_scan.license_scan(docs).collect()] == [(12, "apache-2.0")]
    assert license_scan.license_scan(empty).count() == 0


def test_license_scan_finds_bare_notices(spark):
    """Against a search of the documents that shares nothing with the templates' shingles or the SQL."""
    import pyarrow.parquet as pq

    sf = SF.replace("sf0.001", "sf0.01")
    found = license_scan.license_scan(table(spark, sf, "documents")).where("template = 'all-rights-reserved-line'")
    texts = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    want = {r["doc_id"] for r in texts if re.search(r"(^|\s)all\s+rights\s+reserved\.(\s|$)", r["text"] or "", re.I)}
    assert want and {r.doc_id for r in found.collect()} == want
    rows = [(1, "All rights reserved."), (2, "all rights"), (3, "x " * 62 + "ALL\nrights reserved. y"), (4, "all rights not reserved.")]
    rows += [(10 + k, f"{LONG} {license_scan.NOTICES[n]} {LONG}") for k, n in enumerate(("isc-text", "gpl-2.0-notice"))]
    got = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    pairs = {(r.doc_id, r.template) for r in got}
    assert {(1, "all-rights-reserved-line"), (3, "all-rights-reserved-line"), (10, "isc-text"), (11, "gpl-2.0-notice")} <= pairs
    assert not {2, 4} & {d for d, _ in pairs}
    short = license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), {"short": "rights", "none": " "})
    assert {r.doc_id for r in short.collect()} == {1, 2, 3, 4}
    assert license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), {}).count() == 0


def test_license_scan_finds_every_notice_beside_others(spark):
    """Every pair and triple of short notices in one window, and every whole text, alone and with a fifth of its words changed."""
    from itertools import combinations

    known = license_scan.TEMPLATES
    sets = [c for n in (1, 2, 3) for c in combinations(sorted(known), n)] + [(n,) for n in license_scan.NOTICES]
    rows = [(k, "word before " + " and then ".join(license_scan.KNOWN[n] for n in c) + " words behind") for k, c in enumerate(sets)]
    got = {(r.doc_id, r.template) for r in license_scan.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {(k, n) for k, c in enumerate(sets) for n in c} <= got
    base = [f"t{k}" for k in range(24)]  # 20 shingles; one changed inner end word loses one to four of them
    near = [" ".join([*base[:-cut], *["other"] * cut]) for cut in range(1, 7)] + [" ".join([*["other"] * cut, *base[cut:]]) for cut in range(1, 7)]
    found = license_scan.license_scan(spark.createDataFrame(list(enumerate(near)), "doc_id long, text string"), {"t": " ".join(base)})
    assert {r.doc_id for r in found.collect()} == {k for k in range(12) if k % 6 < 4}


def test_chat_format(spark):
    rows = [(1, 1, "assistant", "### x </turn>"), (1, 0, "user", r"\### \\</turn> é"), (2, None, None, None), (None, 0, "assistant", "\n"),
            (1, 2, "assistant", "b"), (1, 2, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("start", F.lit(1))
    got = {r.conv_id: r for r in chat_format.chat_format(df, chat_format.byte_bpe_path()).collect()}
    for conv in (1, 2, None):
        turns = sorted(((-1 if t is None else t), r or "", x or "") for c, t, r, x in rows if c == conv)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        assert (got[conv].n_turns, got[conv].loss_chars) == (len(turns), len(loss))
        assert got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat_format.chat_format(df.limit(0), chat_format.byte_bpe_path()).count() == 0


def test_toxicity_holds_out_and_separates(spark, docs, empty):
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)], "doc_id long, toxic int")
    texts = spark.createDataFrame([(i, " ".join(f"t{(i * 7 + k) % 50}" for k in range(20)) + (" rotten" if i % 3 == 0 else "")) for i in range(400)],
                                  "doc_id long, text string")
    rows = toxicity.toxicity(texts, labels).where("held_out").collect()
    assert rows and all((r.score >= 0.3) == (r.doc_id % 3 == 0) == (r.predicted == 1) for r in rows)
    assert toxicity.toxicity(docs, labels.limit(0)).count() == len(TEXTS)
    assert toxicity.toxicity(empty, labels).count() == 0


def test_factorization_machine_learns_a_pair():
    rng = np.random.default_rng(0)
    x = rng.random((600, 6)) < 0.5
    y = (x[:, 0] == x[:, 1]).astype(float)  # no single term tells
    row, term = np.nonzero(x)
    w, v, b = toxicity.train(row, term, y, np.full(600, 1 / 600), 6, 0.0, steps=600)
    assert ((toxicity.scores(row, term, 600, w, v, b)[0] > 0) == (y > 0)).mean() > 0.95


def test_masked_lm(spark, docs, empty):
    texts = spark.createDataFrame([(i, " ".join(f"q{(i + k) % 12}" for k in range(200))) for i in range(150)], "doc_id long, text string")
    net = masked_lm.train(texts)
    order = texts.select("doc_id", F.concat_ws(" ", F.reverse(F.split("text", " "))).alias("text"))
    mean = lambda d: d.agg(F.avg("mean_log_likelihood")).first()[0]
    assert mean(masked_lm.masked_lm_scores(texts, net=net)) > mean(masked_lm.masked_lm_scores(order, net=net))
    ctx = np.full((1, 4), 3)
    total = sum(np.exp(masked_lm.log_probability(net, np.repeat(ctx, masked_lm.CODES, 0), np.arange(masked_lm.CODES))))
    assert abs(total - 1) < 1e-3
    got = {r.doc_id: r for r in masked_lm.masked_lm_scores(docs, net=net).where("doc_id in (4, 5, 8)").collect()}
    assert all(r.n_words == 0 and r.log_likelihood == 0 and r.mean_log_likelihood is None for r in got.values()) and len(got) == 3
    assert masked_lm.masked_lm_scores(empty).count() == 0


def test_masked_lm_trains_on_every_word(monkeypatch):
    import types

    import pyarrow as pa

    monkeypatch.setattr(masked_lm, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    trained = Counter()
    monkeypatch.setattr(masked_lm, "step", lambda net, seen, ctx, code: trained.update(code.tolist()))
    texts, data = [LONG, "one", "", " ".join(f"x{k}" for k in range(9001))], Counter()
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])

    def collect(frame):
        return np.concatenate([np.frombuffer(r, "<f4") for b in frame for r in b.column("sums").to_pylist()])

    class Texts:
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run(iter([batch]))

    monkeypatch.setattr(masked_lm, "id_and_text", lambda *_: Texts())
    monkeypatch.setattr(masked_lm, "_average", collect)
    masked_lm.train(None, totals=np.ones(masked_lm.CODES, np.int64))
    for t in texts:
        b = t.encode()
        data.update(masked_lm.codes_of(np.frombuffer(b, np.uint8), np.array([0, len(b)]))[0].tolist())
    assert trained == data


def test_masked_lm_tells_words_of_one_code_apart(spark, monkeypatch):
    def code(w):
        b = w.encode()
        return masked_lm.codes_of(np.frombuffer(b, np.uint8), np.array([0, len(b)]))[0][0]

    names, of = [f"q{k}" for k in range(12)], {}
    for k in range(200_000):
        of.setdefault(code(f"j{k}"), f"j{k}")
        if all(code(w) in of for w in names) and k > 50_000:
            break
    prose = [" ".join(names[(i + k) % 12] for k in range(200)) for i in range(150)]
    junk = " ".join(of[code(w)] for w in prose[0].split())
    texts = spark.createDataFrame(list(enumerate([*prose, junk, None])), "doc_id long, text string")
    net, words = masked_lm.train(texts), masked_lm.word_counts(texts)
    counts = Counter(w for t in (*prose, junk) for w in t.split())
    assert sorted(r.n for r in words.collect()) == sorted(counts.values())
    want = {}
    for bits in (masked_lm.FREQUENT_BITS, 4):  # all words sent, then the junk words joined by shuffle
        monkeypatch.setattr(masked_lm, "FREQUENT_BITS", bits)
        got = {r.doc_id: r for r in masked_lm.masked_lm_scores(texts, net=net, words=words).collect()}
        assert len(got) == 152 and got[151].n_words == 0
        # same codes, so the network alone scores both alike; the difference is that of the words' counts
        differs = sum(np.log(counts[a] / counts[b]) for a, b in zip(prose[0].split(), junk.split(), strict=True))
        assert abs(got[0].log_likelihood - got[150].log_likelihood - differs) < 0.01
        want[bits] = [got[k].log_likelihood for k in range(152)]
    a, b = want.values()
    assert np.allclose(a, b, atol=0.01)
    gone = masked_lm.masked_lm_scores(spark.createDataFrame([(1, "neverseen")], "doc_id long, text string"), net=net, words=words).first()
    assert gone.n_words == 1 and gone.log_likelihood < 0


def test_bpe_matches_the_library(spark, docs, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe_automaton.word_bpe_path())
    texts = [r.text or "" for r in table(spark, SF, "documents").collect()]
    texts += ["", "aaa aaaa", "<|endoftext|>x", "İß'll 12\x1cΣς ſt", "日本🙂 a\u0301"] + [x or "" for _, x, _ in TEXTS]
    mine = bpe_automaton.tokenizer(bpe_automaton.word_bpe_path())
    for x in texts:
        ids = t.encode(x, add_special_tokens=False).ids
        assert mine.encode(x) == ids
        assert mine.digest(x)[2] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe_automaton.encode_documents(docs, bpe_automaton.word_bpe_path()).count() == len(TEXTS)
    assert bpe_automaton.encode_documents(empty, bpe_automaton.word_bpe_path()).count() == 0


def test_mixing(spark, docs, empty):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(TEXTS) and all(r.taken <= 3 * r["size"] for r in rows)
    assert mixing.mix(empty).count() == 0
    full = mixing.mix(table(spark, SF, "documents"))
    per = full.groupBy("source").agg(F.sum("size").alias("s"), F.max("target").alias("t"), F.sum("taken").alias("k"), F.max("size").alias("m")).collect()
    names = sorted(r.source for r in per)
    cap, left, share = {r.source: 3.0 * r.s for r in per}, {n: i % 3 + 1 for i, n in enumerate(names)}, {}
    rest = float(sum(r.s for r in per))
    while left:  # water filling by repeated resharing
        level = rest / sum(left.values())
        over = [n for n in left if level * left[n] > cap[n]]
        for n in over or list(left):
            share[n] = cap[n] if over else level * left[n]
            rest -= share[n]
            del left[n]
    for r in per:
        assert abs(r.t - share[r.source]) < 1e-6 and abs(r.k - r.t) <= 2 * r.m
    again = mixing.mix(table(spark, SF, "documents").repartition(5))
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, full.collect()))


def test_splitting_tree_keeps_quotas(spark):
    quota = spark.createDataFrame([("a", 1, 40, 7), ("b", 0, 10, 3), (None, 2, 5, 0)], "source string, passes long, blocks long, quota long")
    runs = mixing.split_tree(quota, shards=8).collect()
    for s, n in (("a", 47), ("b", 3), (None, 10)):
        mine = sorted((r["first"], r["last"]) for r in runs if r.source == s)
        assert mine[0][0] == 0 and mine[-1][1] == n and all(x[1] == y[0] for x, y in zip(mine, mine[1:], strict=False))


def test_pipeline(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    good = {r.doc_id for r in registry.QUERIES["op4_quality_rules"](spark, SF).where("kept").collect()}
    best = {}
    for d in good:
        best[docs[d].text] = max(best.get(docs[d].text, -1), d)
    left = [(d, docs[d].text, docs[d].source) for d in best.values()]
    alone = [d for d, _, c in _components(left) if c == d]
    taken = {r.doc_id: r.passes + r.drawn for r in mixing.mix(spark.createDataFrame([docs[d] for d in alone], table(spark, SF, "documents").schema)).collect()}
    assert Counter(r.doc_id for r in rows) == Counter({d: n for d, n in taken.items() if n})
