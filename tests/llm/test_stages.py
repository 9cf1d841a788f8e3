"""The pipeline's stages on nulls, empties, repeated ids and clashing names; the bitmap split; limits on their far side."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import bitmap, exact_dedup, mixing, ngram_join, quality_rules
from marquee.llm.components import components
from marquee.llm.scratch import written
from marquee.sources.tables import table

SF = "/root/testdata/sf0.001"
A = " ".join(f"w{i * i % 997}" for i in range(200))
B = " ".join(f"v{i * i % 997}" for i in range(200))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, A, "en", "a", 1), (2, A + " more", "en", "a", 2), (2, B, "en", None, 3), (3, B + " tail", None, "b", 4), (4, None, "en", "b", 0),
    (5, "", None, None, 0), (None, A, "de", "c", 5), (None, None, None, None, None), (6, "one two", "en", "a", 7), (7, "one two", "en", "a", 7),
    (7, "one two", "en", "a", 7), (8, "long " * 60_000, "en", "c", 300_000),
]


def clash(df):
    return df.withColumns({c: F.lit(i) for i, c in enumerate(("comp", "node", "h", "key", "size", "block", "runs", "cut", "stratum", "carry", "kept", "_s", "row_key"))})


@pytest.fixture(scope="module")
def docs(spark):
    return clash(spark.createDataFrame(ROWS, SCHEMA))


def own(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


# -- bitmap -----------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 3000])
def test_bitmap_splits_without_losing_a_row(spark, n):
    keys = written(spark.range(n).select(F.xxhash64("id").alias("h")), "keys")
    bits, size = bitmap.bitmap(keys)
    assert bits.count() == 1 and size >= 16 * n and len(bits.first()[0]) * 64 == size
    rows = spark.range(20_000)
    possible, others = bitmap.split(rows, F.xxhash64("id"), bits, size)
    assert possible.count() + others.count() == 20_000
    assert possible.where(f"id < {n}").count() == n  # members are never taken for others
    assert possible.count() - n <= 0.05 * (20_000 - n)
    plan = others._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_a_full_bitmap_is_still_right(spark, monkeypatch):
    monkeypatch.setattr(bitmap, "MOST_BITS", 6)
    monkeypatch.setattr(bitmap, "LEAST_BITS", 6)
    keys = written(spark.range(500).select(F.xxhash64("id").alias("h")), "keys")
    possible, others = bitmap.split(spark.range(1000), F.xxhash64("id"), *bitmap.bitmap(keys))
    assert possible.count() + others.count() == 1000 and possible.where("id < 500").count() == 500


# -- stages -----------------------------------------------------------------


def test_exact_dedup_keeps_one_of_equal_texts(docs):
    got = exact_dedup.keep_first(docs)
    assert got.columns == docs.columns
    # of equal texts the largest id's row stays; both of the identical rows 7 do; null and empty are equal
    assert own(got) == Counter({(1, A): 1, (2, A + " more"): 1, (2, B): 1, (3, B + " tail"): 1, (5, ""): 1, (7, "one two"): 2, (8, "long " * 60_000): 1})
    assert exact_dedup.keep_first(docs.limit(0)).count() == 0


def test_near_dedup_decides_rows_that_share_an_id_by_their_text(spark, docs):
    got = own(ngram_join.keep_smallest(docs))
    # 1 stands for A's group, one row of id 2 for B's; a row without an id stays, and so do rows without words
    assert got[(1, A)] == 1 and got[(2, A + " more")] == 0 and got[(2, B)] == 1 and got[(3, B + " tail")] == 0
    assert got[(None, A)] == 1 and got[(None, None)] == 1 and got[(4, None)] == 1 and got[(5, "")] == 1
    assert got[(6, "one two")] == 1 and got[(7, "one two")] == 0 and got[(8, "long " * 60_000)] == 1
    both = spark.createDataFrame([(2, A), (2, A + " more"), (9, A + " x")], "doc_id long, text string")
    assert sum(own(ngram_join.keep_smallest(both)).values()) == 1  # near copies under one id: one stays
    assert ngram_join.keep_smallest(docs.limit(0)).count() == 0
    assert ngram_join.keep_smallest(docs).columns == docs.columns


def test_quality_stage_measures_labelled_rows_for_its_cutoffs(spark):
    every, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    want = {r["doc_id"] for r in quality_rules.quality_rules(every, labels).where("kept").collect()}
    assert {r["doc_id"] for r in quality_rules.keep_good(every, labels).collect()} == want


def test_quality_stage_edges(spark, docs):
    labels = spark.createDataFrame([(1, 1), (8, 0), (None, 1), (77, 0)], "doc_id long, quality int")
    got = quality_rules.keep_good(docs, labels)
    assert got.columns == docs.columns
    assert own(got) == Counter({(1, A): 1, (2, A + " more"): 1, (2, B): 1, (3, B + " tail"): 1, (None, A): 1})
    assert quality_rules.keep_good(docs.limit(0), labels).count() == 0 and own(quality_rules.keep_good(docs, labels.limit(0))) == own(got)


@pytest.mark.parametrize("bits", [24, 3])
def test_repeated_words_beyond_the_position_bits(spark, bits):
    """Texts of more windows than a sort key holds positions for are counted by pairs, with the same result."""
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(list("abc"), n)) for n in (0, 1, 2, 3, 5, 7, 8, 9, 40, 200)] + ["x y z x y z", "a b c d e f g h i j k"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r["n"] for r in df.select(quality_rules.let(quality_rules.word_array(F.col("text")), lambda w: quality_rules.repeat_words(w, bits)).alias("n")).collect()]
    for t, n in zip(texts, got, strict=True):
        w = t.split()
        seen = Counter(zip(w, w[1:], w[2:], strict=False))
        assert n == len({i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}), t


def test_counts_of_a_text_with_very_many_shingles():
    for most in (65_535, 65_536, 70_000, 10**6):
        counts = np.array([0, most, 3])
        assert (ngram_join._counts(ngram_join._counted(counts)) == counts).all()
    # the wide form has an odd number of bytes, the narrow one an even number
    assert len(ngram_join._counted(np.array([70_000]))) % 2 == 1 and len(ngram_join._counted(np.array([5]))) % 2 == 0


def test_components_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    ring = [(200 + i, 200 + (i + 1) % 17) for i in range(17)]
    star = [(300, 300 + i) for i in range(1, 200)]
    links = spark.createDataFrame(chain + ring + star + [(5, 5), (1, 2), (2, 1), (1, 2)], "a long, b long")
    got = {r["node"]: r["comp"] for r in components(links).collect()}
    want = {**{i: 100 for i in range(100, 161)}, **{200 + i: 200 for i in range(17)}, **{300 + i: 300 for i in range(200)}, 1: 1, 2: 1}
    assert got == want
    assert components(links.limit(0)).count() == 0


# -- mixing through the tree ------------------------------------------------


def test_copies_are_the_draws_of_the_tree(spark):
    """Every copy lies in the one shard whose run holds its block's draw, and copies, quotas and taken words agree."""
    docs = table(spark, SF, "documents")
    plan = mixing.Mixture(docs, shards=8)
    quota = {r["source"]: r for r in plan.quota.collect()}
    tree = {}
    for r in mixing.split_tree(plan.quota, 8).collect():
        tree.setdefault(r["source"], []).append((r["first"], r["last"], r["shard"]))
    placed = {r["doc_id"]: r for r in plan.rows.collect()}
    want = Counter()
    for d, r in placed.items():
        q = quota[r["source"]]
        b = min(r["block"], q["blocks"] - 1)
        for p in range(q["passes"] + 1):
            if p < q["passes"] or b < q["quota"]:
                draw = p * q["blocks"] + b
                want[d, next(s for first, last, s in tree[r["source"]] if first <= draw < last)] += 1
    got = Counter((r["doc_id"], r["_mix_shard"]) for r in plan.copies(docs).collect())
    assert got == want and len({s for _, s in got}) > 1
    taken = {r["doc_id"]: r for r in plan.taken().collect()}
    for d, r in taken.items():
        copies = sum(n for (x, _), n in want.items() if x == d)
        assert r["taken"] == copies * r["size"] and r["drawn"] == (copies > r["passes"])
    mixed = plan.shuffled(docs)
    assert mixed.columns == docs.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({d: sum(n for (x, _), n in want.items() if x == d) for d in placed if any(x == d for x, _ in want)})
    again = mixing.Mixture(docs.repartition(7), shards=8)
    assert Counter((r["doc_id"], r["_mix_shard"]) for r in again.copies(docs).collect()) == want


def test_mixing_edges(spark, docs):
    got = mixing.mix(docs)
    assert got.count() == len(ROWS) and got.where("taken > 3 * size").count() == 0
    per = got.groupBy("source").agg(F.sum("size").alias("s"), F.max("target").alias("t"), F.sum("taken").alias("k")).collect()
    assert {r["source"] for r in per} == {"a", "b", "c", None}
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    times = Counter((r["doc_id"], r["text"]) for r in mixed.collect())
    for r in spark.createDataFrame(ROWS, SCHEMA).collect():  # rows that share an id are each decided by their own text
        assert times[(r["doc_id"], r["text"])] <= 3 * ROWS.count(tuple(r)) + 1
    assert mixing.mixed_rows(docs.limit(0)).count() == 0


def test_a_hot_id_with_many_texts_keeps_its_sources_target(spark):
    """A third of all rows under one id: what a source gives stays within a block and a document of its target."""
    rows = [(0 if i % 3 == 0 else i, " ".join(f"w{i}" for _ in range(i % 7 + 1)), "s" if i % 2 else "t") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    per = mixing.mix(docs).groupBy("source").agg(F.max("target").alias("t"), F.sum("taken").alias("k"), F.max("source_size").alias("s")).collect()
    for r in per:
        assert abs(r["t"] - r["k"]) <= max(1, r["s"] // mixing.MIN_BLOCKS) + 7
    words = Counter()
    for r in mixing.mixed_rows(docs).collect():
        words[r["source"]] += len(r["text"].split())
    assert {r["source"]: r["k"] for r in per} == dict(words)


@pytest.mark.parametrize("counts", [[10**9, 5, 0, 3 * 10**9 + 1], [2**40, 2**41 + 1, 7]])
def test_a_node_of_huge_counts_is_split_exactly(counts):
    counts = np.array(counts, np.int64)
    left, right = mixing.split_node(counts, 1, 2, "r", 20)
    assert ((left + right) == counts).all() and (left >= 0).all() and (right >= 0).all()
    assert (abs(left - counts / 3) <= 1).all() and abs(left.sum() - counts.sum() / 3) <= 1
    again = mixing.split_node(counts, 1, 2, "r", 20)
    assert (again[0] == left).all()


def test_rules_share_the_risk(spark):
    """A cutoff passes by its own share: with three rules a third of the risk, alone all of it."""
    rows = [("s", 0.5 if i < 8 else 0.0, 0.0, 0.0, 1) for i in range(1000)]  # eight good documents of a thousand lie above every cutoff
    df = spark.createDataFrame(rows, "stratum string, " + ", ".join(f"{r} double" for r in quality_rules.RULES) + ", good int")
    first = next(iter(quality_rules.RULES))
    alone = quality_rules.cutoffs(df, {first: [0.4]}, risk=0.03)
    shared = quality_rules.cutoffs(df, {r: [0.4] for r in quality_rules.RULES}, risk=0.03)
    assert [r["rule"] for r in alone.collect()] == [first]
    assert first not in {r["rule"] for r in shared.collect()} and shared.count() == 2
