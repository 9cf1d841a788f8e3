"""Property tests: operators against brute-force Python on random inputs (hypothesis)."""

import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from marquee.functions import distinct_with_null, strip_company_text, strip_genre_text
from marquee.operators import growth
from marquee.operators.incremental import new_rows

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

# Java's \s (no UNICODE_CHARACTER_CLASS) is exactly these six characters.
JAVA_WS = " \t\n\x0b\f\r"
text = st.text(alphabet=st.sampled_from(list("abcXYZ ,.-_é&1\t\n\x0b\f\r  漢😀")), max_size=40)


@SETTINGS
@given(st.lists(st.one_of(st.none(), text), min_size=1, max_size=30))
def test_strip_matches_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    got = {r.i: (r.g, r.c) for r in df.select("i", strip_genre_text("t").alias("g"),
                                               strip_company_text("t").alias("c")).collect()}
    for i, v in enumerate(values):
        exp_g = None if v is None else re.sub(f"[^a-zA-Z{re.escape(JAVA_WS)},]", "", v)
        exp_c = None if v is None else re.sub(f"[^a-zA-Z{re.escape(JAVA_WS)},.]", "", v)
        assert got[i] == (exp_g, exp_c)


pairs = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("abcdef")),
                           st.one_of(st.none(), st.integers(1990, 1995))), min_size=1, max_size=40)


@SETTINGS
@given(pairs)
def test_debut_counts_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "e string, year int")
    got = {r.year: r.debuts for r in growth.debut_counts(df, "e").collect()}
    years = defaultdict(list)
    for e, y in rows:
        if e is not None:
            years[e].append(y)
    exp = defaultdict(int)
    for e, ys in years.items():
        exp[None if None in ys else min(ys)] += 1
    assert got == dict(exp)
    assert sum(got.values()) == len(years)


@SETTINGS
@given(st.lists(st.integers(0, 50), min_size=1, max_size=15, unique=True), st.data())
def test_running_sums_match_prefix_sums(spark, years, data):
    vals = data.draw(st.lists(st.integers(0, 1000), min_size=len(years), max_size=len(years)))
    df = spark.createDataFrame(list(zip(years, vals)), "year int, v long")
    got = growth.growth_frame(df, "year", "v").orderBy("year").collect()
    pairs_sorted = sorted(zip(years, vals))
    running = 0
    for r, (_, v) in zip(got, pairs_sorted):
        assert r.prev_yr_pc_count == running
        running += v
        assert r.pc_yoy_growth_count == running
    assert got[-1].pc_yoy_growth_count == sum(vals)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 20)), st.sampled_from("xyz")), max_size=30),
       st.lists(st.one_of(st.none(), st.integers(0, 20)), max_size=20))
def test_new_rows_match_set_semantics(spark, batch, existing):
    b = spark.createDataFrame(batch, "id long, v string")
    e = spark.createDataFrame([(k,) for k in existing], "id long")
    got = sorted((r.id, r.v) for r in new_rows(b, e).collect())
    seen = {k for k in existing if k is not None}
    best = {}
    for k, v in batch:
        if k is not None and k not in seen:
            best[k] = max(best.get(k, v), v)
    assert got == sorted(best.items())


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c", ""])), min_size=1, max_size=30))
def test_distinct_with_null_matches_set(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert df.agg(distinct_with_null("v").alias("d")).collect()[0].d == len(set(values))


@SETTINGS
@given(st.lists(st.integers(-10**13, 10**13), min_size=1, max_size=40))
def test_cents_round_trip_is_exact_for_two_decimal_money(spark, cents):
    from decimal import Decimal

    from pyspark.sql import functions as F

    from marquee.functions.stats import from_cents, to_cents

    df = spark.createDataFrame([(c / 100.0,) for c in cents], "x double")
    got = df.agg(from_cents(F.sum(to_cents("x"))).alias("s")).collect()[0].s
    assert got == sum(Decimal(c) for c in cents) / 100
    assert got == df.agg(F.sum(F.col("x").cast("decimal(18,2)")).alias("s")).collect()[0].s
