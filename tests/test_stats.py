"""ANSI-safe correlation and null/distinct counts."""

import math

import pandas as pd

from marquee.functions import distinct_with_null, null_count, safe_corr


def test_corr_matches_pandas_on_complete_pairs(spark):
    rows = [("a", 1.0, 2.0), ("a", 2.0, 4.5), ("a", 3.0, None), ("a", None, 7.0), ("a", 4.0, 7.9), ("a", 5.0, 9.0)]
    df = spark.createDataFrame(rows, "g string, b double, r double")
    got = df.groupBy("g").agg(safe_corr("b", "r").alias("c")).collect()[0].c
    pdf = pd.DataFrame(rows, columns=["g", "b", "r"]).dropna()
    assert math.isclose(got, pdf.b.corr(pdf.r), rel_tol=1e-12)


def test_corr_undefined_groups_are_null_not_errors(spark):
    rows = [("one", 1.0, 2.0), ("const", 5.0, 1.0), ("const", 5.0, 2.0), ("nopair", None, 1.0), ("nopair", 2.0, None)]
    df = spark.createDataFrame(rows, "g string, b double, r double")
    got = {r.g: r.c for r in df.groupBy("g").agg(safe_corr("b", "r").alias("c")).collect()}
    assert got == {"one": None, "const": None, "nopair": None}


def test_distinct_with_null_equals_distinct_count(spark):
    rows = [("x",), ("y",), (None,), ("x",), (None,)]
    df = spark.createDataFrame(rows, "v string")
    got = df.agg(distinct_with_null("v").alias("d"), null_count("v").alias("n")).collect()[0]
    assert got.d == df.select("v").distinct().count() == 3
    assert got.n == 2
    assert df.filter("v is not null").agg(distinct_with_null("v").alias("d")).collect()[0].d == 2
