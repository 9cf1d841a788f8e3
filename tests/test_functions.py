"""Scalar expressions on hand-made edge rows."""


from marquee import schema as S
from marquee.functions import (
    is_company_name,
    normalise_category,
    pad_month,
    split_tokens,
    strip_company_text,
    strip_genre_text,
)


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_strip_genre_and_company_text(spark):
    rows = [("Drama, Sci-Fi é & Co.",), (None,), ("株式会社",)]
    assert one(spark, rows, "t string", strip_genre_text("t")) == ["Drama, SciFi   Co", None, ""]
    assert one(spark, rows, "t string", strip_company_text("t")) == ["Drama, SciFi   Co.", None, ""]


def test_status_normalisation(spark):
    rows = [(" released ",), ("Rumored",), (None,), ("In Production",), ("rumoured",)]
    got = one(spark, rows, "s string", normalise_category("s", S.STATUS_ALLOW))
    assert got == ["released", "Others", "Others", "In Production", "rumoured"]


def test_pad_month_keeps_null(spark):
    assert one(spark, [(1,), (12,), (None,)], "m int", pad_month("m")) == ["01", "12", None]


def test_split_tokens(spark):
    rows = [("Drama, Comedy",), ("Drama,Comedy",), ("",), (None,)]
    assert one(spark, rows, "g string", split_tokens("g")) == [["Drama", "Comedy"], ["Drama,Comedy"], [""], None]


def test_company_name_predicate(spark):
    rows = [("pixar.studio",), ("a.b. films",), ("short",), ("sixsix",), ("two..dots",), ("x1studio",), (None,)]
    got = one(spark, rows, "c string", is_company_name("c"))
    assert got == [True, False, False, True, False, False, None]


def test_parse_malformed_is_null_under_ansi(spark):
    from marquee.functions import parse_as
    from pyspark.sql import types as T

    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    rows = [("abc", "2020-13-45"), ("12", "2020-02-29"), (None, None)]
    df = spark.createDataFrame(rows, "n string, d string")
    out = df.select(parse_as("n", T.IntegerType()).alias("n"), parse_as("d", T.DateType()).alias("d")).collect()
    assert [r.n for r in out] == [None, 12, None]
    assert [str(r.d) if r.d else None for r in out] == [None, "2020-02-29", None]
