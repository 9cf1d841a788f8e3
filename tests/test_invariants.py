"""Invariants over the derived catalogue at sf0.001 and the job CLI."""

import os

import pytest
from pyspark.sql import functions as F

from marquee.operators import growth, tokens
from marquee.operators.cleaning import outlier_counts
from marquee.plans import catalogue as cat
from marquee.sources import tpch_catalogue as tc

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_cleaned_plus_rejected_is_raw(spark):
    raw = cat.raw(spark, SF)
    before = cat.cleaned(spark, SF, "none")
    after = cat.cleaned(spark, SF)
    counts = outlier_counts(before, cat.order_rules()).collect()[0]
    n_raw = raw.count()
    incomplete = raw.filter("release_date is null or revenue is null or budget is null").count()
    assert before.count() == n_raw - incomplete
    assert after.count() == counts.rows_kept <= before.count() <= n_raw
    assert counts.rows_in == counts.runtime_outliers + counts.vote_average_outliers + counts.money_outliers + counts.rows_kept
    assert cat.cleaned(spark, SF, "key").count() == after.count()  # keys are unique here


def test_debuts_sum_to_distinct_entities(spark):
    c = tokens.company_rows(cat.cleaned(spark, SF), tc.ORDER_COMPANY_DENY)
    total = growth.debut_counts(c, "pc").agg(F.sum("debuts")).collect()[0][0]
    assert total == c.select("pc").distinct().count()


def test_last_running_total_is_grand_total(spark):
    cl = cat.cleaned(spark, SF)
    d = growth.distinct_per_group(cl, "year", "title", "n")
    g = growth.growth_frame(d, "year", "n").orderBy(F.desc("year")).first()
    assert g.pc_yoy_growth_count == d.agg(F.sum("n")).collect()[0][0]


def test_cli_jobs_end_to_end(spark, scratch):
    from marquee.__main__ import main

    src = scratch("cli-src")
    text = tc.catalogue_text(spark, SF)
    cols = ["id", "title", "vote_average", "vote_count", "status", "release_date", "revenue", "runtime", "budget",
            "genres", "production_companies"]
    from marquee import schema as S

    full = text.select([F.col(c) if c in cols else F.lit(None).cast("string").alias(c) for c in S.RAW_COLUMNS])
    full.coalesce(2).write.option("header", "true").option("escape", '"').csv(src)
    raw, flt, rep, raw2, ckpt = (scratch(n) for n in ("cli-raw", "cli-flt", "cli-rep", "cli-raw2", "cli-ckpt"))
    main(["--local", "ingest", "--source", src, "--raw", raw])
    main(["--local", "ingest", "--source", src, "--raw", raw])
    main(["--local", "stream", "--source", src, "--raw", raw2, "--checkpoint", ckpt])
    main(["--local", "transform", "--raw", raw, "--filtered", flt])
    main(["--local", "report", "--filtered", flt, "--out", rep])
    raw_rows = spark.read.parquet(raw).count()
    assert raw_rows == text.count() == spark.read.parquet(raw2).count()
    # the generic rules keep no order status ("F"/"O"/"P" are not in the allow-list) but drop no row for it
    assert spark.read.parquet(flt).filter("status <> 'Others'").count() == 0
    assert spark.read.parquet(f"{rep}/releases_per_year").agg(F.sum("releases")).collect()[0][0] == \
        spark.read.parquet(flt).count()


def test_eda_entries_run(spark):
    from marquee.operators.cleaning import clean
    from marquee.plans.jobs import eda

    raw = cat.raw(spark, SF)
    report = eda(raw, clean(raw, status_allow=tc.ORDER_STATUS_ALLOW, outlier_mode="none"))
    for name, df in report.items():
        df.write.format("noop").mode("overwrite").save()
    assert report["outlier_counts"].first().rows_in == cat.cleaned(spark, SF, "none").count()
