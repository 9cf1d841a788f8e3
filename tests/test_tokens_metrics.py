"""Token explode/filter, grouped metrics, grouping sets, top-k."""

from decimal import Decimal

from pyspark.sql import functions as F

from marquee import schema as S
from marquee.operators import metrics, tokens, topk

D = Decimal


def cleaned(spark):
    rows = [
        (1, "2001", "01", D("1.00"), D("2.00"), "Drama, Comedy", "pixar.studio, na, brand, a.b. films"),
        (2, "2001", "02", D("2.00"), D("4.00"), "drama, SciFi", "pixar.studio, warner.bros"),
        (3, "2002", "01", D("3.00"), D("7.00"), "NA", "NA"),
        (4, "2002", "02", D("4.00"), D("4.00"), None, None),
    ]
    return spark.createDataFrame(
        rows, "id bigint, year string, month string, budget decimal(18,2), revenue decimal(18,2), genres string, "
        "production_companies string")


def test_genre_rows(spark):
    g = tokens.genre_rows(cleaned(spark))
    assert sorted((r.id, r.genres) for r in g.collect()) == [(1, "comedy"), (1, "drama"), (2, "drama"), (3, "na")]


def test_company_rows(spark):
    c = tokens.company_rows(cleaned(spark))
    assert sorted((r.id, r.pc) for r in c.collect()) == [(1, "pixar.studio"), (2, "pixar.studio"), (2, "warner.bros")]


def test_filter_inside_array_equals_filter_after_explode(spark):
    df = cleaned(spark)
    inside = tokens.genre_rows(df)
    after = (df.withColumn("g", F.explode(F.split(F.lower("genres"), ", "))).withColumn("g", F.trim("g"))
             .filter(F.col("g").isin(S.GENRE_ALLOW)))
    assert sorted((r.id, r.genres) for r in inside.collect()) == sorted((r.id, r.g) for r in after.collect())


def test_metrics_and_grouping_sets_agree(spark):
    g = tokens.genre_rows(cleaned(spark))
    by_year = {(r.year, r.genres): r for r in metrics.grouped_metrics(g, ["year", "genres"]).collect()}
    sets = metrics.metrics_at_grains(g, [["year", "genres"], ["month", "genres"], ["genres"]]).collect()
    year_rows = {(r.year, r.genres): r for r in sets if r.grain == 1}
    assert set(by_year) == set(year_rows)
    for k, r in by_year.items():
        assert (r.total_movies, r.total_budget, r.total_revenue) == (
            year_rows[k].total_movies, year_rows[k].total_budget, year_rows[k].total_revenue)
    drama = [r for r in sets if r.grain == 5 and r.genres == "drama"][0]
    assert drama.total_movies == 2 and drama.total_budget == 3.0 and abs(drama.budget_revenue_correlation - 1) < 1e-12


def test_count_both_zero_and_frequency(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (0.0, 0.0)], "a double, b double")
    assert metrics.count_both_zero(df, "a", "b").collect()[0].both_zero == 2
    c = tokens.company_rows(cleaned(spark))
    assert {r.pc: r["count"] for r in metrics.frequency(c, "pc").collect()} == {"pixar.studio": 2, "warner.bros": 1}
    got = metrics.count_groups(c, "pc", min_count=1).collect()[0]
    assert (got.groups, got.groups_over_1) == (2, 1)


def test_top_k_is_deterministic_with_ties(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(20)], "id int, v int")
    got = [r.id for r in topk.top_k(df, 4, [F.desc("v")], ["id"]).collect()]
    assert got == [2, 5, 8, 11]
    plan = topk.top_k(df, 4, [F.desc("v")], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
