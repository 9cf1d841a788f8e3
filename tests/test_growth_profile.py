"""Debut cohorts, running sums, profile."""

from pyspark.sql import functions as F
from pyspark.sql import Window

from marquee.operators import growth, profile


def test_debut_counts_once_in_first_year(spark):
    rows = [("a", "2001"), ("a", "2003"), ("b", "2001"), ("c", "2002"), ("c", "2002"), (None, "2001")]
    df = spark.createDataFrame(rows, "e string, year string")
    got = {r.year: r.debuts for r in growth.debut_counts(df, "e").collect()}
    assert got == {"2001": 2, "2002": 1}
    assert sum(got.values()) == df.filter("e is not null").select("e").distinct().count()


def test_debut_equals_dense_rank_form_including_null_years(spark):
    rows = [("a", 2001), ("a", None), ("b", 2003), ("b", 2002), ("c", None)]
    df = spark.createDataFrame(rows, "e string, year int")
    w = Window.partitionBy("e").orderBy("year")
    rank_form = (df.withColumn("r", F.dense_rank().over(w)).filter("r = 1").groupBy("year")
                 .agg(F.count_distinct("e").alias("n")))
    agg_form = growth.debut_counts(df, "e", "year", as_="n")
    assert sorted(map(tuple, rank_form.collect()), key=str) == sorted(map(tuple, agg_form.collect()), key=str)


def test_running_sums(spark):
    df = spark.createDataFrame([("2001", 3), ("2002", 5), ("2003", 2)], "year string, v long")
    g = growth.growth_frame(df, "year", "v").orderBy("year").collect()
    assert [r.prev_yr_pc_count for r in g] == [0, 3, 8]
    assert [r.pc_yoy_growth_count for r in g] == [3, 8, 10]
    inc = growth.with_running_sum(df, "year", "v", "cum", inclusive=True).orderBy("year").collect()
    assert [r.cum for r in inc] == [r.pc_yoy_growth_count for r in g]
    assert inc[-1].cum == 10
    exc = growth.with_running_sum(df, "year", "v", "prior").orderBy("year").collect()
    assert exc[0].prior is None


def test_null_and_distinct_profile(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "a", None), (3, "a", None)], "id int, s string, t string")
    nulls = {r.column_name: r.nulls for r in profile.null_profile(df).collect()}
    assert nulls == {"id": 0, "s": 1, "t": 2}
    dist = {r.column_name: r.distinct_values for r in profile.distinct_profile(df, ["s", "t"]).collect()}
    assert dist == {"s": 2, "t": 2}
    sch = {r.column_name: (r.data_type, r.nulls, r.position) for r in profile.schema_profile(df).collect()}
    assert sch == {"id": ("int", 0, 0), "s": ("string", 1, 1), "t": ("string", 2, 2)}


def test_key_max_is_numeric(spark):
    df = spark.createDataFrame([("9",), ("10",), ("zz",)], "id string")
    r = profile.key_max(df).collect()[0]
    assert (r.rows, r.max_id) == (3, 10)


def test_approximate_distinct_counts_are_close_and_single_pass(spark):
    df = spark.range(0, 20000).select((F.col("id") % 5000).cast("string").alias("v"), (F.col("id") % 7).alias("k"))
    exact = {r.column_name: r.distinct_values for r in profile.distinct_profile(df, ["v", "k"]).collect()}
    approx_df = profile.distinct_profile(df, ["v", "k"], approx=True)
    approx = {r.column_name: r.distinct_values for r in approx_df.collect()}
    assert exact == {"v": 5000, "k": 7}
    assert abs(approx["v"] - 5000) <= 5000 * 0.05 and approx["k"] == 7
    assert "Expand" not in approx_df._jdf.queryExecution().executedPlan().toString()
    per = {r.k: r.n for r in growth.distinct_per_group(df, "k", "v", "n", approx=True).collect()}
    ex = {r.k: r.n for r in growth.distinct_per_group(df, "k", "v", "n").collect()}
    assert set(per) == set(ex) and all(abs(per[k] - ex[k]) <= ex[k] * 0.05 for k in ex)
