"""Plan shapes that keep hot keys safe: pre-aggregation before every shuffle, no per-entity windows."""

from pyspark.sql import functions as F

from marquee.operators import growth, incremental, metrics, tokens
from marquee.functions import safe_corr


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark):
    # one entity holds a third of the rows
    rows = [("hot", 2000 + i % 3, float(i), float(i % 7)) for i in range(300)]
    rows += [(f"e{i}", 2000 + i % 5, float(i), float(i % 11)) for i in range(600)]
    return spark.createDataFrame(rows, "e string, year int, b double, r double")


def test_debut_is_an_aggregate_with_partial_phase(spark):
    p = plan(growth.debut_counts(hot(spark), "e"))
    assert "Window" not in p
    assert "partial_min" in p and "partial_max" in p


def test_metrics_pre_aggregate_a_hot_group(spark):
    df = hot(spark).withColumnRenamed("e", "genres")
    p = plan(metrics.grouped_metrics(df, ["genres"], [F.count("b").alias("n"), safe_corr("b", "r").alias("c")]))
    assert "partial_covar_pop" in p and "partial_count" in p
    p2 = plan(metrics.metrics_at_grains(df.withColumnRenamed("b", "budget").withColumnRenamed("r", "revenue")
                                        .withColumn("id", F.lit(1)), [["year", "genres"], ["genres"]]))
    assert p2.count("Expand") == 1 and "partial_count" in p2


def test_dedupe_and_anti_join_reduce_keys_before_joining(spark):
    batch = hot(spark).withColumnRenamed("e", "id")
    sink = hot(spark).select(F.col("e").alias("id"))
    p = plan(incremental.new_rows(batch, sink, "id"))
    assert "partial_max" in p  # batch rows collapsed per key map-side
    assert "LeftAnti" in p
    assert p.count("HashAggregate(keys=[id") >= 2  # sink keys made distinct (partial + final)


def test_running_sum_window_only_over_per_year_rows(spark):
    per_year = hot(spark).groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    p = plan(growth.growth_frame(per_year, "year", "n"))
    # the single-partition window sits above the per-year aggregate, never on raw rows
    assert p.index("Window") < p.index("HashAggregate(keys=[year")


def test_tokens_filtered_before_explode(spark):
    df = spark.createDataFrame([(1, "Drama, Nope, Comedy")], "id int, genres string")
    p = plan(tokens.genre_rows(df))
    assert "Generate explode(filter(" in p
