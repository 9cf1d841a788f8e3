"""Summaries of a growing zone that are stored per part and merged.

A part (a month's folder, a load) is summarised once, when it is written; the
whole zone's figures come from the summaries, whose number does not grow with the
rows. Counts, NULLs and sums merge exactly, moments by the update for parts of
known means, distinct values as HyperLogLog sketches of a fixed size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Registers of a sketch as a power of two; the relative standard error is 1.04 / sqrt(2**LG_K).
LG_K = 14
SKETCH_ERROR = 1.04 / 2 ** (LG_K / 2)


def column_summary(df: DataFrame, part: str, cols: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """(part, column, rows, nulls, sketch): one row per part and column, one aggregate over one scan."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        aggs += [F.count_if(F.col(c).isNull()).alias(f"n{i}"), F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(f"s{i}")]
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(cols)])
    wide = df.groupBy(F.col(part).cast("string").alias("part")).agg(*aggs)
    return wide.select("part", "rows", F.explode(entries).alias("e")).select("part", "e.column", "rows", "e.nulls", "e.sketch")


def merged_columns(summary: DataFrame) -> DataFrame:
    """(column, rows, nulls, distinct_values) of all parts together; NULL counts as one value, as in the exact profile."""
    total = summary.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("_n"))
    return total.select("column", "rows", "nulls", (F.col("_n") + F.when(F.col("nulls") > 0, F.lit(1)).otherwise(F.lit(0))).alias("distinct_values"))


def pair_moments(df: DataFrame, keys: Sequence[str], x: str = "budget", y: str = "revenue") -> DataFrame:
    """Counts, exact sums and co-moments of two measures per group: what totals and a correlation need later.

    ``n`` counts rows; the means and moments are over the rows with both values.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x).cast("double")), F.when(both, F.col(y).cast("double"))
    pairs = F.count(a)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("sum_x"), F.sum(y).alias("sum_y"), pairs.alias("pairs"),
        F.avg(a).alias("mean_x"), F.avg(b).alias("mean_y"), (F.var_pop(a) * pairs).alias("m2_x"), (F.var_pop(b) * pairs).alias("m2_y"),
        (F.covar_pop(a, b) * pairs).alias("c_xy"))


def merged_moments(stored: DataFrame, keys: Sequence[str], x: str = "total_budget", y: str = "total_revenue",
                   corr: str = "budget_revenue_correlation") -> DataFrame:
    """Titles, totals and correlation per ``keys`` from the stored groups of any finer grain or of several loads.

    Groups with means ``m_i`` merge as ``C = sum(C_i) + sum(n_i (mx_i - mx)(my_i - my))``,
    which adds no large squares. A correlation without spread is NULL.
    """
    over = W.partitionBy(*keys)  # stored groups, not rows of data
    n = F.sum("pairs").over(over)
    weighted = stored.withColumns({
        "_dx": F.col("mean_x") - F.sum(F.col("pairs") * F.col("mean_x")).over(over) / n,
        "_dy": F.col("mean_y") - F.sum(F.col("pairs") * F.col("mean_y")).over(over) / n})
    moved = lambda c, d, e: F.sum(F.col(c) + F.col("pairs") * F.col(d) * F.col(e))
    total = weighted.groupBy(*keys).agg(
        F.sum("n").alias("total_movies"), F.sum("sum_x").alias(x), F.sum("sum_y").alias(y),
        moved("c_xy", "_dx", "_dy").alias("_c"), moved("m2_x", "_dx", "_dx").alias("_x"), moved("m2_y", "_dy", "_dy").alias("_y"))
    return total.select(*keys, "total_movies", x, y, F.try_divide("_c", F.sqrt(F.col("_x") * F.col("_y"))).alias(corr))


MOMENT_COLUMNS = ["n", "sum_x", "sum_y", "pairs", "mean_x", "mean_y", "m2_x", "m2_y", "c_xy"]


def moment_schema(keys: dict[str, T.DataType], money: T.DataType) -> T.StructType:
    """Schema of stored ``pair_moments`` (sums of ``money`` widen by ten digits)."""
    wide = T.DecimalType(min(38, money.precision + 10), money.scale) if isinstance(money, T.DecimalType) else money
    kinds = {"n": T.LongType(), "sum_x": wide, "sum_y": wide, "pairs": T.LongType()}
    return T.StructType([T.StructField(k, t) for k, t in keys.items()] + [T.StructField(c, kinds.get(c, T.DoubleType())) for c in MOMENT_COLUMNS])
