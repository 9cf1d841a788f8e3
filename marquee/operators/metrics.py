"""Grouped metrics over the exploded genre rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.stats import safe_corr


def genre_aggregates(
    id_col: str = "id", budget: str = "budget", revenue: str = "revenue", money_as_double: bool = True
) -> list[Column]:
    """total_movies, total_budget, total_revenue, budget_revenue_correlation.

    Money is summed as decimal (exact, independent of partition order) and
    presented as double.
    """
    tb = F.sum(budget)
    tr = F.sum(revenue)
    if money_as_double:
        tb, tr = tb.cast("double"), tr.cast("double")
    return [
        F.count(id_col).alias("total_movies"),
        tb.alias("total_budget"),
        tr.alias("total_revenue"),
        safe_corr(budget, revenue).alias("budget_revenue_correlation"),
    ]


def grouped_metrics(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column] | None = None) -> DataFrame:
    """``groupBy(keys).agg(...)`` with partial (map-side) aggregation; a hot key is pre-aggregated."""
    return df.groupBy(*keys).agg(*(aggs or genre_aggregates()))


def metrics_at_grains(
    df: DataFrame, grains: Sequence[Sequence[str]], aggs: Sequence[Column] | None = None
) -> DataFrame:
    """Several grouping grains in one scan and one shuffle (GROUPING SETS).

    Adds ``grain`` = the ``grouping_id()`` bit mask over the key columns in order
    of first appearance in ``grains`` (a set bit = column absent from the row's
    grain), so a NULL key of an absent grain is told apart from a NULL value.
    """
    cols = []
    for g in grains:
        for c in g:
            if c not in cols:
                cols.append(c)
    sets = [[F.col(c) for c in g] for g in grains]
    return df.groupingSets(sets, *[F.col(c) for c in cols]).agg(
        F.grouping_id().alias("grain"), *(aggs or genre_aggregates())
    )


def count_both_zero(df: DataFrame, a: str, b: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows where both measures are exactly zero (C7), optionally per key."""
    agg = F.count_if((F.col(a) == 0) & (F.col(b) == 0)).alias("both_zero")
    rows = F.count(F.lit(1)).alias("rows")
    return df.groupBy(*keys).agg(rows, agg) if keys else df.agg(rows, agg)


def frequency(df: DataFrame, col: str, min_count: int | None = None) -> DataFrame:
    """Rows per value (F10), optionally only values seen more than ``min_count`` times (C11)."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if min_count is not None:
        out = out.filter(F.col("count") > min_count)
    return out


def count_groups(df: DataFrame, col: str, min_count: int | None = None) -> DataFrame:
    """Number of distinct groups, plain and after HAVING count > ``min_count``."""
    freq = frequency(df, col)
    aggs = [F.count(F.lit(1)).alias("groups")]
    if min_count is not None:
        aggs.append(F.count_if(F.col("count") > min_count).alias(f"groups_over_{min_count}"))
    return freq.agg(*aggs)
