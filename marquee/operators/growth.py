"""Debut cohorts and cumulative sums.

``running_sum`` uses a window with no partition key, which Spark evaluates in
one task. That is safe over an aggregate with one row per year, whose size is
bounded by the number of distinct years, not by the data. Over a finer order
column (days, events) use ``prefix_sums``: the same sums in two levels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def debut_year(df: DataFrame, entity: str, year: str = "year", as_: str = "debut_year") -> DataFrame:
    """First year each entity appears in: the year of its ``dense_rank() = 1`` rows.

    Written as a grouped aggregate instead of a window partitioned by entity:
    the window sends all rows of one entity to one task (a hot entity holding a
    third of the rows would stall the job), while ``min`` aggregates partially
    on the map side. NULL years sort first in the window's ascending order, so
    an entity with any NULL year debuts in the NULL year, as with the rank.
    NULL entities are dropped.
    """
    return (
        df.filter(F.col(entity).isNotNull())
        .groupBy(entity)
        .agg(F.max(F.col(year).isNull()).alias("_has_null"), F.min(year).alias("_first"))
        .select(entity, F.when(F.col("_has_null"), F.lit(None)).otherwise(F.col("_first")).alias(as_))
    )


def debut_counts(df: DataFrame, entity: str, year: str = "year", as_: str = "debuts") -> DataFrame:
    """Distinct entities per debut year (F9 over the rank-1 rows)."""
    d = debut_year(df, entity, year, as_=year)
    return d.groupBy(year).agg(F.count(F.lit(1)).alias(as_))


def distinct_per_group(df: DataFrame, key: str, col: str, as_: str, approx: bool = False) -> DataFrame:
    """``count(distinct col)`` per key (F9); Spark plans it as two partial aggregations.

    ``approx=True`` counts with HyperLogLog++ instead (one aggregation, fixed-size sketches).
    """
    agg = F.approx_count_distinct(col, 0.01) if approx else F.count_distinct(col)
    return df.groupBy(key).agg(agg.alias(as_))


def _ordered(order_col: str) -> Window:
    return Window.orderBy(F.col(order_col).asc())


def running_sum(value: str, order_col: str, inclusive: bool) -> Column:
    """Sum of ``value`` over all earlier rows (W2) or earlier plus current."""
    end = Window.currentRow if inclusive else -1
    return F.sum(value).over(_ordered(order_col).rowsBetween(Window.unboundedPreceding, end))


def with_running_sum(df: DataFrame, order_col: str, value: str, as_: str, inclusive: bool = False) -> DataFrame:
    """Add a running sum column; the exclusive form is NULL on the first row."""
    return df.withColumn(as_, running_sum(value, order_col, inclusive))


#: Most ranges of a two-level running sum, hence rows of its one small window.
MAX_RANGES = 4096


def prefix_sums(
    df: DataFrame, order_col: str, values: dict[str, str], ties: tuple[str, ...] = (), ranges: int = 64, inclusive: bool = True
) -> DataFrame:
    """Running sums over an order column of any size, in two levels (W2, W3). ``values``: output column → summed column.

    1. Cut points of the order column (an approximate percentile aggregate; at
       most ``ranges`` of them come to the driver) deal the rows to ranges.
    2. Each range is summed (partial aggregation): one row a range, and only these
       rows pass the window without a partition key.
    3. A window inside each range, plus the sum of the ranges before.

    The result equals the window over all rows ordered by ``order_col`` and
    ``ties`` (NULLs first); the cut points decide nothing but balance. Rows that
    share a value of ``order_col`` are one range's. With ``inclusive`` false a row's
    own value is left out and the first row is NULL. ``df`` is read three times:
    pass a written table where it is costly.
    """
    n = max(1, min(ranges, MAX_RANGES))
    at = [i / n for i in range(1, n)]
    cuts = (df.agg(F.percentile_approx(order_col, at, 100 * n).alias("c")).first()["c"] or []) if at else []
    cuts = sorted(set(cuts))
    kind = df.schema[order_col].dataType
    place = F.lit(0)
    if cuts:
        bounds = F.array(*[F.lit(c).cast(kind) for c in cuts])
        place = F.coalesce(F.size(F.filter(bounds, lambda b: b < F.col(order_col))), F.lit(0))
    dealt = df.withColumn("_range", place)
    sums = dealt.groupBy("_range").agg(*[F.sum(v).alias(f"_sum_{k}") for k, v in values.items()])
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = sums.select("_range", *[F.sum(f"_sum_{k}").over(ahead).alias(f"_before_{k}") for k in values])
    order = [F.col(order_col).asc_nulls_first(), *[F.col(t).asc_nulls_first() for t in ties]]
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    inside = dealt.withColumns({f"_in_{k}": F.sum(v).over(within) for k, v in values.items()})
    out = inside.join(F.broadcast(offsets), "_range")  # at most MAX_RANGES rows

    def added(k: str) -> Column:
        a, b = F.col(f"_in_{k}"), F.col(f"_before_{k}")
        return F.coalesce(a + b, a, b)

    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[added(k).alias(k) for k in values])


def growth_frame(
    df: DataFrame, order_col: str, value: str, prior: str = "prev_yr_pc_count", total: str = "pc_yoy_growth_count"
) -> DataFrame:
    """Value, the sum over all earlier years (NULL → 0, B9) and their sum.

    ``total`` equals the inclusive running sum: a cumulative count, not a
    year-on-year difference, whatever its name says.
    """
    out = df.withColumn(prior, F.coalesce(running_sum(value, order_col, inclusive=False), F.lit(0)))
    return out.withColumn(total, F.col(value) + F.col(prior))


def yearly_cumulative(df: DataFrame, year: str, measure: str, yearly: str, cumulative: str) -> DataFrame:
    """Per-year exact sum of a money column and the sum over earlier years."""
    per_year = df.groupBy(year).agg(F.sum(measure).alias(yearly))
    out = with_running_sum(per_year, year, yearly, cumulative, inclusive=False)
    return out.select(year, F.col(yearly).cast("double").alias(yearly), F.col(cumulative).cast("double").alias(cumulative))
