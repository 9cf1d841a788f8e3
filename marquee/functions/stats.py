"""Aggregate expressions that are safe under ANSI mode and exact where money is summed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_corr(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation of complete (a, b) pairs; NULL where it is undefined.

    ``F.corr`` raises DIVIDE_BY_ZERO under ANSI for a group with zero variance,
    and a ``when`` around it cannot help because the aggregate runs first. This
    form uses only algebraic aggregates (partial aggregation works, so a hot
    group is pre-aggregated map-side) and divides with ``try_divide``.
    Both inputs are masked so that only complete pairs count, as in ``corr``.
    """
    x = _c(a).cast("double")
    y = _c(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    xm = F.when(both, x)
    ym = F.when(both, y)
    return F.try_divide(F.covar_pop(xm, ym), F.stddev_pop(xm) * F.stddev_pop(ym))


def null_count(c: str | Column) -> Column:
    return F.count_if(_c(c).isNull())


def distinct_with_null(c: str | Column, approx: bool = False, rsd: float = 0.01) -> Column:
    """``select(c).distinct().count()`` semantics (NULL counts as one value) in one aggregate.

    Exact by default: Spark expands the rows once per distinct column and
    de-duplicates (column, value) pairs before counting. ``approx=True`` uses
    HyperLogLog++ (``approx_count_distinct``, relative error ``rsd``): one pass,
    no expansion, a fixed-size sketch per group, for profiles over very large
    high-cardinality text columns where an estimate is enough.
    """
    col = _c(c)
    distinct = F.approx_count_distinct(col, rsd) if approx else F.count_distinct(col)
    return distinct + F.coalesce(F.max(col.isNull().cast("int")), F.lit(0))


def to_cents(c: str | Column) -> Column:
    """Money as whole cents (``long``): exact for amounts with two decimals, and
    summed in codegen'd 64-bit arithmetic instead of a BigDecimal buffer."""
    return F.round(_c(c).cast("double") * 100).cast("long")


def from_cents(c: str | Column, precision: int = 18) -> Column:
    """Whole cents back to ``decimal(precision, 2)`` (exact division)."""
    return (_c(c).cast(f"decimal({precision},0)") / F.lit(100)).cast(f"decimal({precision},2)")

