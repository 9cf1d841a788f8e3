"""Ordered output and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, order: Sequence[Column], tiebreak: Sequence[str] = ()) -> DataFrame:
    """First ``k`` rows by ``order``; ties broken by ``tiebreak`` so the result is deterministic.

    Plans as ``TakeOrderedAndProject``: every task keeps its own k best rows and
    only those reach the final merge, so memory is O(k) per task.
    """
    return df.orderBy(*order, *[F.col(c).asc() for c in tiebreak]).limit(k)


def longest(df: DataFrame, col: str, k: int, id_col: str, as_: str = "length") -> DataFrame:
    """The ``k`` rows with the longest text in ``col`` (H5)."""
    with_len = df.withColumn(as_, F.length(col))
    return top_k(with_len, k, [F.col(as_).desc()], [id_col])


def sample_where(df: DataFrame, cond: Column, k: int, order_col: str) -> DataFrame:
    """First ``k`` rows matching ``cond`` in ``order_col`` order (C10 + A11's ``show(k)``)."""
    return top_k(df.filter(cond), k, [F.col(order_col).asc()])
