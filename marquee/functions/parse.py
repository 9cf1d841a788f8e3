"""Typed parsing of text columns: malformed values become NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_as(c: str | Column, dtype: T.DataType) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.DateType):
        return F.try_to_date(col.cast("string"))
    if isinstance(dtype, T.IntegralType):
        # whole numbers may be delivered as decimals ("37.0"): exact, then cut towards zero; NULL if not a number
        return col.cast("string").try_cast(T.DecimalType(38, 6)).try_cast(dtype)
    return col.try_cast(dtype)
