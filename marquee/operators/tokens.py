"""Multi-valued text attributes: split, normalise, filter and explode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import schema as S
from marquee.functions.text import is_company_name, split_tokens


def explode_tokens(
    df: DataFrame,
    col: str,
    as_: str,
    *,
    lower: bool = True,
    trim: bool = True,
    keep: Callable[[Column], Column] | None = None,
    sep: str = S.TOKEN_SEPARATOR,
    drop_source: bool = True,
) -> DataFrame:
    """One row per token of ``col`` (NULL text gives no row, ``''`` one empty token).

    Tokens are normalised and filtered *inside the array* (``transform`` then
    ``filter``) before ``explode``: Catalyst cannot push a filter on a generated
    column below the ``Generate`` node, so filtering first avoids materialising
    rows that would be dropped right after.
    """
    arr = split_tokens(F.col(col), sep)

    def norm(x: Column) -> Column:
        if lower:
            x = F.lower(x)
        if trim:
            x = F.trim(x)
        return x

    if lower or trim:
        arr = F.transform(arr, norm)
    if keep is not None:
        arr = F.filter(arr, keep)
    out = df.withColumn(as_, F.explode(arr))
    if drop_source and col != as_ and col in out.columns:
        out = out.drop(col)
    return out


def allow(values: list[str]) -> Callable[[Column], Column]:
    """Token is in ``values`` (C4). NULL tokens are dropped."""
    return lambda x: x.isin(values)


def deny(values: list[str]) -> Callable[[Column], Column]:
    """Token is not NULL and not in ``values``."""
    return lambda x: x.isNotNull() & ~x.isin(values)


def company_token(deny_values: list[str] = S.COMPANY_DENY) -> Callable[[Column], Column]:
    """Not denied, longer than five characters and shaped like a name."""
    d = deny(deny_values)
    return lambda x: d(x) & is_company_name(x)


def genre_rows(df: DataFrame, allowed: list[str] = S.GENRE_ALLOW, col: str = "genres", as_: str = "genres") -> DataFrame:
    """Cleaned catalogue → one row per allowed genre of each title (L5 first half)."""
    return explode_tokens(df, col, as_, keep=allow(allowed))


def company_rows(
    df: DataFrame, deny_values: list[str] = S.COMPANY_DENY, col: str = "production_companies", as_: str = "pc"
) -> DataFrame:
    """Cleaned catalogue → one row per valid company name of each title (L6 first half)."""
    return explode_tokens(df, col, as_, keep=company_token(deny_values), drop_source=False)
