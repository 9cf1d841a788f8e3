"""Cleaning operators: typed parsing, null rules, text normalisation, defaults, outliers.

Every function is lazy (no action) and maps a DataFrame to a DataFrame. None of
them shuffles except ``remove_outliers(mode="key")``, which needs a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schema as S
from marquee.functions.parse import parse_as
from marquee.functions.text import normalise_category, pad_month, strip_company_text, strip_genre_text

DEFAULT_REQUIRED = ("release_date", "revenue", "budget")


# ---------------------------------------------------------------- B1-B5 parsing


def parse_columns(df: DataFrame, types: Mapping[str, T.DataType] = S.RAW_TYPES) -> DataFrame:
    """Parse text columns to their target types in one projection; malformed → NULL (B1, B2)."""
    return df.select([
        parse_as(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns
    ])


def add_calendar(df: DataFrame, date_col: str = "release_date") -> DataFrame:
    """Add ``year`` and ``month`` ints of ``date_col``."""
    return df.withColumns({"year": F.year(date_col), "month": F.month(date_col)})


# ---------------------------------------------------------------- C1-C3


def not_null(cols: Iterable[str]) -> Column:
    """Conjunction of ``IS NOT NULL``; unlike ``dropna`` it reaches the parquet scan as pushed filters."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def drop_incomplete(df: DataFrame, required: Iterable[str] = DEFAULT_REQUIRED) -> DataFrame:
    """Drop rows with a NULL in any required column."""
    return df.filter(not_null(required))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object] = S.FILL_DEFAULTS) -> DataFrame:
    """Per-column default for NULLs."""
    present = {k: v for k, v in defaults.items() if k in df.columns}
    return df.fillna(present) if present else df


# ---------------------------------------------------------------- C6, E2, E3, F12


def range_outlier(c: str, lo: float | None, hi: float | None) -> Column:
    """Strictly outside [lo, hi]; NULL is not an outlier (the predicate is NULL)."""
    col = F.col(c)
    parts = []
    if hi is not None:
        parts.append(col > F.lit(hi))
    if lo is not None:
        parts.append(col < F.lit(lo))
    pred = parts[0]
    for p in parts[1:]:
        pred = pred | p
    return pred


def outlier_rules(
    runtime: tuple[float, float] = S.RUNTIME_BOUNDS,
    vote_average: tuple[float, float] = S.VOTE_AVERAGE_BOUNDS,
    money_floor: float = S.MONEY_LOWER_BOUND,
) -> dict[str, Column]:
    """The three outlier rules, in the order they are applied."""
    return {
        "runtime": range_outlier("runtime", *runtime),
        "vote_average": range_outlier("vote_average", *vote_average),
        "money": range_outlier("budget", money_floor, None) | range_outlier("revenue", money_floor, None),
    }


def _any(rules: Mapping[str, Column]) -> Column:
    pred = F.lit(False)
    for r in rules.values():
        pred = pred | F.coalesce(r, F.lit(False))
    return pred


def remove_outliers(
    df: DataFrame, rules: Mapping[str, Column] | None = None, mode: str = "row", key: str = "id"
) -> DataFrame:
    """Remove outliers under every rule.

    ``mode="row"`` (default) drops the outlier rows themselves: a filter, no shuffle.
    ``mode="key"`` also drops every row whose non-NULL ``key`` is shared with an
    outlier row: an anti-join against the distinct outlier keys (de-duplicated
    before the join, so a key held by many rows cannot skew the build side).
    """
    rules = rules if rules is not None else outlier_rules()
    bad = _any(rules)
    kept = df.filter(~bad)
    if mode == "row":
        return kept
    if mode != "key":
        raise ValueError(f"mode must be 'row' or 'key', not {mode!r}")
    bad_keys = df.filter(bad & F.col(key).isNotNull()).select(key).distinct()
    return kept.join(bad_keys, on=key, how="left_anti")


def outlier_counts(df: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Outliers per rule, each rule counted on what the previous rules left (F12), plus the rows kept.

    One aggregate over one scan (the reference runs one job per rule).
    """
    rules = rules if rules is not None else outlier_rules()
    aggs = []
    earlier = F.lit(False)
    for name, pred in rules.items():
        hit = F.coalesce(pred, F.lit(False))
        aggs.append(F.count_if(~earlier & hit).alias(f"{name}_outliers"))
        earlier = earlier | hit
    aggs.append(F.count_if(~earlier).alias("rows_kept"))
    aggs.insert(0, F.count(F.lit(1)).alias("rows_in"))
    return df.agg(*aggs)


# ---------------------------------------------------------------- L3


def cleaned_columns(df: DataFrame, status_allow: list[str] = S.STATUS_ALLOW) -> dict[str, Column]:
    """The 13 cleaned columns as expressions over one typed raw row.

    Plain expressions, so that they can be evaluated next to the raw columns in
    one projection (as ``analyses.quality_report`` does).
    """
    text = clean_values(status_allow)
    has_calendar = "year" in df.columns and "month" in df.columns
    year = F.col("year") if has_calendar else F.year("release_date")
    month = F.col("month") if has_calendar else F.month("release_date")
    cols = {
        "id": F.col("id"),
        "status": text["status"](F.col("status")),
        "genres": text["genres"](F.col("genres")),
        "release_date": F.col("release_date"),
        "runtime": F.col("runtime"),
        "year": year.cast("string"),
        "month": pad_month(month),
        "budget": F.col("budget"),
        "revenue": F.col("revenue"),
        "vote_count": F.col("vote_count"),
        "vote_average": F.col("vote_average"),
        "title": F.col("title"),
        "production_companies": text["production_companies"](F.col("production_companies")),
    }
    for c, v in S.FILL_DEFAULTS.items():
        cols[c] = F.coalesce(cols[c], F.lit(v))
    return cols


def clean_values(status_allow: list[str] = S.STATUS_ALLOW) -> dict[str, Callable[[Column], Column]]:
    """The text rules of the cleaning step by column: raw value → cleaned value, before defaults."""
    return {
        "status": lambda c: normalise_category(c, status_allow),
        "genres": strip_genre_text,
        "production_companies": lambda c: F.trim(F.lower(strip_company_text(c))),
    }


def keep_row(rules: Mapping[str, Column] | None = None) -> Column:
    """True for a cleaned row that no outlier rule flags (row mode)."""
    return ~_any(rules if rules is not None else outlier_rules())


def clean(
    df: DataFrame,
    status_allow: list[str] = S.STATUS_ALLOW,
    rules: Mapping[str, Column] | None = None,
    outlier_mode: str = "row",
    key: str = "id",
    required: Iterable[str] = DEFAULT_REQUIRED,
) -> DataFrame:
    """The whole cleaning rule set over a typed raw catalogue (L3).

    Null drop → year/month text → text normalisation → 13 columns → defaults →
    outlier removal (skipped with ``outlier_mode="none"``). In row mode it is one
    filter and one projection over the scan (no shuffle); the writer adds the
    only exchange.
    """
    cols = cleaned_columns(df, status_allow)
    out = drop_incomplete(df, required).select([cols[c].alias(c) for c in S.CLEAN_COLUMNS])
    if outlier_mode == "none":
        return out
    return remove_outliers(out, rules, mode=outlier_mode, key=key)
