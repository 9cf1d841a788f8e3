"""Null-safe text expressions (all built-in, so they stay inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee import schema as S


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keep_chars(c: str | Column, kept: str) -> Column:
    """Keep only the characters of the class ``[kept]``; NULL stays NULL.

    The text is rebuilt from the maximal runs of kept characters: that equals
    deleting every other character, and extracting runs costs about half of
    replacing the others (no append step per match).
    """
    return F.array_join(F.regexp_extract_all(_c(c), F.lit(f"[{kept}]++"), 0), "")


def _kept(strip_pattern: str) -> str:
    """The class kept by a strip rule ``[^...]`` of the fixed values."""
    return strip_pattern.removeprefix("[^").removesuffix("]")


def strip_genre_text(c: str | Column) -> Column:
    """Keep ASCII letters, white space and commas."""
    return keep_chars(c, _kept(S.GENRE_STRIP_PATTERN))


def strip_company_text(c: str | Column) -> Column:
    """Keep ASCII letters, white space, commas and dots."""
    return keep_chars(c, _kept(S.COMPANY_STRIP_PATTERN))


def normalise_category(c: str | Column, allowed: list[str] = S.STATUS_ALLOW, other: str = S.OTHER_STATUS) -> Column:
    """Trimmed value if its lower case is in ``allowed`` (case-insensitive), else ``other``.

    NULL maps to ``other`` too (``NULL IN (...)`` is NULL, so ``when`` falls through).
    """
    trimmed = F.trim(_c(c))
    return F.when(F.lower(trimmed).isin([a.lower() for a in allowed]), trimmed).otherwise(F.lit(other))


def pad_month(c: str | Column) -> Column:
    """Two-digit month text ``01``..``12``; NULL stays NULL (not the text ``null``)."""
    return F.lpad(_c(c).cast("string"), 2, "0")


def split_tokens(c: str | Column, sep: str = S.TOKEN_SEPARATOR) -> Column:
    """Array of tokens of delimited text. ``sep`` is literal text, not a pattern."""
    return F.split(_c(c), _regex_quote(sep))


def _regex_quote(s: str) -> str:
    special = set(".^$*+?()[]{}|\\")
    return "".join("\\" + ch if ch in special else ch for ch in s)


def is_company_name(c: str | Column, pattern: str = S.COMPANY_NAME_PATTERN, min_length: int = S.COMPANY_MIN_LENGTH) -> Column:
    """Length above ``min_length`` and the whole text matches ``pattern``."""
    col = _c(c)
    return (F.length(col) > min_length) & col.rlike(pattern)
