"""Column-level expressions used by the operators."""

from marquee.functions.parse import parse_as
from marquee.functions.stats import distinct_with_null, null_count, safe_corr
from marquee.functions.text import (
    is_company_name,
    normalise_category,
    pad_month,
    split_tokens,
    strip_company_text,
    strip_genre_text,
)

__all__ = [
    "parse_as", "distinct_with_null", "null_count", "safe_corr", "is_company_name",
    "normalise_category", "pad_month", "split_tokens", "strip_company_text", "strip_genre_text",
]
