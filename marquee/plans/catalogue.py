"""The cleaned catalogue over the driver tables: the input of every analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.operators.cleaning import clean, outlier_rules
from marquee.sources import tpch_catalogue as tc


def order_rules():
    """Outlier rules for the derived catalogue (vote bound adapted to quantities)."""
    return outlier_rules(vote_average=tc.ORDER_VOTE_BOUNDS)


def raw(spark: SparkSession, sf_dir: str, with_tokens: bool = True) -> DataFrame:
    return tc.catalogue(spark, sf_dir, with_tokens)


def cleaned(spark: SparkSession, sf_dir: str, outlier_mode: str = "row", with_tokens: bool = True) -> DataFrame:
    """Typed raw catalogue → all cleaning rules (L3), lazily; without tokens for analyses of measures only."""
    return clean(raw(spark, sf_dir, with_tokens), status_allow=tc.ORDER_STATUS_ALLOW, rules=order_rules(), outlier_mode=outlier_mode)
