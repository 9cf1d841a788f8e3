"""User-facing analyses over a cleaned catalogue.

Each function takes the cleaned catalogue (``CLEAN_COLUMNS``) and returns a lazy
DataFrame; nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee import schema as S
from marquee.operators import growth, metrics, tokens
from marquee.operators.cleaning import DEFAULT_REQUIRED, clean_values, cleaned_columns, keep_row, not_null

GRAINS = {"year": ["year", "genres"], "month": ["month", "genres"], "total": ["genres"]}


def genre_metrics(cleaned: DataFrame, grain: str = "year", allowed: list[str] = S.GENRE_ALLOW) -> DataFrame:
    """Titles, budget, revenue and correlation per genre at one grain."""
    return metrics.grouped_metrics(tokens.genre_rows(cleaned, allowed), GRAINS[grain])


def genre_metrics_all_grains(cleaned: DataFrame, allowed: list[str] = S.GENRE_ALLOW) -> DataFrame:
    """The three genre grains in one scan and one shuffle (F5 as grouping sets)."""
    return metrics.metrics_at_grains(tokens.genre_rows(cleaned, allowed), list(GRAINS.values()))


def company_debut_growth(cleaned: DataFrame, deny: list[str] = S.COMPANY_DENY) -> DataFrame:
    """New valid company names per year, all earlier years, running total."""
    d = growth.debut_counts(tokens.company_rows(cleaned, deny), "pc", "year", as_="pc_distinct")
    return growth.growth_frame(d, "year", "pc_distinct")


def entity_debut_counts(
    cleaned: DataFrame, entity: str = "production_companies", exclude: str | None = None
) -> DataFrame:
    """New whole-text entities (lower-cased) per debut year, optionally without one value."""
    e = cleaned.withColumn(entity, F.lower(entity))
    if exclude is not None:
        e = e.filter(F.col(entity) != exclude)
    return growth.debut_counts(e, entity, "year", as_="pc_count_by_year")


def entity_debut_growth(cleaned: DataFrame, entity: str = "production_companies", exclude: str = "na") -> DataFrame:
    """Debut growth of a whole-text entity, lower-cased, one value excluded (L6 whole-text variant)."""
    d = entity_debut_counts(cleaned, entity, exclude)
    return growth.growth_frame(d, "year", "pc_count_by_year")


def companies_per_year(cleaned: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct company strings per year, with running totals."""
    d = growth.distinct_per_group(cleaned, "year", "production_companies", "prod_companies_count", approx)
    return growth.growth_frame(d, "year", "prod_companies_count")


def cumulative_money(cleaned: DataFrame, measure: str = "budget") -> DataFrame:
    """Per-year sum of a money column and the sum over all earlier years."""
    return growth.yearly_cumulative(cleaned, "year", measure, f"yearly_{measure}", f"yoy_{measure}")


def releases_per_year(cleaned: DataFrame) -> DataFrame:
    """Dashboard: titles per year."""
    return cleaned.groupBy("year").agg(F.count(F.lit(1)).alias("releases"))


def listings(cleaned: DataFrame, allowed: list[str] = S.GENRE_ALLOW, deny: list[str] = S.COMPANY_DENY) -> dict[str, DataFrame]:
    """The remaining tables of the exploratory report over a cleaned zone, each in its order (H1, H2)."""
    genre_rows, companies = tokens.genre_rows(cleaned, allowed), tokens.company_rows(cleaned, deny)
    growth_rows = company_debut_growth(cleaned, deny)
    return {
        "genre_zero_money": metrics.count_both_zero(genre_rows, "budget", "revenue"),
        "budget_by_year_genre": genre_rows.groupBy("year", "genres").agg(F.sum("budget").alias("total_budget")),
        "company_frequency": metrics.frequency(companies, "pc").orderBy(F.desc("count"), "pc"),
        "company_string_debut": entity_debut_counts(cleaned).orderBy(F.desc("pc_count_by_year"), "year"),
        "company_growth_largest_total_first": growth_rows.orderBy(F.desc("pc_yoy_growth_count"), F.desc("year")),
        "company_growth_smallest_total_first": growth_rows.orderBy("pc_yoy_growth_count", "year"),
        "cumulative_budget_latest_first": cumulative_money(cleaned, "budget").orderBy(F.desc("year")),
        "cumulative_revenue_latest_first": cumulative_money(cleaned, "revenue").orderBy(F.desc("year")),
    }


def quality_report(
    raw: DataFrame,
    status_allow: list[str] = S.STATUS_ALLOW,
    rules: Mapping[str, Column] | None = None,
    required: Sequence[str] = DEFAULT_REQUIRED,
    distinct_cols: Sequence[str] = ("status", "genres", "production_companies", "release_date"),
) -> DataFrame:
    """Per stage and column: type, NULLs, distinct values (NULL counted) and rows.

    Stages: ``raw``, ``cleaned`` (every rule but outlier removal) and ``kept``
    (row-mode outliers removed). NULLs and rows of all three come from one
    aggregate. Distinct values are grouped to (column, raw value) first, so the
    text rules run once per distinct value and no row is expanded once per
    distinct count.
    """
    cols = cleaned_columns(raw, status_allow)
    raw_cols = raw.columns
    staged = raw.select(
        *[F.col(c).alias(f"_r{i}") for i, c in enumerate(raw_cols)],
        *[cols[c].alias(c) for c in S.CLEAN_COLUMNS],
        not_null(required).alias("_complete"),
    )
    staged = staged.withColumn("_keep", F.col("_complete") & keep_row(rules))
    flags = {"cleaned": F.col("_complete"), "kept": F.col("_keep")}
    aggs = [F.count(F.lit(1)).alias("_rows_raw"), *[F.count_if(f).alias(f"_rows_{s}") for s, f in flags.items()]]
    aggs += [F.count_if(F.col(f"_r{i}").isNull()).alias(f"_raw{i}") for i in range(len(raw_cols))]
    aggs += [F.count_if(f & F.col(c).isNull()).alias(f"_{s}{j}") for s, f in flags.items() for j, c in enumerate(S.CLEAN_COLUMNS)]
    one = staged.agg(*aggs)
    raw_types = [(f.name, f.dataType.simpleString()) for f in raw.schema.fields]
    clean_types = [(c, staged.schema[c].dataType.simpleString()) for c in S.CLEAN_COLUMNS]
    entries = [
        F.struct(F.lit(stage).alias("stage"), F.lit(name).alias("column_name"), F.lit(pos).cast("bigint").alias("position"),
                 F.lit(kind).alias("data_type"), F.col(f"_{stage}{pos}").alias("nulls"), F.col(f"_rows_{stage}").alias("rows"))
        for stage, types in (("raw", raw_types), ("cleaned", clean_types), ("kept", clean_types))
        for pos, (name, kind) in enumerate(types)
    ]
    counts = one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    distinct = _distinct_by_stage(staged, {c: f"_r{raw_cols.index(c)}" for c in distinct_cols}, status_allow)
    return counts.join(distinct, ["stage", "column_name"], "left").select(
        "stage", "column_name", "position", "data_type", "nulls", "distinct_values", "rows")


def _distinct_by_stage(staged: DataFrame, source: Mapping[str, str], status_allow: list[str]) -> DataFrame:
    """(stage, column_name, distinct_values) of the raw columns ``source`` and their cleaned values."""
    pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(c).cast("string").alias("v")) for n, c in source.items()])
    values = staged.select(F.explode(pairs).alias("p"), "_complete", "_keep").groupBy("p.column_name", "p.v").agg(
        F.max("_complete").alias("_complete"), F.max("_keep").alias("_keep"))
    clean_v = F.col("v")
    for name, rule in clean_values(status_allow).items():
        default = S.FILL_DEFAULTS.get(name)
        ruled = rule(F.col("v")) if default is None else F.coalesce(rule(F.col("v")), F.lit(default))
        clean_v = F.when(F.col("column_name") == name, ruled).otherwise(clean_v)
    per_value = values.withColumn("v", clean_v).groupBy("column_name", "v").agg(
        F.count(F.lit(1)).alias("_raw"), F.max("_complete").alias("_complete"), F.max("_keep").alias("_keep"))
    found = per_value.groupBy("column_name").agg(
        F.sum("_raw").alias("raw"), F.count_if("_complete").alias("cleaned"), F.count_if("_keep").alias("kept"))
    return found.unpivot("column_name", ["raw", "cleaned", "kept"], "stage", "distinct_values")
