"""The three entry points of the original batch job, as functions over a session.

``process_raw_data`` (CSV → raw zone), ``transform_data`` (raw zone → filtered
zone) and ``eda`` (the exploratory report) keep the original's steps and
names, with the corrected semantics documented in the README. ``eda`` returns
DataFrames instead of printing; call ``.show()`` on what you need.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schema as S
from marquee.operators import metrics, tokens
from marquee.operators.cleaning import outlier_counts, remove_outliers
from marquee.plans import analyses
from marquee.plans.ingest import clean_loads, clean_zone, ingest, prepare_batch, staged
from marquee.sources import files, load_log


#: Text of a line that does not fit the header.
CORRUPT = "_corrupt_record"


def process_raw_data(
    spark: SparkSession, source: str, raw_output_path: str, rejects_path: str | None = None, multi_line: bool = True,
    state_path: str | None = None, load_id: str | None = None,
) -> dict:
    """Append the source CSV's unseen titles to the raw zone, partitioned by year (L2).

    Columns are taken by each file's own header; columns the schema does not name
    are kept as text. Returns the counts of ``plans.ingest.ingest``; ``max_id`` is the
    largest id of the batch (the original's ``last_processed_id``). Rows without a
    usable id, and lines that do not fit the header, are counted as rejects; they
    go to ``rejects_path`` where one is given (the latter with their text in
    ``_corrupt_record``). With ``state_path`` and ``load_id`` the load is logged
    there and a repeated run of it is recognised (A9).
    """
    return load_csv_files(spark, files.listed_files(spark, source), raw_output_path, rejects_path, multi_line, state_path, load_id)


def load_csv_files(
    spark: SparkSession, paths: list[str], raw_output_path: str, rejects_path: str | None = None, multi_line: bool = True,
    state_path: str | None = None, load_id: str | None = None, columns: T.StructType = S.RAW_TEXT_SCHEMA,
    types: Mapping[str, T.DataType] = S.RAW_TYPES, key: str = "id", partition_col: str = "year",
    prepare: Callable[[DataFrame, Mapping[str, T.DataType]], DataFrame] = prepare_batch,
) -> dict:
    """Load some CSV files as one batch: what ``process_raw_data`` does with a folder and the stream with a micro-batch.

    ``columns`` are read as text and parsed to ``types`` by ``prepare``; the
    defaults are the catalogue's.
    """
    schema = T.StructType(columns.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    text = files.read_csv_files(spark, paths, schema, corrupt_column=CORRUPT, multi_line=multi_line)
    # a line that does not fit keeps its text and loses its key, so it is counted and written as a reject
    text = text.withColumn(key, F.when(F.col(CORRUPT).isNull(), F.col(key)))
    batch = staged(prepare(text, types), "csv-batch")  # the files are parsed once; counts, rejects and rows are of the same reading
    known = [c for c in batch.columns if c != CORRUPT]
    named = [c for c in columns.fieldNames()]
    ordered = [*named, *[c for c in known if c not in named]]  # columns that the schema does not name follow
    sink_schema = T.StructType([T.StructField(c, batch.schema[c].dataType, True) for c in ordered])
    log = load_log.LoadLog(spark, state_path) if state_path is not None else None
    return ingest(spark, batch, raw_output_path, sink_schema, key, partition_col, rejects_path=rejects_path, log=log, load_id=load_id,
                  batch_is_written=True)


def transform_data(
    spark: SparkSession, source_path: str, output_path: str, outlier_mode: str = "row", load_ids: list[str] | None = None
) -> None:
    """Clean the raw zone into the filtered zone, partitioned by month, overwritten (L3).

    With ``load_ids`` only the months that these logged loads touched are cleaned
    and overwritten (row mode, see ``plans.ingest.clean_loads``).
    """
    if load_ids is not None:
        if outlier_mode != "row":
            raise ValueError("a row's cleaning depends on other rows in key mode: clean the whole zone")
        clean_loads(spark, source_path, S.raw_typed_schema(), output_path, load_ids)
        return
    clean_zone(spark, source_path, S.raw_typed_schema(), output_path, outlier_mode=outlier_mode)


def eda(raw: DataFrame, cleaned_before_outliers: DataFrame) -> dict[str, DataFrame]:
    """The exploratory report (L4-L6): each entry a lazy DataFrame.

    ``raw`` is the typed raw catalogue, ``cleaned_before_outliers`` the output of
    ``clean(..., outlier_mode="none")`` (the original counted outliers on it).
    """
    cleaned = remove_outliers(cleaned_before_outliers)
    genre_rows = tokens.genre_rows(cleaned)
    companies = tokens.company_rows(cleaned, S.COMPANY_DENY)
    return {
        "quality": analyses.quality_report(raw),
        "outlier_counts": outlier_counts(cleaned_before_outliers),
        "genre_by_year": analyses.genre_metrics(cleaned, "year"),
        "genre_by_month": analyses.genre_metrics(cleaned, "month"),
        "genre_total": analyses.genre_metrics(cleaned, "total"),
        "genre_zero_money": metrics.count_both_zero(genre_rows, "budget", "revenue"),
        "company_frequency": metrics.frequency(companies, "pc").orderBy(F.desc("count"), "pc"),
        "company_frequent_count": metrics.count_groups(companies, "pc", min_count=5),
        "company_string_debut": analyses.entity_debut_counts(cleaned).orderBy("year"),
        "company_string_debut_known": analyses.entity_debut_counts(cleaned, exclude="na").orderBy("year"),
        "company_growth": analyses.company_debut_growth(cleaned),
        "companies_per_year": analyses.companies_per_year(cleaned),
        "cumulative_budget": analyses.cumulative_money(cleaned, "budget"),
        "cumulative_revenue": analyses.cumulative_money(cleaned, "revenue"),
        "releases_per_year": analyses.releases_per_year(cleaned),
    }
