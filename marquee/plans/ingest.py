"""Batch ingest into the raw zone and the clean step into the filtered zone."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schema as S
from marquee.operators.cleaning import add_calendar, clean, parse_columns
from marquee.operators.incremental import batch_counts, new_rows, null_key_rows
from marquee.session import scratch_path
from marquee.sources.files import path_exists, read_parquet_or_empty, require_path
from marquee.sources.load_log import BEGUN, LOAD_ID, LoadLog
from marquee.sources.sinks import write_partitioned


def prepare_batch(text_df: DataFrame, types: Mapping[str, T.DataType] = S.RAW_TYPES) -> DataFrame:
    """Source text → typed columns plus ``year``/``month``."""
    return add_calendar(parse_columns(text_df, types))


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: for rows that several passes need and that are
    costly to make (a CSV to parse, a join). Later passes read only their columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ingest(
    spark: SparkSession,
    batch: DataFrame,
    sink_path: str,
    sink_schema: T.StructType,
    key: str = "id",
    partition_col: str = "year",
    prune_by_key_range: bool = True,
    rejects_path: str | None = None,
    log: LoadLog | None = None,
    load_id: str | None = None,
    batch_is_written: bool = False,
) -> dict:
    """Append the batch's unseen keys to the raw zone, partitioned by ``partition_col`` (L2).

    Returns what became of every row: ``rows_read`` = ``rejected_null_key`` (no
    key, or not a number) + ``duplicate_in_batch`` + ``already_in_sink`` +
    ``new_rows``, and ``max_id``, the largest key of the batch. Rejected rows are
    appended to ``rejects_path`` where one is given. A NULL ``year`` lands in the
    default partition and reads back as NULL. Re-running after a failure is
    harmless: keys that made it into the sink are filtered out by the anti-join.

    With a ``log`` and a ``load_id`` the counts of a load are kept too (A9), and
    are those of a single run however often it is repeated: rows carry the load's
    id, a committed load returns its logged counts, and a replay of one that
    broke off counts the rows that its earlier attempt published as new. Rejects
    then lie in a folder of the load, which a replay overwrites.

    The batch is read once for its counts and once for the write. For increments
    that cover a part of the sink's keys, ``prune_by_key_range`` limits the sink
    read to the batch's key range (files are written sorted by key, so the
    anti-join reads the row groups that can match); switch it off where every
    delivery is the whole catalogue, whose range prunes nothing. Where the batch is
    a written table (``staged``), say so: its repeated keys are then found from the
    key column, and only their rows are compared.
    """
    if (log is None) != (load_id is None):
        raise ValueError("log and load_id go together")
    replay = False
    if log is not None:
        done = log.counts(load_id)
        if done is not None:
            return done
        replay = BEGUN in log.phases(load_id)
        if not replay:
            log.begin(load_id)
        batch = batch.withColumn(LOAD_ID, F.lit(load_id))
        sink_schema = T.StructType([f for f in sink_schema.fields if f.name != LOAD_ID] + [T.StructField(LOAD_ID, T.StringType(), True)])
    sink_exists = path_exists(spark, sink_path)
    existing = read_parquet_or_empty(spark, sink_path, sink_schema)
    counts = batch_counts(batch, key)
    bounds = (counts.pop("lo"), counts.pop("hi"))
    if rejects_path is not None and counts["rejected_null_key"]:
        _write_rejects(null_key_rows(batch, key), rejects_path, by_load=log is not None)
    published = 0
    if replay and sink_exists and bounds[0] is not None:
        published = existing.where((F.col(LOAD_ID) == load_id) & F.col(key).between(F.lit(bounds[0]), F.lit(bounds[1]))).count()
    new = new_rows(batch, existing, key, key_range=bounds if prune_by_key_range and sink_exists else None,
                   written=batch_is_written)
    new = new.select(*sink_schema.fieldNames())
    obs = Observation(f"ingest-{uuid.uuid4().hex[:12]}")
    write_partitioned(new.observe(obs, F.count(F.lit(1)).alias("new_rows")), sink_path, partition_col, mode="append", sort_key=key)
    appended = _observed(obs) + published
    rest = counts["rows_read"] - counts["rejected_null_key"] - counts["duplicate_in_batch"] - appended
    out = {**counts, "already_in_sink": rest, "new_rows": appended, "max_id": bounds[1]}
    if log is not None:
        log.commit(load_id, out, sink_schema)
    return out


def _write_rejects(rows: DataFrame, path: str, by_load: bool) -> None:
    if by_load:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD_ID).parquet(path)
    else:
        rows.write.mode("append").parquet(path)


def _observed(obs: Observation) -> int:
    """Rows of the write. When AQE proves them empty at run time it replaces the
    plan with an empty relation and the observed node never runs: the observation
    is then a row without columns, which PySpark fails to convert with exactly that
    assertion. Any other failure rises."""
    try:
        return obs.get["new_rows"]
    except Py4JJavaError as e:
        if e.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return 0


def clean_zone(
    spark: SparkSession,
    raw_path: str,
    raw_schema: T.StructType,
    out_path: str,
    status_allow: list[str] = S.STATUS_ALLOW,
    rules: Mapping[str, Column] | None = None,
    outlier_mode: str = "row",
    allow_empty: bool = False,
) -> None:
    """Raw zone → every cleaning rule → filtered zone, partitioned by month, overwritten.

    A missing raw zone, one without files or (unless ``allow_empty``) without
    rows raises and leaves the filtered zone as it is.
    """
    require_path(spark, raw_path)
    raw = spark.read.schema(raw_schema).parquet(raw_path)
    if not allow_empty and raw.limit(1).count() == 0:
        raise ValueError(f"{raw_path} holds no rows: {out_path} was left as it is")
    cleaned = clean(raw, status_allow=status_allow, rules=rules, outlier_mode=outlier_mode)
    write_partitioned(cleaned, out_path, "month", mode="overwrite")


def touched_months(raw: DataFrame, load_ids: list[str]) -> list[int]:
    """Calendar months of the rows that came with these loads: thirteen values at most reach the driver."""
    found = raw.where(F.col(LOAD_ID).isin(load_ids) & F.col("month").isNotNull()).select("month").distinct().collect()
    return sorted(r["month"] for r in found)


def clean_loads(
    spark: SparkSession,
    raw_path: str,
    raw_schema: T.StructType,
    out_path: str,
    load_ids: list[str],
    status_allow: list[str] = S.STATUS_ALLOW,
    rules: Mapping[str, Column] | None = None,
) -> list[str]:
    """Bring the filtered zone up to date with some loads: only the months they touch are cleaned and overwritten.

    The raw zone only grows, and in row mode a row's cleaning depends on that row
    alone, so the other months' folders are already what a full rebuild would
    write; they are neither read for cleaning nor rewritten. The filter on the
    months reaches the raw scan, the write replaces whole month folders (dynamic
    partition overwrite), and running it again for the same loads writes the same
    rows. Returns the rewritten months as the zone names them; loads without a
    dated row touch none. Raises where the raw zone holds nothing.
    """
    require_path(spark, raw_path)
    if LOAD_ID not in raw_schema.fieldNames():
        raw_schema = T.StructType([*raw_schema.fields, T.StructField(LOAD_ID, T.StringType(), True)])
    raw = spark.read.schema(raw_schema).parquet(raw_path)
    months = touched_months(raw, load_ids)
    if months:
        cleaned = clean(raw.where(F.col("month").isin(months)), status_allow=status_allow, rules=rules)
        write_partitioned(cleaned, out_path, "month", mode="dynamic")
    return [f"{m:02d}" for m in months]


def read_clean_zone(
    spark: SparkSession, path: str, months: list[str] | None = None, years: list[str] | None = None
) -> DataFrame:
    """The filtered zone with its declared schema (``month`` stays two-digit text).

    ``months`` filters on the partition column itself, so Spark lists and reads
    only those partition folders (``PartitionFilters``); a filter written on
    ``month(release_date)`` instead would scan every partition. ``years`` is a
    data filter pushed to the Parquet reader (row-group statistics). A missing
    zone raises, so a report never overwrites its tables from a wrong path.
    """
    require_path(spark, path)
    df = read_parquet_or_empty(spark, path, S.CLEAN_SCHEMA)
    if months is not None:
        df = df.filter(F.col("month").isin(months))
    if years is not None:
        df = df.filter(F.col("year").isin(years))
    return df.select(*S.CLEAN_COLUMNS)
