"""A raw zone as a bucketed table: the anti-join of an ingest needs no exchange on the sink's side.

A path of Parquet files says nothing about how its rows are laid out, so every
ingest shuffles the sink's keys again. A table bucketed by the key keeps them in
place: only the batch, which is small beside the sink, is dealt to the buckets, the
join reads bucket by bucket, and the new rows are already where they belong.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators.incremental import batch_counts, dedupe_on_key


def _quoted(name: str) -> str:
    return ".".join(f"`{part.strip('`')}`" for part in name.split("."))


def create_bucketed_table(spark: SparkSession, name: str, location: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """An empty external table at ``location``, its files bucketed and sorted by ``key``. An existing name raises.

    ``buckets`` stays for the table's life: choose it for the size the zone will
    have (a bucket is one task's share of the keys).
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {_quoted(name)} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(_quoted(name))


def bucket_spec(spark: SparkSession, name: str) -> tuple[str, int]:
    """(key, number of buckets) of a bucketed table, from the catalogue."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {_quoted(name)}").collect()}
    if "Num Buckets" not in told:
        raise ValueError(f"{name} is not bucketed")
    return told["Bucket Columns"].strip("[]` "), int(told["Num Buckets"])


def unseen_rows(spark: SparkSession, batch: DataFrame, name: str) -> DataFrame:
    """One row per key of ``batch`` that the table lacks, dealt to the table's buckets. NULL keys are left out.

    The batch is the only side with an exchange. The sink's keys are not made
    distinct: an anti-join is none the worse for a key that occurs twice.
    """
    key, buckets = bucket_spec(spark, name)
    dealt = batch.where(F.col(key).isNotNull()).repartition(buckets, key)
    fresh = dedupe_on_key(dealt, key)
    return fresh.join(spark.table(_quoted(name)).select(key).where(F.col(key).isNotNull()), key, "left_anti")


def ingest_bucketed(spark: SparkSession, batch: DataFrame, name: str) -> dict:
    """Append the batch's unseen keys to the bucketed table; returns the counts of ``plans.ingest.ingest``.

    Every load adds one file to each bucket that gets rows. Running it again
    appends nothing.
    """
    key, _ = bucket_spec(spark, name)
    counts = batch_counts(batch, key)
    largest = counts.pop("hi")
    counts.pop("lo")
    before = spark.table(_quoted(name)).count()  # from the files' footers
    columns = spark.table(_quoted(name)).columns
    unseen_rows(spark, batch, name).select(*[f"`{c}`" for c in columns]).write.insertInto(_quoted(name))
    spark.catalog.refreshTable(_quoted(name))
    new = spark.table(_quoted(name)).count() - before
    known = counts["rows_read"] - counts["rejected_null_key"] - counts["duplicate_in_batch"] - new
    return {**counts, "already_in_sink": known, "new_rows": new, "max_id": largest}
