"""Append-only-new-keys logic shared by the batch and the streaming ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_on_key(df: DataFrame, key: str, written: bool = False) -> DataFrame:
    """One row per key, chosen deterministically (the greatest row), so a retried task picks the same row.

    An aggregate rather than a window: a key repeated across a third of the
    batch is reduced map-side instead of landing whole in one task. Where ``df``
    is a ``written`` table the keys are counted first, from their column alone, and
    only rows of repeated keys pass the aggregate over whole rows; NULL keys go.
    """
    if written:
        repeated = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)
        once = df.where(F.col(key).isNotNull()).join(repeated, key, "left_anti")
        return once.unionByName(dedupe_on_key(df.join(repeated, key, "left_semi"), key)).select(*df.columns)
    others = [c for c in df.columns if c != key]
    if not others:
        return df.select(key).distinct()
    best = F.max(F.struct(*[F.col(c) for c in others])).alias("_row")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)


def new_rows(
    batch: DataFrame,
    existing: DataFrame,
    key: str = "id",
    dedupe: bool = True,
    key_range: tuple | None = None,
    written: bool = False,
) -> DataFrame:
    """Rows of ``batch`` whose key is not yet in ``existing`` (left anti equi-join).

    NULL keys are excluded (they can never match, so they would be appended on
    every run); see ``null_key_rows``. ``existing`` is reduced to its distinct
    keys first, which also keeps a repeated sink key from skewing the join.
    ``key_range`` = (lowest, highest) key of the batch restricts the sink read to
    that range; the filter reaches the Parquet scan, and over key-sorted files
    (``write_partitioned(sort_key=...)``) it skips every row group outside it.
    Keys outside the batch's range cannot match, so the result is unchanged.
    ``written``: the batch is a written table (see ``dedupe_on_key``).
    """
    b = batch.filter(F.col(key).isNotNull())
    if dedupe:
        b = dedupe_on_key(b, key, written)
    keys = existing.select(key).where(F.col(key).isNotNull())
    if key_range is not None:
        lo, hi = key_range
        if lo is None:  # empty batch: nothing can match
            keys = keys.where(F.lit(False))
        else:
            keys = keys.where(F.col(key).between(F.lit(lo), F.lit(hi)))
    return b.join(keys.distinct(), on=key, how="left_anti")


def batch_counts(batch: DataFrame, key: str = "id") -> dict:
    """Rows, rows without a key, repeats of a key, and the key range of a batch: one aggregate, one row to the driver."""
    r = batch.agg(
        F.count(F.lit(1)).alias("rows_read"), F.count_if(F.col(key).isNull()).alias("rejected_null_key"),
        F.count_distinct(key).alias("keys"), F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    return {"rows_read": r["rows_read"], "rejected_null_key": r["rejected_null_key"],
            "duplicate_in_batch": r["rows_read"] - r["rejected_null_key"] - r["keys"], "lo": r["lo"], "hi": r["hi"]}


def key_bounds(batch: DataFrame, key: str = "id") -> tuple:
    """(lowest, highest) key of a batch: one small aggregate, one row to the driver."""
    r = batch.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    return (r["lo"], r["hi"])


def null_key_rows(batch: DataFrame, key: str = "id") -> DataFrame:
    """The rejected rows of a batch: those with a NULL key."""
    return batch.filter(F.col(key).isNull())
