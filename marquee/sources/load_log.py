"""State of incremental loads: an append-only log, one row per completed load.

It holds what the original job kept in local files (the schema and the last
processed id) and what became of every row of each load. A load has an id given
by its caller (a batch id of a stream, a delivery's date); running it again under
the same id is a replay:

* ``begin`` is logged before anything is written, ``commit`` after the data. Both
  only append, so no record is ever rewritten and readers see whole records.
* A committed load is not run again: its logged counts are returned.
* A load that began and did not commit may or may not have published its rows.
  Rows carry their load's id in the sink (``LOAD_ID``), so the replay counts
  what an earlier attempt published as its own: counts come out as if the load
  had run once.

The log lives beside the zones on shared storage; a record is one small file.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.sources.files import read_parquet_or_empty

#: Column of the sink that names the load a row came with.
LOAD_ID = "load_id"
#: Counts of a load, in order; every row read is in exactly one of the four after the first.
COUNTS = ["rows_read", "rejected_null_key", "duplicate_in_batch", "already_in_sink", "new_rows", "max_id"]
BEGUN, DONE = "begun", "done"

LOG_SCHEMA = T.StructType(
    [T.StructField(LOAD_ID, T.StringType()), T.StructField("phase", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in COUNTS]
    + [T.StructField("schema_json", T.StringType()), T.StructField("logged_at", T.TimestampType())]
)


class LoadLog:
    """The log at ``path`` (Parquet files)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def records(self) -> DataFrame:
        return read_parquet_or_empty(self.spark, self.path, LOG_SCHEMA)

    def _append(self, load_id: str, phase: str, counts: dict, schema: T.StructType | None) -> None:
        whole = [v if isinstance(v, int) else None for v in map(counts.get, COUNTS)]  # a key that is no number has no largest id
        row = (load_id, phase, *whole, schema.json() if schema is not None else None, None)
        record = self.spark.createDataFrame([row], LOG_SCHEMA).withColumn("logged_at", F.current_timestamp())
        record.coalesce(1).write.mode("append").parquet(self.path)

    def phases(self, load_id: str) -> set[str]:
        return {r["phase"] for r in self.records().where(F.col(LOAD_ID) == load_id).select("phase").distinct().collect()}

    def counts(self, load_id: str) -> dict | None:
        """The counts of a committed load, else None."""
        row = self.loads().where(F.col(LOAD_ID) == load_id).first()
        return None if row is None else {c: row[c] for c in COUNTS}

    def begin(self, load_id: str) -> None:
        self._append(load_id, BEGUN, {}, None)

    def commit(self, load_id: str, counts: dict, schema: T.StructType) -> None:
        self._append(load_id, DONE, counts, schema)

    def loads(self) -> DataFrame:
        """One row per completed load: load_id and its counts."""
        done = self.records().where(F.col("phase") == DONE)
        first = F.min_by(F.struct(*COUNTS), "logged_at").alias("c")
        return done.groupBy(LOAD_ID).agg(first).select(LOAD_ID, *[F.col(f"c.{c}").alias(c) for c in COUNTS])

    def last_id(self) -> int | None:
        """Largest key of all completed loads (the original's ``last_processed_id``)."""
        return self.loads().agg(F.max("max_id").alias("m")).first()["m"]

    def last_schema(self) -> T.StructType | None:
        """Schema that the latest completed load wrote (the original's schema file)."""
        row = self.records().where(F.col("phase") == DONE).orderBy(F.desc("logged_at"), F.desc(LOAD_ID)).select("schema_json").first()
        return None if row is None else T.StructType.fromJson(json.loads(row["schema_json"]))
