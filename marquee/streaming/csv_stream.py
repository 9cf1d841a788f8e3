"""CSV deliveries as a stream, with the batch job's semantics.

A CSV stream with a declared schema reads fields by position, so a file whose
header has another order would be loaded into the wrong columns. Here the
stream carries only the names of arrived files; each micro-batch reads its files
by their own headers and loads them as the batch job loads a folder: extra columns
are kept as text, lines that do not fit are rejects with their text, every row is
counted, and the counts go to the load log under the stream's id and the batch's
number. A micro-batch that runs again after a failure is a replay of that load.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from marquee.plans.jobs import load_csv_files
from marquee.sources.load_log import COUNTS

_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_files(spark: SparkSession, folder: str, glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """(path) of every file that arrives in ``folder``; contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(_FILE)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(folder).select("path")


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Id that Spark gave the stream when it made the checkpoint: a new checkpoint is another stream."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


def ingest_csv_stream(
    spark: SparkSession, source: str, raw_output_path: str, checkpoint: str, state_path: str, rejects_path: str | None = None,
    multi_line: bool = True, glob: str | None = None, max_files_per_trigger: int | None = None, **table,
) -> dict:
    """Load all files that arrived since the checkpoint and stop; returns the micro-batches run and their summed counts.

    ``table`` are the options of ``load_csv_files`` (columns, types, key,
    partition column) for other tables than the catalogue. The file names of one
    micro-batch come to the driver, as the file source's own log has them there;
    ``max_files_per_trigger`` bounds them.
    """
    seen: list[dict] = []

    def load(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        paths = sorted({r["path"] for r in batch.collect()})  # a file may be listed more than once in a batch
        seen.append(load_csv_files(
            session, paths, raw_output_path, rejects_path, multi_line, state_path, f"{_stream_id(session, checkpoint)}-{epoch_id:09d}", **table))

    stream = arriving_files(spark, source, glob, max_files_per_trigger)
    query = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    largest = max((c["max_id"] for c in seen if c["max_id"] is not None), default=None)
    return {"micro_batches": len(seen), **{c: sum(x[c] for x in seen) for c in COUNTS if c != "max_id"}, "max_id": largest}
