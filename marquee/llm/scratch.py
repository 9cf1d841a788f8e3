"""Written intermediate tables in the shared folder (lineage cuts that survive lost executors)."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_path
from marquee.sources.tables import table


def written(df: DataFrame, name: str, *folders: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back with its own schema; ``folders`` are partition columns."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    df.write.partitionBy(*folders).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete ``written`` tables that nothing still to be computed reads (what was made of them is written itself)."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        place = sc._jvm.org.apache.hadoop.fs.Path(t.written_at)
        place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)


def any_row(*columns: str) -> list[Column]:
    """Columns of one row of a group, whichever comes first, as aggregates that need no sort (a struct's minimum does). Write the result
    before it is read twice: another run may take another row."""
    return [F.first(c).alias(c) for c in columns]


#: Rows of one Arrow batch, at most: a row holds a whole text.
BATCH_ROWS = 2_000


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they start: it is added to the session once, as ``--py-files`` does.

    Arrow batches are cut to ``BATCH_ROWS`` rows where the session allows more,
    which bounds what a task holds outside the JVM's heap.
    """
    sc = spark.sparkContext
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if getattr(sc, "_marquee_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="marquee-"), "marquee_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "marquee")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._marquee_shipped = True


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The driver's ``documents`` table (all columns, or those named)."""
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    return docs.select(*columns) if columns else docs


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) of any input: other columns, whatever their names, are left behind; a null text is empty."""
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text")
    )
