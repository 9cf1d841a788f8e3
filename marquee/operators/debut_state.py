"""Debut years kept as state and brought forward load by load.

The state is a table of changes, one folder per load: an entity's first year when
it is first seen, and a correction when a later load brings an earlier year. Only
the entities of a load are looked up in the state; the number of debuts per year
is a sum over the changes that reads no entity at all.

Loads have ordered ids. A load is worked out against the loads before it, and its
folder is replaced as a whole, so running it again leaves the state as it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators.growth import debut_year
from marquee.sources.files import read_parquet_or_empty
from marquee.sources.load_log import LOAD_ID


def change_schema(entity: T.DataType = T.StringType(), year: T.DataType = T.StringType()) -> T.StructType:
    """``entity``, its first ``year`` from this load on, and the year it ``was`` where ``moved`` (NULL in the row that marks a load)."""
    return T.StructType([
        T.StructField("entity", entity), T.StructField("year", year), T.StructField("was", year),
        T.StructField("moved", T.BooleanType()), T.StructField(LOAD_ID, T.StringType())])


def debuts(changes: DataFrame) -> DataFrame:
    """(entity, debut_year) after all changes: the earliest year; a NULL year comes before all others."""
    return debut_year(changes, "entity", "year", as_="debut_year")


def apply_load(spark: SparkSession, rows: DataFrame, entity: str, year: str, state_path: str, load_id: str) -> DataFrame:
    """Write the changes that one load makes to the state at ``state_path``; returns the state's changes after it.

    ``rows`` may repeat entities (a hot one is reduced before the shuffle); NULL
    entities are dropped. An id below the latest one that is not in the state
    raises: its changes would have to be worked out before the later ones.
    """
    schema = change_schema(rows.schema[entity].dataType, rows.schema[year].dataType)
    state = read_parquet_or_empty(spark, state_path, schema)
    later = state.where(F.col(LOAD_ID) >= load_id).agg(F.max(LOAD_ID).alias("last"), F.count_if(F.col(LOAD_ID) == load_id).alias("own")).first()
    if later["last"] is not None and later["last"] > load_id and not later["own"]:
        raise ValueError(f"load {load_id} comes before load {later['last']}, which is in the state already")
    first = debut_year(rows.select(F.col(entity).alias("entity"), F.col(year).alias("year")), "entity", "year", as_="year")
    earlier = state.where(F.col(LOAD_ID) < load_id).select("entity", "year")
    known = debuts(earlier.join(first.select("entity"), "entity", "left_semi")).select("entity", F.col("debut_year").alias("was"), F.lit(True).alias("moved"))
    # a NULL year is the earliest
    better = F.col("moved").isNull() | (F.col("was").isNotNull() & (F.col("year").isNull() | (F.col("year") < F.col("was"))))
    changes = first.join(known, "entity", "left").where(better).select(
        "entity", "year", "was", F.coalesce("moved", F.lit(False)).alias("moved"), F.lit(load_id).alias(LOAD_ID))
    # the load itself, so that one without changes is known to be in the state
    mark = spark.createDataFrame([(None, None, None, None, load_id)], schema)
    changes.unionByName(mark).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(LOAD_ID).parquet(state_path)
    return read_parquet_or_empty(spark, state_path, schema)


def debut_counts(changes: DataFrame, as_: str = "debuts") -> DataFrame:
    """Entities per debut year, from the changes alone: one more in the new year, one less in the old one."""
    both = F.array(F.struct(F.col("year").alias("year"), F.lit(1).alias("n")),
                   F.struct(F.col("was").alias("year"), F.when(F.col("moved"), F.lit(-1)).otherwise(F.lit(0)).alias("n")))
    steps = changes.where(F.col("moved").isNotNull()).select(F.explode(both).alias("s")).where("s.n <> 0")
    return steps.groupBy(F.col("s.year").alias("year")).agg(F.sum("s.n").alias(as_)).where(F.col(as_) > 0)
