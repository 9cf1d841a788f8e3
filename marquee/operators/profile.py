"""Data-quality profile in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.stats import distinct_with_null


def _unpivot(one_row: DataFrame, cols: Sequence[str], name: str, value: str) -> DataFrame:
    return one_row.unpivot([], list(cols), name, value)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column_name, nulls) for every column: one scan, one aggregate.

    The reference runs one job per column; here all counts share a scan.
    """
    cols = list(cols or df.columns)
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return _unpivot(one, cols, "column_name", "nulls")


def schema_profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, nulls, position): the schema joined with the null profile."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    pos = {c: i for i, c in enumerate(df.columns)}
    prof = null_profile(df)
    type_expr = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    pos_expr = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(pos[c]))])
    return prof.select(
        "column_name",
        type_expr[F.col("column_name")].alias("data_type"),
        F.col("nulls"),
        pos_expr[F.col("column_name")].cast("bigint").alias("position"),
    )


def distinct_profile(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Row count and, per column, distinct values with NULL counted as one (F1, F3), in one aggregate.

    Spark expands the rows once per distinct column (one Expand, one shuffle),
    and de-duplicates (column, value) map-side first, so a value held by a
    third of the rows costs one row per map task.
    """
    one = df.agg(F.count(F.lit(1)).alias("rows"), *[distinct_with_null(c, approx).alias(c) for c in cols])
    return one.select("rows", F.posexplode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_values")) for c in cols])).alias("pos", "s")).select(
        "rows", "s.column_name", "s.distinct_values"
    )


def column_report(df: DataFrame, distinct_cols: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """(column_name, position, data_type, nulls, distinct_values, rows) in one aggregate over one scan (L4).

    ``distinct_values`` counts NULL as a value and is NULL for columns not in
    ``distinct_cols``.
    """
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)]
    aggs += [distinct_with_null(c, approx).alias(f"_d{i}") for i, c in enumerate(cols) if c in distinct_cols]
    one = df.agg(*aggs)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(i).cast("bigint").alias("position"),
            F.lit(types[c]).alias("data_type"),
            F.col(f"_n{i}").alias("nulls"),
            (F.col(f"_d{i}") if c in distinct_cols else F.lit(None).cast("bigint")).alias("distinct_values"),
        )
        for i, c in enumerate(cols)
    ]
    return one.select(F.col("_rows").alias("rows"), F.explode(F.array(*entries)).alias("e")).select(
        "e.column_name", "e.position", "e.data_type", "e.nulls", "e.distinct_values", "rows"
    )


def key_max(df: DataFrame, key: str = "id") -> DataFrame:
    """Row count and the largest key, compared as a number (F1, F2)."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.col(key).try_cast("bigint")).alias("max_id"),
    )
