"""External partitioned table over the cleaned zone, and the named views."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from marquee import schema as S


def _ddl_columns(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_external_table(
    spark: SparkSession, name: str, location: str, schema: T.StructType = S.CLEAN_SCHEMA, partition_col: str = "month",
    replace: bool = False, partitions: list[str] | None = None,
) -> DataFrame:
    """Register a Parquet folder partitioned by ``partition_col`` as a table and recover its partitions.

    ``partitions`` names those to register, without listing the folder; by default all are found.

    The table is external (``LOCATION``): dropping it leaves the data. A table of
    that name is only replaced on request, and only if it is external. Partitions
    written by another job are only visible after ``MSCK REPAIR TABLE``.
    """
    if spark.catalog.tableExists(name):
        if not replace:
            raise ValueError(f"table {name} exists")
        if spark.catalog.getTable(name).tableType != "EXTERNAL":
            raise ValueError(f"{name} is no external table: replacing it would delete its data")
        spark.sql(f"DROP TABLE {name}")
    place = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({_ddl_columns(schema)}) USING parquet "
        f"PARTITIONED BY (`{partition_col}`) LOCATION '{place}'"
    )
    if partitions is None:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    else:
        refresh_partitions(spark, name, partition_col, partitions)
    return spark.table(name)


def refresh_partitions(spark: SparkSession, name: str, partition_col: str, values: list[str]) -> None:
    """Make the table see partitions that a load wrote, and only those (A7): new ones are added, rewritten ones read anew.

    Each gets its own row count and size in the catalogue. Nothing is listed or
    read of the other partitions, so the work is that of the load, however old the
    table is (``MSCK REPAIR`` lists them all).
    """
    specs = [f"PARTITION (`{partition_col}` = '" + v.replace("\\", "\\\\").replace("'", "\\'") + "')" for v in values]
    if specs:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs)}")
        spark.sql(f"REFRESH TABLE {name}")  # drops cached file names
    for spec in specs:
        spark.sql(f"ANALYZE TABLE {name} {spec} COMPUTE STATISTICS")


def partition_rows(spark: SparkSession, name: str, partition_col: str) -> DataFrame:
    """(partition value, rows, bytes) of every registered partition, from the catalogue's statistics; no data is read."""
    found = []
    for r in spark.sql(f"SHOW PARTITIONS {name}").collect():
        value = unquote(r["partition"].split("=", 1)[1])  # told as in the folder's name
        spec = f"PARTITION (`{partition_col}` = '" + value.replace("'", "\\'") + "')"
        told = {x["col_name"]: x["data_type"] for x in spark.sql(f"DESCRIBE EXTENDED {name} {spec}").collect()}
        sizes = dict(part.strip().split(" ")[::-1] for part in (told.get("Partition Statistics") or "").split(",") if part.strip())
        found.append((value, int(sizes["rows"]) if "rows" in sizes else None, int(sizes["bytes"]) if "bytes" in sizes else None))
    return spark.createDataFrame(found, f"`{partition_col}` string, rows long, bytes long")


# Spark SQL of the three views. ``{src}`` is the table over the cleaned zone.
# Tokens are normalised and filtered inside the array before ``explode`` (as in
# ``operators.tokens``): a filter on the generated column cannot be pushed below
# the Generate node, so rejected tokens would otherwise become rows first.
RELEASE_VIEW = """
SELECT id, revenue, release_date, year AS release_year, month AS release_month,
       budget, status, vote_average, vote_count
FROM {src}
WHERE release_date IS NOT NULL
"""

GENRE_VIEW = """
SELECT release_year, release_month, genre, count(*) AS movie_count,
       sum(budget) AS total_budget_by_genre, sum(revenue) AS total_revenue_by_genre,
       sum(vote_count) AS total_votes_by_genre,
       try_divide(covar_pop(b, r), stddev_pop(b) * stddev_pop(r)) AS budget_revenue_correlation
FROM (
  SELECT id, revenue, budget, vote_count, release_date,
         year(release_date) AS release_year, month(release_date) AS release_month,
         genre,
         CASE WHEN revenue IS NOT NULL THEN CAST(budget AS DOUBLE) END AS b,
         CASE WHEN budget IS NOT NULL THEN CAST(revenue AS DOUBLE) END AS r
  FROM {src}
  LATERAL VIEW explode(
    filter(transform(split(genres, ', '), g -> lower(trim(g))), g -> g IN ({genres}))
  ) t AS genre
)
GROUP BY release_year, release_month, genre
"""

COMPANY_VIEW = """
WITH company_first_year AS (
  SELECT production_company, min(release_year) AS release_year
  FROM (
    SELECT year(release_date) AS release_year, production_company
    FROM {src}
    LATERAL VIEW explode(
      filter(transform(split(production_companies, ', '), pc -> lower(trim(pc))),
             pc -> pc IS NOT NULL AND pc NOT IN ({deny}) AND length(pc) > {min_len} AND pc RLIKE '{pattern}')
    ) t AS production_company
  )
  GROUP BY production_company
),
debuts_per_year AS (
  SELECT release_year, count(*) AS pc_distinct_count
  FROM company_first_year
  GROUP BY release_year
)
SELECT release_year, pc_distinct_count,
       sum(pc_distinct_count) OVER (ORDER BY release_year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pc_cumm_count
FROM debuts_per_year
"""


def _quote_list(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# In the company view, the first year of a company is ``min(release_year)``:
# equal to ``dense_rank() OVER (PARTITION BY company ORDER BY release_year) = 1``
# with NULLs last (the view's original engine), without a window that would put
# every row of one company into one task.


def create_views(
    spark: SparkSession,
    src: str,
    genres: list[str] = S.GENRE_ALLOW,
    deny: list[str] = S.COMPANY_DENY,
    prefix: str = "",
    persistent: bool = False,
) -> dict[str, str]:
    """Create the release, genre and company-growth views over table ``src``.

    Returns {view name: SQL body}, in that order: ``{prefix}catalogue_releases``,
    ``{prefix}catalogue_by_genre``, ``{prefix}company_cumulative``. ``persistent``
    views stay in the catalogue after the session and need ``src`` to be a table.
    """
    pattern = S.COMPANY_NAME_PATTERN.replace("\\", "\\\\")
    views = {
        f"{prefix}catalogue_releases": RELEASE_VIEW.format(src=src),
        f"{prefix}catalogue_by_genre": GENRE_VIEW.format(src=src, genres=_quote_list(genres)),
        f"{prefix}company_cumulative": COMPANY_VIEW.format(
            src=src, deny=_quote_list(deny), min_len=S.COMPANY_MIN_LENGTH, pattern=pattern
        ),
    }
    kind = "VIEW" if persistent else "TEMPORARY VIEW"
    for name, body in views.items():
        spark.sql(f"CREATE OR REPLACE {kind} {name} AS {body}")
    return views
