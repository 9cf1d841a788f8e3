"""The driver's order tables reshaped into the catalogue's raw model.

The test data holds no film catalogue, so one is derived from the order tables
(one catalogue title per order); every query then runs over whole tables and
its work grows with them. Mapping:

=====================  ==========================================================
id                     ``orders.o_orderkey``
status                 ``orders.o_orderstatus`` (F, O, P)
release_date           ``orders.o_orderdate`` as date
title                  ``customer.c_name`` (inner join on custkey)
budget                 ``customer.c_acctbal`` as decimal(18,2) (has negatives)
revenue                per order: sum of ``l_extendedprice`` in cents, as decimal(18,2); NULL without items
runtime                per order: ``int(sum(l_quantity))``
vote_count             per order: number of line items
vote_average           per order: ``avg(l_quantity)``
genres                 per order: sorted distinct ``p_type`` joined by ``", "``
production_companies   per order: sorted distinct ``p_name`` (spaces to dots) joined by ``", "``
=====================  ==========================================================

Plan shape: one scan of ``lineitem`` joined to ``part`` on the part key, one
aggregation per order (partial aggregation map-side; the token sets are
bounded by the distinct values inside one order), then ``orders`` joined to
``customer`` and to the per-order rows. No broadcast is forced: Catalyst and
AQE broadcast ``part``/``customer`` only when their measured size is under
``spark.sql.autoBroadcastJoinThreshold``, and use a shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import schema as S
from marquee.functions.stats import from_cents, to_cents
from marquee.sources.tables import table

#: Statuses of the order data that count as known (P maps to "Others").
ORDER_STATUS_ALLOW = ["F", "O"]
#: Genres (part types) kept by the genre analysis over the derived catalogue.
ORDER_GENRE_ALLOW = ["economy", "small", "medium", "promo", "standard", "na"]
#: Tokens that are not company names over the derived catalogue.
ORDER_COMPANY_DENY = ["economy", "small", "medium", "promo", "standard", "large", "na", ""]
#: Vote average bound for the derived catalogue (quantities average about 25).
ORDER_VOTE_BOUNDS = (0.0, 40.0)


def _sorted_joined(c) -> F.Column:
    return F.array_join(F.sort_array(F.collect_set(c)), S.TOKEN_SEPARATOR)


def order_lines(spark: SparkSession, sf_dir: str, with_tokens: bool = True) -> DataFrame:
    """Per-order measures and token lists from ``lineitem`` ⋈ ``part``.

    Token text is derived on the ``part`` side (one row per part, not per line)
    and with ``translate`` (a character map, no regex). The aggregation keeps
    its map-side partial phase so an order holding a large share of the line
    items is reduced before the shuffle; its token sets are bounded by the
    distinct values in the order.
    """
    measures = [
        from_cents(F.sum(to_cents("l_extendedprice"))).alias("revenue"),
        F.sum("l_quantity").cast("int").alias("runtime"),
        F.count(F.lit(1)).cast("int").alias("vote_count"),
        F.avg("l_quantity").alias("vote_average"),
    ]
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity")
    if not with_tokens:  # a left join without a declared unique key is never dropped, so it is not written
        none = F.lit(None).cast("string")
        return li.groupBy("l_orderkey").agg(*measures).withColumns({"genres": none, "production_companies": none})
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_type", F.translate("p_name", " ", ".").alias("p_company")
    )
    lines = li.join(part, li.l_partkey == part.p_partkey, "left")
    return lines.groupBy("l_orderkey").agg(
        *measures,
        _sorted_joined(F.col("p_type")).alias("genres"),
        _sorted_joined(F.col("p_company")).alias("production_companies"),
    )


def catalogue(spark: SparkSession, sf_dir: str, with_tokens: bool = True) -> DataFrame:
    """Typed raw catalogue (the columns of the cleaned zone's source, before cleaning).

    ``with_tokens=False`` leaves genres and companies NULL and reads no ``part``.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    per_order = order_lines(spark, sf_dir, with_tokens)
    joined = (
        orders.join(cust, orders.o_custkey == cust.c_custkey, "inner")
        .join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    )
    return joined.select(
        F.col("o_orderkey").alias("id"),
        F.col("c_name").alias("title"),
        F.col("vote_average"),
        F.col("vote_count"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("release_date"),
        F.col("revenue"),
        F.col("runtime"),
        F.col("c_acctbal").cast(S.MONEY).alias("budget"),
        F.col("genres"),
        F.col("production_companies"),
    )


def catalogue_text(spark: SparkSession, sf_dir: str, with_tokens: bool = True) -> DataFrame:
    """The catalogue as a CSV would deliver it: every column text (dates as ISO text)."""
    cat = catalogue(spark, sf_dir, with_tokens)
    return cat.select([F.col(c).cast("string").alias(c) for c in cat.columns])


# DuckDB text of the same derivation, used by the SQL oracle. Kept next to the
# DataFrame form so the two are edited together.
ORACLE_CTE = """
lines AS (
  SELECT l.l_orderkey,
         sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS revenue,
         CAST(sum(l.l_quantity) AS INTEGER) AS runtime,
         CAST(count(*) AS INTEGER) AS vote_count,
         avg(l.l_quantity) AS vote_average,
         array_to_string(list_sort(list_distinct(list(p.p_type) FILTER (WHERE p.p_type IS NOT NULL))), ', ') AS genres,
         array_to_string(list_sort(list_distinct(list(replace(p.p_name, ' ', '.')) FILTER (WHERE p.p_name IS NOT NULL))), ', ')
           AS production_companies
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY l.l_orderkey
),
cat AS (
  SELECT o.o_orderkey AS id, c.c_name AS title, lines.vote_average, lines.vote_count,
         o.o_orderstatus AS status, CAST(o.o_orderdate AS DATE) AS release_date,
         lines.revenue, lines.runtime, CAST(c.c_acctbal AS DECIMAL(18,2)) AS budget,
         lines.genres, lines.production_companies
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN lines ON lines.l_orderkey = o.o_orderkey
)
"""
