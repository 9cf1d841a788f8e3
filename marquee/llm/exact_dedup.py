"""Exact deduplication with a heavy-hitter split (native DataFrame operators only).

Texts are equal when identical after no change (a null text counts as empty).
Digests that many rows share would make hot shuffle keys, so they take another
way: a Misra-Gries type sketch (``approx_top_k``, a fixed number of counters)
names every digest that can hold more than ``1/heavy_items`` of the rows, one
exact aggregate over only those digests verifies them and finds each one's
winner, and the winners table (at most ``heavy_items`` rows, so its size is
proven) is broadcast: heavy rows are resolved on the map side, in the scan.
The remaining digests, each below that share, use one ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.llm.bitmap import bitmap, split
from marquee.llm.scratch import documents, id_and_text, written

#: Digests the sketch may name, hence the bound on the broadcast winners (about 100 bytes each).
HEAVY_ITEMS = 1024


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_sha256): the only columns that travel; the text stays in the scan."""
    d = id_and_text(docs, id_col, text_col)
    return d.select("doc_id", F.sha2("text", 256).alias("text_sha256"))


def heavy_winners(digest_rows: DataFrame, heavy_items: int = HEAVY_ITEMS) -> DataFrame:
    """(text_sha256, keep_id, group_size) of frequent digests, exact, at most ``heavy_items`` rows.

    The sketch only names candidates; counts and winners come from all rows.
    A digest named without being frequent is as right as any other.
    """
    top = digest_rows.select("text_sha256").agg(
        F.expr(f"approx_top_k(text_sha256, {heavy_items}, {16 * heavy_items})").alias("top"))
    named = top.select(F.explode("top").alias("t")).where("t.count > 1").select(F.col("t.item").alias("text_sha256"))
    return (
        digest_rows.join(F.broadcast(named), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy_items: int = HEAVY_ITEMS
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest ``doc_id`` stays. Defined results at
    the edges: null texts equal empty texts; a null ``doc_id`` loses to any other
    and is kept only where its whole group is null; rows that repeat the winning
    ``doc_id`` with the same text are all marked kept, because an identical row
    cannot be told from its copy (``keep_first`` keeps all of those); an empty input gives an empty result; other columns are ignored.
    """
    rows = written(digests(docs, id_col, text_col), "digests")  # texts are hashed once
    heavy = heavy_winners(rows, heavy_items)
    known = rows.join(F.broadcast(heavy), "text_sha256", "left")
    resolved = known.where(F.col("group_size").isNotNull())
    light = known.where(F.col("group_size").isNull()).select("doc_id", "text_sha256")
    by = W.partitionBy("text_sha256")
    light = light.withColumns({"keep_id": F.max("doc_id").over(by), "group_size": F.count(F.lit(1)).over(by)})
    columns = ("doc_id", "keep_id", "group_size", "text_sha256")
    return (
        resolved.select(*columns).unionByName(light.select(*columns))
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy_items: int = HEAVY_ITEMS) -> DataFrame:
    """``docs`` with one row of each group of equal texts, same columns.

    The table loses the rows that are not winners, by an anti-join on digest and
    id: a (digest, id) pair is a key of its own, so a hot text is no hot key. Only
    rows whose id a bitmap of the losers' ids may hold reach that join; the texts
    of all others never leave the scan. Rows that repeat a winner's id and text
    all stay.
    """
    ids, digest = F.col(f"`{id_col}`"), F.sha2(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), 256)
    lost = exact_dedup(docs, id_col, text_col, heavy_items).where(~F.col("kept"))
    losers = written(lost.select(F.col("doc_id").alias("_dedup_id"), F.col("text_sha256").alias("_dedup_digest"),
                                 F.xxhash64("doc_id").alias("h")), "copies")
    possible, others = split(docs, F.xxhash64(ids), *bitmap(losers))
    keys = losers.select("_dedup_id", "_dedup_digest").distinct()
    left = possible.withColumn("_dedup_sha", digest).join(
        keys, (F.col("_dedup_sha") == F.col("_dedup_digest")) & ids.eqNullSafe(F.col("_dedup_id")), "left_anti")
    return others.unionByName(left.drop("_dedup_sha"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir, "doc_id", "text"))


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
WINDOW w AS (PARTITION BY text_sha256)
"""
