"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. Targets. Sources share the words of the whole input by weight; a target
   stops at ``max_epochs`` times its source's size and the excess is shared
   again by weight. That is water filling, solved in closed form over one row
   per source.
2. Blocks. Every source's documents get a random permutation (a hash of id and
   seed) and are cut along it into blocks of about ``block_words`` words. A
   target is ``passes`` whole copies of the source plus a remainder, counted in
   blocks: the blocks of lowest permuted rank.
3. Splitting tree. The exact block quotas of all sources are partitioned among
   output shards by a binary tree: a node hands each half of its shards a
   multivariate-hypergeometric share of its block counts, so every shard gets
   the mix in proportion, quotas add up exactly, and each node depends on the
   seed and its own path alone (a lost task draws the same numbers again).
4. Placement. A shard's share of a source is a run of consecutive block draws,
   so draws are disjoint. In the permutation's order a run is an interval of
   hashes: a document is copied once for every run that its hash falls into, and
   what the mix takes of it follows from these copies alone. Rows are shuffled
   inside their shard by hash.

Texts never move for steps 1-3; only (id, source, size) rows do. Step 4 tests a
row's hash against the runs of its source inside the scan, then moves each copy
once, to its shard. A source with a third of all rows is ranked in many buckets
of its permutation, so no task holds a whole source.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.llm.scratch import documents, written

SEED = 20
MAX_EPOCHS = 3
#: Words of a block; a source smaller than ``MIN_BLOCKS`` such blocks is cut finer.
BLOCK_WORDS = 65_536
MIN_BLOCKS = 512
#: Rows of one source ranked by one window partition, about.
BUCKET_ROWS = 2_000
SHARDS = 64
#: Blocks of one node that are dealt by random draws; beyond, every source is halved exactly and only its odd block is drawn.
DRAWN_BLOCKS = 10**9 - 1
#: Sources up to which their runs are broadcast (at most ``SHARDS + MAX_EPOCHS + 1`` intervals each); counted first.
BROADCAST_SOURCES = 5_000
#: Text of one task that writes a part of a shard, about.
PART_BYTES = 64 << 20
_KEY_ORDER = -(1 << 63)


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs; null is 0. Every word becomes one letter, white space goes; no array of words is built."""
    letters = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]++", "x")
    return F.length(F.translate(letters, " \t\n\x0b\x0c\r", "")).cast("long")


def permutation_key(row_id: Column, text: Column, seed: int = SEED) -> Column:
    """A row's place in its source's random permutation: rows ascend by this hash. Equal rows have equal keys."""
    return F.xxhash64(F.lit(seed), row_id, F.coalesce(text.cast("string"), F.lit("")))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, key): the narrow rows that all further steps use."""
    ids, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return docs.select(ids.alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"), n_words(text.cast("string")).alias("size"),
                       permutation_key(ids, text, seed).alias("key"))


def targets(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, n_docs, source_size, target): one row per source.

    Weights repeat over the sources by code point, null last. Water filling:
    sources ordered by cap/weight; those before the break point stop at their
    cap, the rest share what is left by weight. The windows run over one row
    per source.
    """
    per = rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    cap = F.col("source_size").cast("double") * max_epochs
    order = W.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), "source")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    filled = (
        per.withColumn("_w", weight).withColumn("_cap", cap)
        .withColumn("_total", F.sum("source_size").over(every).cast("double"))
        .withColumn("_cap_before", F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn("_w_left", F.sum("_w").over(order.rowsBetween(0, W.unboundedFollowing)))
        # level at which this source and all after it would share the rest
        .withColumn("_level", (F.col("_total") - F.col("_cap_before")) / F.col("_w_left"))
        .withColumn("_stops", F.col("_level") * F.col("_w") >= F.col("_cap"))
    )
    level = F.min(F.when(~F.col("_stops"), F.struct(F.col("_cap") / F.col("_w"), "_level"))).over(every)["_level"]
    target = F.when(F.col("_stops"), F.col("_cap")).otherwise(F.least(level * F.col("_w"), F.col("_cap")))
    return filled.withColumn("target", target).select("source", "n_docs", "source_size", "target")


def blocks(rows: DataFrame, goal: DataFrame) -> DataFrame:
    """Every row with its block number along its source's random permutation, and the source's goal.

    A running sum per source in two levels: sums of hash buckets (one small row
    each) give every bucket's offset, then a window inside the bucket.
    """
    plan = goal.select(
        F.col("source").alias("_s"), "n_docs", "source_size", "target",
        F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.col("source_size") / MIN_BLOCKS))).cast("long").alias("block_words"),
        F.greatest(F.lit(1), F.ceil(F.col("n_docs") / BUCKET_ROWS)).cast("long").alias("_buckets"))
    keyed = rows.join(plan, F.col("source").eqNullSafe(F.col("_s")), "inner").drop("_s")
    # the key's upper 32 bits as a number that ascends with it, scaled to the bucket count: buckets are ranges of the permutation
    high = F.shiftrightunsigned(F.col("key").bitwiseXOR(F.lit(_KEY_ORDER)), 32)
    keyed = keyed.withColumn("_bucket", F.shiftright(high * F.col("_buckets"), 32))
    sums = keyed.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    ahead = W.partitionBy("source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(F.col("source").alias("_s"), F.col("_bucket").alias("_b"),
                          F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_offset"))
    within = W.partitionBy("source", "_bucket").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = keyed.withColumn("_inside", F.coalesce(F.sum("size").over(within), F.lit(0))).join(
        offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")), "inner")
    return placed.withColumn("block", F.floor((F.col("_offset") + F.col("_inside")) / F.col("block_words")).cast("long")).select(
        "doc_id", "source", "size", "key", "n_docs", "source_size", "target", "block_words", "block")


def quotas(goal: DataFrame) -> DataFrame:
    """(source, passes, blocks, quota): whole copies, blocks of the source, and blocks drawn once more."""
    bw = F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.col("source_size") / MIN_BLOCKS))).cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("target") - passes * F.col("source_size")
    return goal.select("source", passes.alias("passes"), F.ceil(F.col("source_size") / bw).cast("long").alias("blocks"),
                       F.round(rest / bw).cast("long").alias("quota"))


def split_node(counts: np.ndarray, left: int, right: int, path: str, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A node's block counts dealt to its halves: multivariate hypergeometric, or exact halves where counts are huge.

    The left half receives ``left / (left + right)`` of all blocks, drawn without
    replacement from the sources' counts; the generator is seeded by the path.
    """
    total = int(counts.sum())
    if total > DRAWN_BLOCKS:  # every source's exact share, rounded down, and the blocks left over by draws
        low, high = (np.array([int(n) * part // (left + right) for n in counts], np.int64) for part in (left, right))
        more, rest = split_node(counts - low - high, left, right, path + "+", seed)  # one block a source at most
        return low + more, high + rest
    take = total * left // (left + right)
    rng = np.random.default_rng(int.from_bytes(hashlib.sha256(f"{seed}:{path}".encode()).digest()[:8], "big"))
    dealt = rng.multivariate_hypergeometric(counts, take, method="marginals") if total else counts
    return dealt, counts - dealt


def split_tree(quota: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(source, shard, first, last): every shard's run of block draws of every source.

    A source's draws are numbered 0 .. passes * blocks + quota - 1 (pass by
    pass). One level of the tree is one grouped pass over (node, source) rows:
    nodes are split independently, a node's group has one row per source.
    """
    level = quota.where(F.col("passes") * F.col("blocks") + F.col("quota") > 0).select(
        F.lit("r").alias("path"), F.lit(0).alias("lo"), F.lit(shards).alias("hi"), "source",
        (F.col("passes") * F.col("blocks") + F.col("quota")).alias("n"))
    schema = "path string, lo int, hi int, source string, n long"

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("source", na_position="last")
        path, lo, hi = pdf["path"].iloc[0], int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0])
        if hi - lo == 1:
            return pdf
        mid = (lo + hi) // 2
        left, right = split_node(pdf["n"].to_numpy(np.int64), mid - lo, hi - mid, path, seed)
        return pd.concat([pdf.assign(path=path + "0", hi=mid, n=left), pdf.assign(path=path + "1", lo=mid, n=right)])

    for _ in range(max(0, (shards - 1).bit_length())):
        level = level.groupBy("path").applyInPandas(split, schema)
    upto = W.partitionBy("source").orderBy("lo")
    last = F.sum("n").over(upto)
    return level.select("source", F.col("lo").alias("shard"), (last - F.col("n")).alias("first"), last.alias("last")).where("last > first")


def runs(placed: DataFrame, quota: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(_mix_source, _mix_runs): for every source its runs as intervals of permutation keys, by pass and key.

    A run of the splitting tree is cut at the ends of passes; a cut's blocks are
    consecutive, so its documents are those from its first key on to the first
    key of the next cut of that pass, the last one's to its own last key. One row
    per source, with ``shards`` + passes intervals at most.
    """
    b = F.col("blocks")
    cuts = split_tree(quota, shards, seed).withColumnsRenamed({"source": "_t"}).join(
        quota.select("source", "blocks"), F.col("_t").eqNullSafe(F.col("source"))).withColumn(
        "pass", F.explode(F.sequence(F.floor(F.col("first") / b), F.floor((F.col("last") - 1) / b)))).select(
        "source", F.struct("pass", F.greatest(F.col("first") - F.col("pass") * b, F.lit(0)).alias("from"),
                           F.least(F.col("last") - F.col("pass") * b, b).alias("to"), "shard").alias("cut"))
    per = cuts.groupBy(F.col("source").alias("_c")).agg(F.collect_list("cut").alias("cuts"))
    # blocks, not documents: their first and last keys
    ends = placed.join(quota.select(F.col("source").alias("_q"), "blocks"), F.col("source").eqNullSafe(F.col("_q"))).groupBy(
        "source", F.least("block", F.col("blocks") - 1).alias("block")).agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    held = ends.join(per, F.col("source").eqNullSafe(F.col("_c"))).select("source", "block", "lo", "hi", F.explode(F.filter(
        "cuts", lambda c: (c["from"] <= F.col("block")) & (F.col("block") < c["to"]))).alias("cut"))
    found = held.groupBy("source", "cut.pass", "cut.shard").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    upto = F.lead("lo").over(W.partitionBy("source", "pass").orderBy("lo"))  # the cuts of a source
    found = found.withColumn("upto", upto)
    return found.groupBy(F.col("source").alias("_mix_source")).agg(F.array_sort(F.collect_list(F.struct("pass", "lo", "upto", "hi", "shard"))).alias("_mix_runs"))


def drawn_by(key: Column) -> Column:
    """The runs of a row's source that its permutation key falls into: one for each copy that the mix takes."""
    return F.filter(F.coalesce(F.col("_mix_runs"), F.array().cast(_RUNS)),
                    lambda r: (r["lo"] <= key) & F.when(r["upto"].isNull(), key <= r["hi"]).otherwise(key < r["upto"]))


_RUNS = "array<struct<pass:bigint,lo:bigint,upto:bigint,hi:bigint,shard:int>>"


class Mixture:
    """A mixture worked out: ``rows`` (placed narrow rows), ``goal`` (one row per source) and ``runs``, all written tables."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS, seed: int = SEED, shards: int = SHARDS):
        self.columns, self.seed, self.shards = (id_col, text_col, source_col), seed, shards
        rows = written(sized(docs, id_col, text_col, source_col, seed), "mix-sizes")
        self.goal = written(targets(rows, weights, max_epochs), "mix-targets")
        self.rows = written(blocks(rows, self.goal), "mix-blocks")
        self.quota = written(quotas(self.goal), "mix-quotas")
        self.runs = written(runs(self.rows, self.quota, shards, seed), "mix-runs")

    def with_runs(self, rows: DataFrame, source: Column) -> DataFrame:
        """``rows`` with the runs of their source. The runs are broadcast only up to a counted number of sources."""
        small = self.goal.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
        return rows.join(F.broadcast(self.runs) if small else self.runs, source.eqNullSafe(F.col("_mix_source")), "left").drop("_mix_source")

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target, taken, source, block, passes, drawn, first_shard: one row per input row."""
        q = self.quota.select(F.col("source").alias("_q"), "passes")
        rows = self.with_runs(self.rows.join(q, F.col("source").eqNullSafe(F.col("_q"))).drop("_q"), F.col("source"))
        rows = rows.withColumn("_drawn", drawn_by(F.col("key")))
        return rows.select(
            "doc_id", "size", "source_size", "target", (F.col("size") * F.size("_drawn")).alias("taken"), "source", "block", "passes",
            (F.size("_drawn") > F.col("passes")).alias("drawn"), F.array_min(F.transform("_drawn", lambda r: r["shard"])).alias("first_shard"))

    def copies(self, docs: DataFrame) -> DataFrame:
        """``docs`` with every row once for each run that draws it, plus ``_mix_shard`` and its place there, ``_mix_place``."""
        ids, text, source = (F.col(f"`{c}`") for c in self.columns)
        rows = self.with_runs(docs.withColumn("_mix_key", permutation_key(ids, text, self.seed)), source.cast("string"))
        rows = rows.withColumn("_mix_run", F.explode(drawn_by(F.col("_mix_key"))))
        return rows.withColumns({"_mix_shard": F.col("_mix_run.shard"), "_mix_place": F.xxhash64(
            F.lit(self.seed + 1), "_mix_key", "_mix_run.pass")}).drop("_mix_runs", "_mix_key", "_mix_run")

    def shuffled(self, docs: DataFrame) -> DataFrame:
        """The mixture's rows (columns of ``docs``), every task a part of one or more shards, shuffled inside it.

        Each copy's text moves once. A shard is dealt to several tasks by its
        places, so a task's share is bounded whatever a shard's size.
        """
        words = self.goal.agg(F.sum("target").alias("n")).first()["n"] or 0
        parts = max(1, int(-(-words * 8 // PART_BYTES)))
        deal = F.pmod("_mix_place", F.lit(max(1, 8 * parts // self.shards)))
        return self.copies(docs).withColumn("_mix_deal", deal).repartition(parts, "_mix_shard", "_mix_deal").sortWithinPartitions(
            "_mix_shard", "_mix_place").select(*[F.col(f"`{c}`") for c in docs.columns])


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = MAX_EPOCHS, seed: int = SEED, shards: int = SHARDS,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, plus source, block, passes, drawn and first_shard: one row per input row.

    ``taken`` counts the words that the mix takes of the document: its size for
    every run of the splitting tree that draws it. Edges: a null text has size 0;
    a null source is a source of its own, last in order; a source of size 0 has
    target 0 and is drawn by no shard; rows that are equal in id, text and source are
    treated alike; an empty table gives an empty result; other columns are ignored.
    """
    return Mixture(docs, id_col, text_col, source_col, weights, max_epochs, seed, shards).taken()


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shards: int = SHARDS) -> DataFrame:
    """``docs`` with every row as often as the mixture takes it, dealt to shards and shuffled there; the same columns.

    A row's copies follow from its own id, text and source, so rows that share an id are each decided by their own text.
    """
    return Mixture(docs, id_col, text_col, source_col, shards=shards).shuffled(docs)


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of all documents, each with the shard of its first copy (null where the mix takes none)."""
    return mix(documents(spark, sf_dir, "doc_id", "text", "source"))
