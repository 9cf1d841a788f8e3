"""Merkle manifest of a dataset: one root per group, one root over the groups, a proof per row.

Rows become leaves, leaves of a group become a tree of ``fanout`` children a
node, and the groups' roots become one more tree of the same kind.

1. Leaves. A row is hashed in the scan; only (id, group, digest) rows travel.
2. Numbers. A leaf's position in its group comes from a range partition by
   (group, id): rows are counted per part, a part's offset is the sum of the
   parts before it, and only inside a part is a window used. Parts hold a bounded
   number of rows, so a group of a third of all rows is many tasks.
3. Slot pivot. One aggregate per level spreads each parent's children into
   ``fanout`` columns by conditional aggregates. The columns concatenated are the
   parent's preimage; without a child's own column they are its siblings.
4. Paths. From the top down a node's path is its siblings followed by its
   parent's path: each level is one join of a run with its parent, so all rows of
   a tree need about ``1 / (1 - 1 / fanout)`` times the joins of its lowest level.

A level is written to the shared folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.llm.scratch import documents, written

FANOUT = 8
#: Rows of one range part (one task's sort), about.
PART_ROWS = 1 << 17
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PATH = "array<struct<before:string,after:string>>"


def field(value: Column) -> Column:
    """A value in a leaf's preimage: ``-`` if null, else its UTF-8 byte count, ``:`` and itself (numbers in decimal)."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Lowercase hex sha256 of the encoded values."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def lower_az(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def numbered(rows: DataFrame, group: str, *order: str, part_rows: int = PART_ROWS) -> DataFrame:
    """``rows`` plus ``idx`` (from 0, by ``order`` inside ``group``) and ``n`` (rows of the group).

    ``rows`` is a written table. Nulls come first. Rows equal in all of
    ``order`` are told apart by their place in the table, so no part is larger for them.
    """
    count = rows.count()
    parts = max(1, -(-count // part_rows))
    cut = rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(
        parts, F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], F.col("_at"))
    cut = written(cut.withColumn("_part", F.spark_partition_id()), "merkle-parts")
    sizes = cut.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_size"))  # (group, part) pairs: parts + groups at most
    ahead = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(F.col(group).alias("_g"), F.col("_part").alias("_p"),
                           F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_offset"),
                           F.sum("_size").over(W.partitionBy(group)).alias("n"))
    within = W.partitionBy("_part", group).orderBy(*[F.col(c).asc_nulls_first() for c in order], F.col("_at"))
    placed = cut.withColumn("_inside", F.row_number().over(within) - 1)
    return placed.join(offsets, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g"))).withColumn(
        "idx", F.col("_offset") + F.col("_inside")).drop("_at", "_part", "_p", "_g", "_offset", "_inside")


def runs(nodes: DataFrame, child: Column, fanout: int = FANOUT) -> DataFrame:
    """One row per parent: (grp, idx, n, slots, h) with ``slots`` the children in order, null beyond the last.

    ``nodes``: grp, idx, n (nodes of the level in the group) and what ``child`` uses, a struct with a digest ``h``.
    """
    parent, slot = F.floor(F.col("idx") / fanout).cast("long"), F.col("idx") % fanout
    spread = nodes.groupBy("grp", parent.alias("parent"), F.ceil(F.col("n") / fanout).cast("long").alias("n")).agg(
        *[F.max(F.when(slot == k, child)).alias(f"slot{k}") for k in range(fanout)])
    whole = F.sha2(F.concat(*[F.coalesce(F.col(f"slot{k}.h"), F.lit("")) for k in range(fanout)]), 256)
    return spread.select("grp", F.col("parent").alias("idx"), "n", F.array(*[F.col(f"slot{k}") for k in range(fanout)]).alias("slots"),
                         whole.alias("h"))


def _members(level: DataFrame, fanout: int) -> DataFrame:
    """The children of every run: (grp, parent, idx, child, step), ``step`` the siblings before and after the own slot."""
    def at(k: int) -> Column:
        return F.coalesce(F.get("slots", F.lit(k))["h"], F.lit(""))

    def beside(k: int) -> Column:
        return F.struct(F.concat(F.lit(""), *[at(j) for j in range(k)]).alias("before"),
                        F.concat(F.lit(""), *[at(j) for j in range(k + 1, fanout)]).alias("after"))

    each = F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.get("slots", F.lit(k)).alias("child"), beside(k).alias("step"))
                     for k in range(fanout)])
    out = level.withColumn("_m", F.explode(F.filter(each, lambda m: m["child"].isNotNull())))
    return out.select("grp", F.col("idx").alias("parent"), (F.col("idx") * fanout + F.col("_m.k")).alias("idx"),
                      F.col("_m.child").alias("child"), F.col("_m.step").alias("step"),
                      *[c for c in level.columns if c not in ("grp", "idx", "n", "slots", "h")])


def tree(leaves: DataFrame, fanout: int = FANOUT) -> tuple[DataFrame, list[DataFrame]]:
    """(roots, levels): the root (grp, h) of every group, and the runs of every level from the lowest.

    ``leaves``: grp, idx, n, child (a struct with ``h``). A group of one leaf has that leaf as its root and no run.
    """
    alone = leaves.where("n = 1").select("grp", F.col("child.h").alias("h"))
    roots, levels, nodes = [alone], [], leaves.where("n > 1").select("grp", "idx", "n", "child")
    while True:
        level = written(runs(nodes, F.col("child"), fanout), "merkle-level")
        levels.append(level)
        roots.append(level.where("n = 1").select("grp", "h"))
        nodes = level.where("n > 1").select("grp", "idx", "n", F.struct("h").alias("child"))
        if nodes.limit(1).count() == 0:
            break
    out = roots[0]
    for r in roots[1:]:
        out = out.unionByName(r)
    return written(out, "merkle-roots"), levels


def paths(levels: list[DataFrame], above: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(grp, idx, child, path) of every leaf in a run: its siblings level by level, then the path ``above`` (grp, path) of its group's root."""
    known = None  # (grp, idx, path) of the runs of the level below
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        top = level.where("n = 1").join(above.withColumnRenamed("grp", "_g"), F.col("grp").eqNullSafe(F.col("_g"))).drop("_g")
        if known is not None:
            below = level.where("n > 1").join(
                known.withColumnsRenamed({"grp": "_g", "idx": "_i"}), F.col("grp").eqNullSafe(F.col("_g")) & (F.col("idx") == F.col("_i"))
            ).drop("_g", "_i")
            top = top.unionByName(below)
        members = _members(top, fanout).select("grp", "idx", "child", F.concat(F.array("step"), "path").alias("path"))
        known = members if depth == 0 else written(members.drop("child"), "merkle-paths")
    return known


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, start, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", leaf_cols: tuple[str, ...] = FIELDS,
             tampered: dict[str, Column] | None = None, changed: Column | None = None, fanout: int = FANOUT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per input row.

    ``leaf_cols`` are hashed in that order. ``tampered`` replaces columns by other
    values in rows where ``changed`` holds; such a row is folded from its changed
    leaf along the original siblings, and is verified only if the root comes out.
    Edges: a null value is ``-``, an empty one ``0:``; a null group is a group of
    its own, first in order, apart from an empty one; rows that share an id are
    ordered by their leaves, equal rows have a position and a proof each; a null
    id comes first; a group of one row has its leaf as its root, and a lone group's root
    is the root; an empty table gives an empty result; other columns are ignored.
    """
    cols = [F.col(f"`{c}`") for c in leaf_cols]
    other = [(tampered or {}).get(c, F.col(f"`{c}`")) for c in leaf_cols]
    hit = F.coalesce(changed, F.lit(False)) if changed is not None else F.lit(False)
    rows = written(docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{group_col}`").cast("string").alias("grp"), leaf(*cols).alias("leaf"),
        F.when(hit, leaf(*other)).alias("seen")), "merkle-leaves")
    child = F.struct(F.col("leaf").alias("h"), "doc_id", "seen")
    leaves = written(numbered(rows, "grp", "doc_id", "leaf").select("grp", "idx", "n", child.alias("child")), "merkle-numbered")
    subroots, levels = tree(leaves, fanout)
    # the groups' roots are the leaves of one more tree; its only group is the empty text
    groups = numbered(written(subroots.select(F.lit("").alias("all"), F.col("grp").alias("name"), "h"), "merkle-groups"), "all", "name")
    tops = written(groups.select(F.col("all").alias("grp"), "idx", "n", F.struct("h", "name").alias("child")), "merkle-tops")
    root, upper = tree(tops, fanout)
    begin = root.select("grp", F.array().cast(_PATH).alias("path"))
    over = paths(upper, begin, fanout).select("child", "path").unionByName(
        tops.where("n = 1").select("child", F.array().cast(_PATH).alias("path")))
    above = written(over.select(F.col("child.name").alias("grp"), "path"), "merkle-above")
    lone = leaves.where("n = 1").select("grp", "idx", "child").join(
        above.withColumnRenamed("grp", "_g"), F.col("grp").eqNullSafe(F.col("_g"))).drop("_g")
    proven = paths(levels, above, fanout).unionByName(lone)
    named = proven.select(
        "grp", F.col("child.doc_id").alias("doc_id"), F.col("child.h").alias("leaf"),
        F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), ""), 256).alias("proof_sha256"),
        fold(F.coalesce("child.seen", "child.h"), F.col("path")).alias("folded_root"))
    # one row per group, joined by the planner's choice; the root is one row
    full = named.join(subroots.select(F.col("grp").alias("_g"), F.col("h").alias("subroot")), F.col("grp").eqNullSafe(F.col("_g"))).join(
        F.broadcast(root.select(F.col("h").alias("root"))))
    return full.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def tampering(doc_id: Column, text: Column) -> tuple[dict[str, Column], Column]:
    """The check's tampering: lower-cased texts where 3 divides the crc32 of the id in decimal (a null id is left alone)."""
    return {"text": lower_az(text)}, F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered, changed = tampering(F.col("doc_id"), F.col("text"))
    return manifest(documents(spark, sf_dir, *FIELDS), tampered=tampered, changed=changed)


def _sql() -> str:
    def enc(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"

    def tree_sql(name: str, leaves: str) -> str:
        """All nodes of the trees over ``leaves`` (grp, idx, h): (grp, level, idx, h)."""
        return f"""
{name} AS (
  WITH RECURSIVE t(grp, level, idx, h, n) AS (
    SELECT grp, 0, idx, h, count(*) OVER (PARTITION BY grp) FROM {leaves}
    UNION ALL
    SELECT grp, level, parent, h, count(*) OVER (PARTITION BY grp)
    FROM (SELECT grp, level + 1 AS level, idx // {FANOUT} AS parent, sha256(string_agg(h, '' ORDER BY idx)) AS h
          FROM t WHERE n > 1 GROUP BY ALL))
  SELECT grp, level, idx, h, n FROM t),
{name}_steps AS (  -- of every node below a root: the siblings before and after it
  SELECT a.grp, a.level, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx < a.idx), '') AS before,
         coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (WHERE b.idx > a.idx), '') AS after
  FROM {name} a JOIN {name} b ON a.grp IS NOT DISTINCT FROM b.grp AND a.level = b.level AND a.idx // {FANOUT} = b.idx // {FANOUT}
  WHERE a.n > 1 GROUP BY ALL)"""

    # crc32 of the decimal id, bit by bit
    crc = ("xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT), lambda a, x: "
           "list_reduce([xor(a, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c // 2, 3988292384 * (c % 2))), 4294967295::BIGINT), 4294967295)")
    leaf_sql = " || ".join(enc(c) for c in FIELDS)
    other = " || ".join(enc(c) for c in FIELDS[:-1]) + f" || {enc(f'''translate(text, '{_UPPER}', '{_LOWER}')''')}"
    return f"""
WITH l AS MATERIALIZED (
  SELECT lang AS grp, doc_id, sha256({leaf_sql}) AS h,
         CASE WHEN coalesce({crc} % 3 = 0, false) THEN sha256({other}) END AS seen,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, sha256({leaf_sql})) - 1 AS idx FROM documents),
{tree_sql("low", "l")},
subroots AS MATERIALIZED (SELECT grp, h FROM low WHERE n = 1),
tops AS MATERIALIZED (SELECT '' AS grp, grp AS name, h, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS idx FROM subroots),
{tree_sql("high", "tops")},
root AS (SELECT h FROM high WHERE n = 1),
chain AS (  -- every row's steps, numbered from its leaf to the root
  SELECT l.grp, l.idx, s.level, s.before, s.after FROM l JOIN low_steps s
    ON s.grp IS NOT DISTINCT FROM l.grp AND s.idx = l.idx // ({FANOUT} ** s.level)::BIGINT
  UNION ALL
  SELECT l.grp, l.idx, 1000 + s.level, s.before, s.after FROM l JOIN tops ON tops.name IS NOT DISTINCT FROM l.grp JOIN high_steps s
    ON s.idx = tops.idx // ({FANOUT} ** s.level)::BIGINT),
path AS (SELECT grp, idx, list({{'before': before, 'after': after}} ORDER BY level) AS p,
                string_agg(before || after, '' ORDER BY level) AS sibs FROM chain GROUP BY ALL),
folded AS (
  SELECT l.doc_id, l.h AS leaf, l.grp, coalesce(sibs, '') AS sibs,
         list_reduce(coalesce(p, []), lambda a, s: {{'before': sha256(s.before || a.before || s.after), 'after': ''}},
                     {{'before': coalesce(seen, l.h), 'after': ''}}).before AS folded_root
  FROM l LEFT JOIN path ON path.grp IS NOT DISTINCT FROM l.grp AND path.idx = l.idx)
SELECT doc_id, leaf, subroots.h AS subroot, root.h AS root, sha256(sibs) AS proof_sha256, folded_root, folded_root = root.h AS verified
FROM folded JOIN subroots ON subroots.grp IS NOT DISTINCT FROM folded.grp, root
"""


SQL = _sql()
