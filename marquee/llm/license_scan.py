"""License scan (native DataFrame operators only).

Templates are retrieved for overlapping windows of a text by MinHash minima, then
verified exactly. A window is reduced to its 5-word shingles (a shorter
notice is one shingle of all its words) that occur in any template (a fixed, small
vocabulary; other shingles can match nothing). A piece of a template is retrieved
for every window that holds one of its selected shingles: those lowest under a
hash, one more than a window may lack at a containment of ``CONTAINMENT``. So each
window that holds a piece to that share retrieves it, whatever else stands there. Windows overlap by half, and templates
longer than half a window are cut into pieces, so every template lies whole in
some window. Verification counts the shingles of the template that the window
holds; nothing is estimated in the result.

Shingle hashes are made and filtered inside the scan; only the few shingles that
a template also has leave it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.license_texts import NOTICES
from marquee.llm.quality_rules import let, word_array
from marquee.llm.scratch import documents, written

#: Short public license notices (fixed values, by name).
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "mit": "Released under the MIT License.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "all-rights-reserved": "All rights reserved. No part of this work may be reproduced without permission.",
}
#: All that ``op3_license_scan`` looks for.
KNOWN = TEMPLATES | NOTICES
WINDOW = 64
SHINGLE = 5
#: Share of a template's shingles that a window must hold.
CONTAINMENT = 0.8


def _pieces(templates: dict[str, str]) -> list[tuple[str, int, list[str]]]:
    """(template, piece, words): templates of more than half a window are cut into pieces of half a window; the last ends with the text."""
    out = []
    step = WINDOW // 2
    for name in sorted(templates):
        w = re.findall(r"[^\x20\x09-\x0D]+", templates[name].lower())
        starts = [*range(0, len(w) - step, step), max(0, len(w) - step)]
        out += [(name, k, w[a : a + step]) for k, a in enumerate(starts)]
    return out


def _template_shingles(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(template, piece, width, size, h): the distinct shingle hashes of every piece. As small as the templates given.

    A notice of fewer than ``SHINGLE`` words is one shingle of all its words, as wide as it is long.
    """
    rows = [(n, k, min(len(w), SHINGLE), w) for n, k, w in _pieces(templates) if w]
    df = spark.createDataFrame(rows, "template string, piece int, width int, words array<string>")
    of_width = lambda n: F.when(F.col("width") == n, let(_word_hashes(F.col("words")), lambda h: _shingle_hashes(h, n)))
    by_width = F.coalesce(*[of_width(n) for n in range(1, SHINGLE + 1)])
    hashed = df.select("template", "piece", "width", F.array_distinct(by_width).alias("hs"))
    return hashed.select("template", "piece", "width", F.size("hs").alias("size"), F.explode("hs").alias("h"))


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingle_hashes(h: Column, width: int = SHINGLE) -> Column:
    return F.when(F.size(h) >= width, F.transform(
        F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)])))


def _hits(h: Column, width: int, vocabulary: list[int]) -> Column:
    """(at, width, h) of every shingle of ``width`` words that is in the vocabulary; empty for a text too short."""
    known = let(_shingle_hashes(h, width), lambda s: F.filter(
        F.transform(s, lambda x, i: F.struct(i.alias("at"), F.lit(width).alias("width"), x.alias("h"))), lambda x: x["h"].isin(vocabulary)))
    return F.coalesce(known, F.array().cast("array<struct<at:int,width:int,h:bigint>>"))


def license_scan(docs: DataFrame, templates: dict[str, str] = KNOWN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, template, containment, n_windows: one row per document and template found.

    ``containment`` is the largest share of one piece's shingles in one window;
    a template of several pieces is found by any of them. Words are lower-cased.
    Edges: null and empty texts match nothing; a template of fewer than five
    words is found where all its words follow each other; rows that repeat an id
    count as one document; an empty table or no template (or one without words)
    gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    known = _template_shingles(spark, templates)
    vocabulary: dict[int, list[int]] = {}  # by width; bounded by the templates given
    for r in known.select("width", "h").distinct().collect():
        vocabulary.setdefault(r["width"], []).append(r["h"])
    if not vocabulary:
        vocabulary[SHINGLE] = []
    text = F.lower(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    # every shingle of every whole text, filtered in the scan; a hit keeps its word position
    hits = let(_word_hashes(word_array(text)), lambda h: F.concat(*[_hits(h, n, vocabulary[n]) for n in sorted(vocabulary)]))
    found = written(docs.select(F.col(f"`{id_col}`").alias("doc_id"), hits.alias("hits")).where(F.size("hits") > 0).select(
        "doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.at", "hit.width", "hit.h"), "license-shingles")
    half = WINDOW // 2
    last = F.floor(F.col("at") / half)
    windows = found.select("doc_id", F.explode(F.array(last - 1, last)).alias("window"), "at", "width", "h").where(
        (F.col("window") >= 0) & (F.col("at") + F.col("width") <= F.col("window") * half + WINDOW))
    sets = windows.groupBy("doc_id", "window").agg(F.collect_set("h").alias("hs"))  # at most WINDOW values
    pieces = known.groupBy("template", "piece", "size").agg(F.collect_set("h").alias("hs"))
    near = windows.select("doc_id", "window", "h").join(F.broadcast(_minima(pieces)), "h").select(
        "doc_id", "window", "template", "piece", "size").distinct()
    held = near.join(sets, (near["doc_id"].eqNullSafe(sets["doc_id"])) & (near["window"] == sets["window"])).join(
        pieces.withColumnRenamed("hs", "ts"), ["template", "piece", "size"]).select(
        near["doc_id"], near["window"], "template", "size", F.size(F.array_intersect("hs", "ts")).alias("shared"))
    return held.where(F.col("shared") >= F.lit(CONTAINMENT) * F.col("size")).groupBy("doc_id", "template").agg(
        F.max(F.col("shared") / F.col("size")).alias("containment"), F.count_distinct("window").alias("n_windows"))


def _minima(pieces: DataFrame) -> DataFrame:
    """(template, piece, size, h): the selected shingles of every piece; as small as the templates."""
    ordered = F.array_sort(F.transform("hs", lambda h: F.struct(F.xxhash64(h).alias("order"), h.alias("h"))))
    # a containing window lacks at most size - ceil(share * size); rounding can only select more
    selected = F.col("size") - F.ceil(F.lit(CONTAINMENT) * F.col("size") - F.lit(1e-9)) + 1
    return pieces.select("template", "piece", "size", F.explode(F.slice(ordered, F.lit(1), selected.cast("int"))).alias("low")).select(
        "template", "piece", "size", F.col("low.h").alias("h"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir, "doc_id", "text"))


def _sql(templates: dict[str, str] = KNOWN) -> str:
    """The whole scan: every notice at its own width, pieces of long ones, half-overlapping windows, no retrieval step."""
    rows = ", ".join(f"('{n}', {k}, ['" + "', '".join(x.replace("'", "''") for x in w) + "'])" for n, k, w in _pieces(templates) if w)
    half = WINDOW // 2
    return f"""
WITH p AS (SELECT name, piece, w, least(len(w), {SHINGLE}) AS width FROM (VALUES {rows}) v(name, piece, w)),
t AS (
  SELECT DISTINCT name, piece, width, array_to_string(w[i:i + width - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - width + 2)) AS i FROM p)),
size AS (SELECT name, piece, count(*) AS size FROM t GROUP BY ALL),
w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, width, i - 1 AS pos, array_to_string(w[i:i + width - 1], ' ') AS s
  FROM (SELECT doc_id, width, w, unnest(range(1, len(w) - width + 2)) AS i
        FROM w, (SELECT DISTINCT width FROM t) WHERE len(w) >= width)),
hit AS (
  SELECT doc_id, (pos // {half}) - k AS win, pos, width, s FROM s, (VALUES (0), (1)) x(k) WHERE s IN (SELECT s FROM t)),
held AS (
  SELECT doc_id, win, name, piece, count(DISTINCT hit.s) AS shared FROM hit JOIN t ON hit.s = t.s AND hit.width = t.width
  WHERE win >= 0 AND pos + hit.width <= win * {half} + {WINDOW} GROUP BY ALL)
SELECT doc_id, name AS template, max(shared / size) AS containment, count(DISTINCT win) AS n_windows
FROM held JOIN size USING (name, piece) WHERE shared >= {CONTAINMENT} * size GROUP BY ALL
"""


SQL = _sql()
