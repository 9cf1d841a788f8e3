"""Quality rules with risk-controlled cutoffs (native DataFrame operators only).

Every whole text is measured in the scan by built-in expressions, no shuffle.
Each rule rejects where a measure lies above a cutoff. Cutoffs are not fixed:
for every stratum, rule and grid value the labelled rows give how many good
documents the cutoff would wrongly reject, and the exact binomial tail
``P(Bin(n, share) <= k)`` is the p-value of "this cutoff's false-rejection rate
exceeds its share", an equal part of ``risk`` for every rule. The lowest cutoff whose p-value passes after a Bonferroni
correction over all strata, rules and grid values is selected; a stratum with
too few labelled rows gets no cutoff for that rule and rejects nothing by it.
With probability ``1 - delta`` every stratum's false rejections stay below
``risk``, all rules together. Only (stratum, rule, cutoff) counts leave the scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.bitmap import bitmap, split
from marquee.llm.scratch import documents, written
from marquee.sources.tables import table

#: Rule → grid of candidate cutoffs (a document is rejected where the measure is above the cutoff).
RULES = {
    "symbols_per_char": [0.01, 0.02, 0.03, 0.04, 0.06, 0.08, 0.1, 0.15, 0.2, 0.3],
    "repeat_share": [0.04, 0.06, 0.08, 0.1, 0.12, 0.15, 0.2, 0.25, 0.3, 0.4],
    "dup_lines_per_word": [0.002, 0.004, 0.006, 0.01, 0.015, 0.02, 0.03, 0.04, 0.05, 0.08],
}
#: False rejections allowed among the good documents of a stratum, by all rules together.
RISK = 0.03
#: Chance that any selected cutoff breaks its bound.
DELTA = 0.05
MIN_WORDS = 50
#: Rows of the cutoffs table up to which it is broadcast; beyond, it is joined by shuffle.
BROADCAST_STRATA = 10_000
#: Low bits of a sort key that hold a word position; a text of more windows than that is sorted by pairs.
_POSITION_BITS = 24


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (a lambda variable is never inlined)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def repeat_words(words: Column, position_bits: int = _POSITION_BITS) -> Column:
    """Words lying in a 3-word window that occurs twice or more in the text, the first included.

    Windows are hashed to 64 bits; hash and position share a sort key, so equal
    windows become neighbours in one primitive sort, and neighbours are compared
    by their whole hashes. A text of more than ``2**position_bits`` windows sorts
    (hash, position) pairs instead. n log n in the text's length.
    """
    mask = (1 << position_bits) - 1

    def keys(h: Column) -> Column:
        return F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))))

    def covered(h: Column) -> Column:
        def same(s: Column, a: Column, b: Column) -> Column:
            at = lambda j: F.get(h, F.get(s, j).bitwiseAND(F.lit(mask)).cast("int"))
            return F.coalesce(at(a) == at(b), F.lit(False))

        def positions(s: Column) -> Column:
            hit = F.filter(s, lambda x, j: same(s, j, j - 1) | same(s, j, j + 1))
            return F.transform(hit, lambda x: x.bitwiseAND(F.lit(mask)))

        spread = let(keys(h), lambda s: F.flatten(F.transform(positions(s), lambda p: F.array(p, p + 1, p + 2))))
        return F.size(F.array_distinct(spread)).cast("long")

    def covered_by_pairs(h: Column) -> Column:
        def spread(s: Column) -> Column:
            same = lambda a, b: F.coalesce(F.get(s, a)["h"] == F.get(s, b)["h"], F.lit(False))
            hit = F.filter(s, lambda x, j: same(j, j - 1) | same(j, j + 1))
            return F.flatten(F.transform(hit, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))

        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("i"))))
        return F.size(F.array_distinct(let(pairs, spread))).cast("long")

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                           lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def count(w: Column) -> Column:
        found = let(windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).when(
            F.size(h) <= F.lit(mask), covered(h)).otherwise(covered_by_pairs(h)))
        return F.when(F.size(w) >= 3, found).otherwise(F.lit(0).cast("long"))

    return count(words)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang",
             carry: Column | None = None) -> DataFrame:
    """One row per document: the base measures, ``base_failed`` and the rules' measures, all in the scan.

    ``carry`` rides along as a column of that name (the whole row, for a filter).
    """
    also = [carry.alias("carry")] if carry is not None else []
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    stratum = F.coalesce(F.col(f"`{stratum_col}`").cast("string"), F.lit("")) if stratum_col else F.lit("")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def base(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        repeat_words(w).alias("n_repeat_words"))

    d = docs.select(
        *also, F.col(f"`{id_col}`").alias("doc_id"),
        stratum.alias("stratum"),
        let(word_array(text), base).alias("m"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]++", ""))).cast("long").alias("n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
    )
    n, chars, rep = F.col("m.n_words"), F.col("m.word_chars"), F.col("m.n_repeat_words")
    return d.select(
        *(["carry"] if also else []), "doc_id", "stratum", n.alias("n_words"), chars.alias("word_chars"), "n_symbols", "n_dup_lines",
        rep.alias("n_repeat_words"), ((n < MIN_WORDS) | (100 * rep > 50 * n)).alias("base_failed"),
        F.coalesce(F.try_divide("n_symbols", chars), F.lit(0.0)).alias("symbols_per_char"),
        F.coalesce(F.try_divide(rep, n), F.lit(0.0)).alias("repeat_share"),
        F.coalesce(F.try_divide("n_dup_lines", n), F.lit(0.0)).alias("dup_lines_per_word"),
    )


def binomial_tail(k: Column, n: Column, risk: float) -> Column:
    """Exact ``P(Bin(n, risk) <= k)``, summed in log space term by term; 1 where k is above the mean (never significant)."""
    import math

    odds = math.log(risk) - math.log1p(-risk)

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1).cast("double")) - F.log(i.cast("double")) + F.lit(odds)
        return F.struct(term.alias("term"), (acc["sum"] + F.exp(term)).alias("sum"))

    start = n.cast("double") * F.lit(math.log1p(-risk))
    zero = F.struct(start.alias("term"), F.exp(start).alias("sum"))
    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.expr("array()").cast("array<bigint>"))
    tail = F.aggregate(terms, zero, step, lambda acc: acc["sum"])
    return F.when(k > n * F.lit(risk), F.lit(1.0)).otherwise(F.least(tail, F.lit(1.0)))


def cutoffs(labelled: DataFrame, rules: dict[str, list[float]] = RULES, risk: float = RISK, delta: float = DELTA,
            good_col: str = "good") -> DataFrame:
    """(stratum, rule, cutoff) selected from labelled measures.

    ``labelled`` has ``stratum``, a column per rule and ``good_col`` (1 for a
    good document; rows with 0 or null are no evidence about false rejections).
    Every rule takes an equal share of ``risk``, so the rules together reject at
    most ``risk`` of a stratum's good documents. One aggregate over the labelled
    rows, partial in the map tasks; its result has strata x rules x grid rows.
    """
    risk = risk / len(rules)
    good = labelled.where(F.col(good_col) == 1)
    grid = [(r, c) for r in rules for c in rules[r]]
    counts = good.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.count_if(F.col(r) > c).alias("k"))
                  for r, c in grid]).alias("tried"),
    )
    tests = counts.agg(F.count(F.lit(1)).alias("strata"))
    tried = counts.select("stratum", "n", F.explode("tried").alias("t")).select("stratum", "n", "t.rule", "t.cutoff", "t.k")
    passed = tried.crossJoin(F.broadcast(tests)).where(  # one row: the number of strata
        binomial_tail(F.col("k"), F.col("n"), risk) <= F.lit(delta) / (F.col("strata") * len(grid)))
    return passed.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def quality_rules(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang",
    label_id: str = "doc_id", label_col: str = "quality", risk: float = RISK, delta: float = DELTA,
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept: one row per input row.

    Defined results at the edges: a null or empty text has no words and fails
    the base rule; a null stratum is a stratum of its own; with no labelled rows
    (or too few) no cutoff is selected and only the base rule rejects; labels
    given twice for a document count once (the lowest); an empty table gives an
    empty result. Texts are read and measured once; the narrow measures are
    written to the shared folder, and labels and cutoffs join those.
    """
    m = written(measures(docs, id_col, text_col, stratum_col), "quality-measures")
    return verdicts(m, selected_cutoffs(m, labels, label_id, label_col, risk, delta)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def selected_cutoffs(measured: DataFrame, labels: DataFrame, label_id: str = "doc_id", label_col: str = "quality",
                     risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, cut: map of rule to cutoff) from the measured rows that have a label; only narrow rows are joined."""
    lab = labels.select(F.col(f"`{label_id}`").alias("doc_id"), F.col(f"`{label_col}`").alias("good"))
    lab = lab.where("doc_id is not null").groupBy("doc_id").agg(F.min("good").alias("good"))
    chosen = cutoffs(measured.join(lab, "doc_id"), risk=risk, delta=delta).groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cut"))
    return written(chosen, "quality-cutoffs")


def verdicts(measured: DataFrame, chosen: DataFrame) -> DataFrame:
    """``measured`` plus ``kept``. The cutoffs are broadcast only up to ``BROADCAST_STRATA`` rows, counted first."""
    above = [F.coalesce(F.col(r) > F.col("cut")[r], F.lit(False)) for r in RULES]
    rejected = above[0]
    for a in above[1:]:
        rejected = rejected | a
    small = chosen.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA
    joined = measured.join(F.broadcast(chosen) if small else chosen, "stratum", "left")
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejected).drop("cut")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang") -> DataFrame:
    """``docs`` without the rejected rows, same columns. Texts are never shuffled: only the cutoffs are joined, by stratum.

    The cutoffs need the measures of labelled documents alone: a bitmap of their
    ids lets only those be measured before; then every row is measured once.
    """
    labelled = written(labels.select("doc_id").where("doc_id is not null").distinct().select(F.xxhash64(F.col("doc_id").cast(
        docs.schema[id_col].dataType)).alias("h")), "labelled-ids")
    possible, _ = split(docs, F.xxhash64(F.col(f"`{id_col}`")), *bitmap(labelled))
    m = written(measures(possible, id_col, text_col, stratum_col), "quality-measures")
    chosen = selected_cutoffs(m, labels)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    judged = verdicts(measures(docs, id_col, text_col, stratum_col, carry=row), chosen)
    return judged.where("kept").select("carry.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir, "doc_id", "text", "lang"), table(spark, sf_dir, "labels"))


def _sql() -> str:
    import math

    grid = ", ".join(f"('{r}', {c}::DOUBLE)" for r in RULES for c in RULES[r])
    share = RISK / len(RULES)
    n_grid = sum(map(len, RULES.values()))
    pick = "CASE g.rule " + " ".join(f"WHEN '{r}' THEN {r}" for r in RULES) + " END"
    above = " OR ".join(f"coalesce({r} > max(cutoff) FILTER (WHERE rule = '{r}'), false)" for r in RULES)
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
tri AS (
  SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
dup AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM dup, (VALUES (0), (1), (2)) x(k) GROUP BY doc_id),
base AS (
  SELECT d.doc_id, stratum, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (SELECT count(*) - count(DISTINCT l) FROM (SELECT unnest(string_split(text, chr(10))) AS l)
          WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]'))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep ON rep.doc_id = d.doc_id),
m AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN word_chars = 0 THEN 0 ELSE n_symbols / word_chars END AS symbols_per_char,
         CASE WHEN n_words = 0 THEN 0 ELSE n_repeat_words / n_words END AS repeat_share,
         CASE WHEN n_words = 0 THEN 0 ELSE n_dup_lines / n_words END AS dup_lines_per_word FROM base),
good AS (SELECT m.* FROM m JOIN (SELECT doc_id, min(quality) AS q FROM labels GROUP BY doc_id) l USING (doc_id) WHERE q = 1),
counts AS (
  SELECT stratum, g.rule, g.cutoff, count(*) AS n, count(*) FILTER (WHERE {pick} > g.cutoff) AS k,
         (SELECT count(DISTINCT stratum) FROM good) AS strata
  FROM good, (VALUES {grid}) g(rule, cutoff) GROUP BY ALL),
tested AS (
  SELECT *, CASE WHEN k > n * {share} THEN 1.0 ELSE (SELECT least(1.0, sum(exp(
      lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * {math.log(share)!r} + (n - i) * {math.log1p(-share)!r})))
      FROM (SELECT unnest(range(0, k + 1)) AS i)) END AS p FROM counts),
chosen AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM tested WHERE p <= {DELTA} / (strata * {n_grid}) GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({above}) AS kept
FROM m LEFT JOIN chosen USING (stratum)
GROUP BY doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, {', '.join(RULES)}
"""


SQL = _sql()
