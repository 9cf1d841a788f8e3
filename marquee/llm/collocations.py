"""Phrase collocations per language by dynamic itemset counting.

Texts are split at punctuation and line ends into pieces, pieces into words. All
contiguous phrases of one to four words that occur ``least`` times or more are
counted, exactly, in cyclic scans over shards of the table:

1. Shards. Texts are written once, dealt to ``SHARDS`` folders; one step scans
   one folder, and the scans go round.
2. Interleaved lengths. Words are counted from the first step. A longer phrase
   becomes active in the step after both its subphrases (without the last and
   without the first word) have reached the threshold, whatever step of their own
   cycle they are in, and is then counted for the next ``SHARDS`` steps: one full
   cycle from its own start. So several lengths are counted in every scan.
3. What has reached the threshold is a bitmap of phrase hashes, its size bound
   by a parameter. A task holds the bitmaps of this step and of one
   cycle before: a phrase is counted if it is active by the first and not by the
   second. Hash collisions can only activate phrases that stay below the
   threshold; counts are kept by the phrases themselves.
4. Counters. A step's counts are summed by task and joined by one aggregate with
   the counters still in their cycle. Finished counters below the threshold go.
   The scans end when a whole cycle has activated nothing new.

Scores, cuts and containment are joins and aggregates over the frequent phrases
alone, in exact decimals. A language is no key of any unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.llm import textnum as tn
from marquee.llm.scratch import documents, written

LEAST = 30
LONGEST = 4
TOP = 2_000
#: A phrase is part of a longer one if that one has this share of its occurrences.
CONTAINED = (80, 100)
SHARDS = 2
#: Text counted at once in a task; longer texts are cut at white space, with the phrases over the cut counted once.
CHUNK_BYTES = 2 << 20
#: Phrases written out at once.
KEYS = 1 << 16
#: Bits of the bitmap of phrases that reached the threshold: about one per ``BYTES_PER_BIT`` bytes of text, within these powers of two.
BYTES_PER_BIT = 32
LEAST_BITS, MOST_BITS = 20, 28
#: Ranking of a language is done in so many groups first.
RANK_GROUPS = 64

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_SOLID = ~_ENDS
_SOLID[[32, 9]] = False
_FACTORS = tn.powers(0xD6E8FEB86659FD93 | 1, LONGEST + 1)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row, piece) of every word; words of one piece share its number."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 4
    solid = _SOLID[data]
    first = np.zeros(n + 1, bool)  # a text begins here
    first[offsets] = True
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | first[1:n]
    ends[:-1] &= ~solid[1:] | first[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row, np.cumsum(_ENDS[data])[start] + row


def _gram(word: np.ndarray, at: np.ndarray, k: int, lang: np.ndarray) -> np.ndarray:
    """Hash of the ``k`` words from every position ``at`` and their language."""
    h = lang + np.uint64(k)
    for j in range(k):
        h = h + word[at + j] * _FACTORS[j + 1]
    return tn.mix(h)


def _holds(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h & np.uint64(len(bits) * 8 - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _text_hash(texts: list[bytes]) -> np.ndarray:
    """Hash of every text's bytes."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
    return tn.range_hash(tn.prefix(data), offsets[:-1], offsets[1:])


class _Text:
    """The lower-cased words of a chunk and the names of its languages, from which phrases are written out."""

    def __init__(self, lower: np.ndarray, start: np.ndarray, end: np.ndarray, names: list[bytes]):
        heads = [n + b"\t" for n in names]
        self.buffer = np.concatenate([lower, np.frombuffer(b" ".join([b"", *heads, b""]), np.uint8)])
        self.head_size = np.array([len(h) for h in heads])
        self.head = len(lower) + 1 + np.concatenate([[0], np.cumsum(self.head_size + 1)[:-1]])
        self.start, self.size = start, end - start

    def keys(self, at: np.ndarray, k: int, lang: np.ndarray) -> pa.Array:
        """``language, tab, words joined by one space`` of the ``k`` words from every position ``at``."""
        place = at[:, None] + np.arange(k)
        begin = np.concatenate([self.head[lang][:, None], self.start[place]], 1).ravel()
        size = np.concatenate([self.head_size[lang][:, None], self.size[place] + 1], 1)
        size[:, -1] -= 1
        size = size.ravel()
        last = np.cumsum(size)
        out = self.buffer[np.repeat(begin - last + size, size) + np.arange(last[-1] if len(last) else 0)]
        ends = last.reshape(-1, k + 1)
        out[ends[:, 1:-1].ravel() - 1] = 32
        offsets = np.concatenate([[0], ends[:, -1]]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(out))


def _count(data, offsets, lang, names, now, old, words_too, own: int | None = None) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(keys, counts) of a chunk: words if ``words_too``, and longer phrases active by ``now`` and not by ``old``.

    ``own``: only phrases that start before this byte are counted.
    """
    lower = tn._LOWER[data]
    start, end, row, piece = _words(lower, offsets)
    if not len(start):
        return
    word = tn.range_hash(tn.prefix(lower), start, end)
    code = lang[row]
    salt = _text_hash(names)[code]
    mine = start < own if own is not None else np.ones(len(start), bool)
    text = _Text(lower, start, end, names)

    def summed(h: np.ndarray, at: np.ndarray, k: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
        code_of, uniq = pd.factorize(h)
        first = np.zeros(len(uniq), np.int64)
        first[code_of[::-1]] = at[::-1]
        times = np.bincount(code_of, minlength=len(uniq))
        for lo in range(0, len(first), KEYS):
            some = first[lo : lo + KEYS]
            yield text.keys(some, k, code[some]), times[lo : lo + KEYS]

    every = np.arange(len(start))
    h = _gram(word, every, 1, salt)
    if words_too:
        yield from summed(h[mine], every[mine], 1)
        total = np.bincount(code[mine], minlength=len(names))
        held = np.flatnonzero(total)
        yield pa.array([names[c].decode() + "\t" for c in held], pa.large_string()), total[held]  # all words of a language
    at, together = every, np.append(piece[1:] == piece[:-1], False)
    reached, before = _holds(now, h), _holds(old, h) if old is not None else None
    for k in range(2, LONGEST + 1):
        # both subphrases: those that start here and at the next word
        flag = np.zeros(len(start) + 1, bool)
        flag[at[reached]] = True
        pair = at[flag[at] & flag[at + 1] & together[at]]
        if before is not None:
            flag_old = np.zeros(len(start) + 1, bool)
            flag_old[at[before]] = True
            done = flag_old[pair] & flag_old[pair + 1]
        else:
            done = np.zeros(len(pair), bool)
        h = _gram(word, pair, k, salt[pair])
        count = ~done & mine[pair]
        yield from summed(h[count], pair[count], k)
        at, reached = pair, _holds(now, h)
        before = done & _holds(old, h) if old is not None else None


def _cut(data: np.ndarray, most: int) -> Iterator[tuple[int, int, int]]:
    """(begin, own end, end) of parts of one long text; a part reaches ``LONGEST - 1`` words, or to the piece's end, beyond its own end."""
    n, begin = len(data), 0
    while begin < n:
        own = min(n, begin + most)
        while own < n and _SOLID[data[own]] and _SOLID[data[own - 1]]:  # not inside a word
            gap = np.flatnonzero(~_SOLID[data[own : own + 4096]])
            own = own + int(gap[0]) if len(gap) else min(n, own + 4096)
        reach, end = 4096, n
        while own + reach < n:
            tail = data[own : own + reach]
            stop = np.flatnonzero(_ENDS[tail])
            if len(stop):
                end = own + int(stop[0])
                break
            finish = np.flatnonzero(_SOLID[tail][:-1] & ~_SOLID[tail][1:])
            if len(finish) >= LONGEST - 1:
                end = own + int(finish[LONGEST - 2]) + 1
                break
            reach *= 2
        yield begin, own, end
        begin = own


def _scan(now, old, words_too: bool, chunk: int):
    """One step over a shard: (key, cnt) of every chunk. ``now`` and ``old`` are broadcasts of bitmaps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = now.value, old.value if old is not None else None
        for batch in batches:
            coded = batch.column("lang").dictionary_encode()
            names = [x.as_py().encode() for x in coded.dictionary]
            code = coded.indices.to_numpy(zero_copy_only=False)
            data, offsets = tn.texts_of(batch.column("text"))
            for lo, hi in tn.chunks(offsets, chunk):
                part, inner = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                if hi - lo == 1 and len(part) > 2 * chunk:
                    todo = ((part[x:z], np.array([0, z - x]), y - x) for x, y, z in _cut(part, chunk))
                else:
                    todo = iter([(part, inner, None)])
                for text, bounds, own in todo:
                    for keys, counts in _count(text, bounds, code[lo:hi], names, a, b, words_too, own):
                        if len(keys):
                            yield pa.RecordBatch.from_arrays([keys.cast(pa.string()), pa.array(counts, pa.int64())], names=["key", "cnt"])
    return run


def _positions(n_bits: int):
    """Bit positions of phrases given by their keys, as 64-bit words of the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [k.encode().rpartition(b"\t") for k in batch.column("key").to_pylist()]
            data = np.frombuffer(b"\n".join(p for _, _, p in keys), np.uint8)
            ends = np.cumsum([len(p) + 1 for _, _, p in keys])
            start, end, row, _ = _words(data, np.concatenate([[0], ends[:-1], [len(data)]]).astype(np.int64))
            word = tn.range_hash(tn.prefix(data), start, end)
            size = np.bincount(row, minlength=len(keys))
            first = np.cumsum(size) - size
            salt = _text_hash([n for n, _, _ in keys])
            out = np.zeros(len(keys), np.uint64)
            for k in range(1, LONGEST + 1):
                of = np.flatnonzero(size == k)
                out[of] = _gram(word, first[of], k, salt[of])
            at = (out[size > 0] & np.uint64(n_bits - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))],
                                             names=["word", "bit"])
    return run


def _marked(reached: DataFrame, bits: np.ndarray) -> np.ndarray:
    """``bits`` with the phrases of ``reached`` set; at most one number per 64 bits comes to the driver."""
    words = reached.select("key").mapInArrow(_positions(len(bits) * 8), "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bit"))
    got = words.toArrow()
    out = bits.view(np.int64).copy()
    out[got.column("word").to_numpy()] |= got.column("bit").to_numpy()
    return out.view(np.uint8)


def phrase_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, shards: int = SHARDS,
                  chunk: int = CHUNK_BYTES, bits: int | None = None) -> DataFrame:
    """(lang, phrase, a): exact counts of all phrases of up to ``LONGEST`` words that occur ``least`` times or more in their language.

    The empty phrase holds the number of all words of a language.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    dealt = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), text.alias("text"))
    dealt = written(dealt.select("lang", "text", F.octet_length("text").alias("size"),
                                 F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard")),
                    "phrase-shards", "shard")
    if bits is None:
        size = dealt.agg(F.sum("size").alias("n")).first()["n"] or 0
        bits = min(MOST_BITS, max(LEAST_BITS, int(size // BYTES_PER_BIT).bit_length()))
    history = [np.zeros(1 << (bits - 3), np.uint8)]  # of the last ``shards`` steps and this one
    phrase = F.substring_index("key", "\t", -1)
    frequent = (F.col("cnt") >= least) | (phrase == "")
    state, finished, step = None, [], 0
    while True:
        now = spark.sparkContext.broadcast(history[-1])
        old = spark.sparkContext.broadcast(history[0]) if step >= shards else None
        rows = dealt.where(F.col("shard") == step % shards).select("lang", "text").mapInArrow(
            _scan(now, old, step < shards, chunk), "key string, cnt long").withColumn("since", F.lit(step))
        counters = (rows if state is None else rows.unionByName(state)).groupBy("key").agg(
            F.sum("cnt").alias("cnt"), F.min("since").alias("since"))
        over = F.col("since") <= step - shards + 1  # counted for one full cycle
        counters = written(counters.where(~over | frequent), "phrase-counters")
        finished.append(counters.where(over).select("key", "cnt"))
        state = counters.where(~over)
        marked = _marked(counters.where((F.col("cnt") >= least) & (phrase != "") & (F.size(F.split(phrase, " ")) < LONGEST)), history[-1])
        history = [*history, marked][-(shards + 1):]
        step += 1
        if step >= shards and np.array_equal(history[0], history[-1]):
            break
    every = state.where(frequent).select("key", "cnt")
    for f in finished:
        every = every.unionByName(f)
    lang = F.expr(r"left(key, length(key) - length(substring_index(key, '\t', -1)) - 1)")
    return written(every.select(lang.alias("lang"), phrase.alias("phrase"), F.col("cnt").alias("a")), "phrase-counts")


def _sub(phrase_words: Column, first: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(phrase_words, first, n), " ")


def _wide(c: Column | str) -> Column:
    """A 64-bit number as an exact decimal; a product with a seven-digit factor still fits."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def scored(counts: DataFrame, scale: int = 2_000_000) -> DataFrame:
    """(lang, phrase, a, l, r, score): every phrase of two words or more with its lowest-scoring cut."""
    table = counts.where("phrase <> ''")
    words = F.split("phrase", " ")
    longer = table.withColumn("w", words).where(F.size("w") > 1)
    cuts = longer.withColumn("cut", F.explode(F.sequence(F.lit(1), F.size("w") - 1))).select(
        "lang", "phrase", "a", "cut", _sub(F.col("w"), F.lit(1), F.col("cut")).alias("left"),
        _sub(F.col("w"), F.col("cut") + 1, F.size("w") - F.col("cut")).alias("right"))
    cuts = written(cuts, "phrase-cuts")  # so that joins on a very common part read plain exchanges and can be split
    part = table.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("a").alias("_n"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = written(cuts.join(part, (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part"))).withColumnRenamed(
            "_n", name).drop("_lang", "_part"), f"phrase-{side}")
    # exact: floor of a fraction of whole decimals
    cuts = cuts.withColumn("top", _wide("a") * F.lit(scale).cast("decimal(8,0)")).withColumn("under", _wide("l") + _wide("r"))
    cuts = cuts.withColumn("score", F.expr("top div under").cast("long"))
    best = F.min(F.struct("score", "cut", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def contained(counts: DataFrame, share: tuple[int, int] = CONTAINED) -> DataFrame:
    """(lang, phrase) of phrases of two words or more inside a longer one with ``share`` of their occurrences."""
    table = counts.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 1)

    def inside(k: int) -> Column:
        """The phrases of ``k`` words in a longer one."""
        parts = F.transform(F.sequence(F.lit(1), F.size("w") - k + 1), lambda i: F.array_join(F.slice(F.col("w"), i, F.lit(k)), " "))
        return F.when(F.size("w") > k, parts).otherwise(F.array().cast("array<string>"))

    # the most frequent longer phrase decides, so a part's longer phrases are summed up where they stand
    most = table.select("lang", F.explode(F.array_distinct(F.concat(*[inside(k) for k in range(2, LONGEST)]))).alias("phrase"), "a").groupBy("lang", "phrase").agg(
        F.max("a").alias("_most"))
    held = counts.join(most, ["lang", "phrase"])
    return held.where(_wide("_most") * F.lit(share[1]).cast("decimal(8,0)") >= _wide("a") * F.lit(share[0]).cast("decimal(8,0)")).select("lang", "phrase")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, top: int = TOP,
                 shards: int = SHARDS, chunk: int = CHUNK_BYTES, bits: int | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` phrases by score, count and text.

    Edges: a null text is empty, a null language is ``und`` (and joins rows that
    say so); rows that repeat count each time; a language without a frequent
    phrase has no row; an empty table gives an empty result; texts of any length
    are counted whole; other columns are ignored.
    """
    return ranked(phrase_counts(docs, lang_col, text_col, least, shards, chunk, bits), top)


def ranked(counts: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language from the counts of ``phrase_counts``."""
    left = written(scored(counts).join(contained(counts), ["lang", "phrase"], "left_anti"), "phrase-scores")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within groups of a language, so that no task ranks all of its phrases
    some = left.withColumn("_g", F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))).withColumn(
        "_r", F.row_number().over(W.partitionBy("lang", "_g").orderBy(*order))).where(F.col("_r") <= top)
    rank = F.row_number().over(W.partitionBy("lang").orderBy(*order))
    best = some.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    n = counts.where("phrase = ''").select("lang", F.col("a").alias("n"))
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir, "text", "lang"))


SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(list_transform(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'),
    lambda x: regexp_extract_all(x, '[^\x20\x09]+'))) AS w FROM documents),
g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) v(k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY ALL),
c AS (SELECT lang, phrase, a, k, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, j, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a // (x.a::HUGEINT + y.a))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:], ' ')),
best AS (SELECT lang, phrase, a, l, r, score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT DISTINCT lang, phrase FROM (
    SELECT lang, a AS longer, array_to_string(w[i:i + m - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM c, (VALUES (2), (3)) v(m) WHERE m < k)) s
  JOIN f USING (lang, phrase) WHERE 100::HUGEINT * longer >= 80::HUGEINT * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best ANTI JOIN inside USING (lang, phrase) JOIN n USING (lang)
QUALIFY rank <= 2000
"""
