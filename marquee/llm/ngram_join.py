"""N-gram Jaccard join: index lists in rare-first order, skipped by position and by set relations.

Two documents link when the Jaccard similarity of their sets of distinct 5-word
shingles is 0.8 or more. The join is exact.

1. Frequencies. Every document's shingles are hashed (64 bits, numpy) and sent
   to the bucket of their hash as packed arrays; a bucket counts in how many
   documents each occurs and returns only those that occur twice or more.
   Shingles common inside one group of documents are counted there first and
   sent once, so a shingle of a third of all documents is no hot key.
2. Rare-first prefixes. With shingles ordered by frequency, a set of n can only
   link through its first ``n - ceil(0.8 n) + 1`` ones. Shingles found nowhere
   else come first; a document with that many of them can link with nothing and
   leaves. Links only ever share shingles that occur twice, so the arrays
   returned are all that verification needs: texts are not read again.
3. Index lists. A prefix shingle's list holds the sets that have it, with size
   and position. Equal sets are one class. A list is cut into blocks by size,
   and a block is skipped where no size in it can reach 0.8; an entry is skipped
   where the positions leave too few shingles to share, or where the parity
   bitmaps of two sets differ in more bits than two linked sets can.
4. Set relations. A list's pivots are compared with all its members. A set
   found similar to a pivot takes over the pivot's answers: both are one
   component, and no other pair inside it needs comparing. Only lists that still
   span several components are joined with themselves, across components, and
   there a pair is skipped if its distances to a shared pivot differ by more than
   a link allows (the Jaccard distance is a metric).

Component labels spread by joins. No list is ever held by one task or row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import textnum as tn
from marquee.llm.bitmap import bitmap, split
from marquee.llm.components import components
from marquee.llm.scratch import documents, id_and_text, written

#: Text of one group of documents whose shingles travel together, and its most documents.
GROUP_BYTES = 2 << 20
GROUP_ROWS = 4096
#: Shingles in this many documents of a group are sent once for the group.
COMMON = 8
#: Shingle arrays of one bucket, about (bytes); sets the number of buckets.
BUCKET_BYTES = 4 << 20
PIVOTS = 2

_SENT = "bucket int, grp long, h binary, cnt binary, common_h binary, common_n binary, docs binary"
_BACK = "grp long, row binary, h binary, df binary, common_h binary, common_df binary, docs binary"
_SETS = "doc_id long, row_key long, n_shingles long, node binary, unique_shingles long, prefix array<bigint>, bitmap array<bigint>, shingles binary"


def _pack(h: np.ndarray) -> bytes:
    """The low seven bytes of every hash; the bucket gives the top one."""
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()


def _unpack(data: bytes, top: int) -> np.ndarray:
    b = np.zeros((len(data) // 7, 8), np.uint8)
    b[:, :7] = np.frombuffer(data, np.uint8).reshape(-1, 7)
    b[:, 7] = top
    return b.reshape(-1).view("<u8")


def _distinct(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct hashes in ascending order (rows ascending)."""
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    if not len(h):
        return h, rows
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    return h[first], rows[first]


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, words before each row), hashed in bounded pieces; a longer text is cut at white space."""
    found, bounds = [], [0]
    for lo, hi in tn.chunks(offsets):
        piece = data[offsets[lo] : offsets[hi]]
        if hi - lo == 1 and len(piece) > 2 * tn.CHUNK_BYTES:
            at, n = 0, 0
            while at < len(piece):
                end = min(len(piece), at + tn.CHUNK_BYTES)
                while end < len(piece):
                    gap = np.flatnonzero(tn._SPACE[piece[end : end + 4096]])
                    if len(gap):
                        end += int(gap[0])
                        break
                    end = min(len(piece), end + 4096)
                word = tn.words(piece[at:end], np.array([0, end - at]))[0]
                found.append(word)
                n, at = n + len(word), end
            bounds.append(bounds[-1] + n)
            continue
        word, _, inner = tn.words(piece, offsets[lo : hi + 1] - offsets[lo])
        found.append(word)
        bounds += (bounds[-1] + inner[1:]).tolist()
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), np.array(bounds, np.int64)


def _send(top_bits: int, size: int):
    """Map side of step 1: one row per (bucket, group)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offsets = tn.texts_of(batch.column("text"))
            ids = batch.column("doc_id")
            for lo, hi in tn.chunks(offsets, GROUP_BYTES, GROUP_ROWS):
                word, bounds = _pieces(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                h, rows = _distinct(*tn.shingles(word, bounds, size))
                n = np.bincount(rows, minlength=hi - lo)
                node = np.stack([_sums(tn.mix(h), n), _sums(tn.mix(h ^ np.uint64(0x5BD1E995A5A5A5A5)), n)], 1)
                grp, serial = part << 32 | serial, serial + 1
                uniq, at, times = np.unique(h, return_inverse=True, return_counts=True)
                common = times[at] >= COMMON
                own, keys = (pa.array(c.slice(lo, hi - lo).to_pylist(), pa.int64()) for c in (ids, batch.column("row_key")))
                docs = pa.RecordBatch.from_arrays(
                    [own, keys, pa.array(n, pa.int64()), pa.array([x.tobytes() for x in node], pa.binary()),
                     _lists(rows[common], h[common], hi - lo)], names=["id", "key", "n", "node", "common"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, docs.schema) as w:
                    w.write_batch(docs)
                yield _buckets(h[~common], rows[~common], uniq[times >= COMMON], times[times >= COMMON], hi - lo, grp, top_bits,
                               sink.getvalue().to_pybytes())
    return run


def _sums(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sum of each row's values modulo 2**64."""
    p = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=p[1:])
    end = np.cumsum(n)
    return tn.mix(p[end] - p[end - n] + n.astype(np.uint64))


def _lists(rows: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    offsets = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _buckets(h, rows, common, times, n_rows, grp, bits, docs) -> pa.RecordBatch:
    """A group's shingles by bucket (the top ``bits`` bits, 8 at least, of the hash)."""
    bucket = (h >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    h, rows, bucket = h[order], rows[order], bucket[order]
    cb = (common >> np.uint64(64 - bits)).astype(np.int64)
    home = grp % (1 << bits)
    used = np.union1d(np.union1d(bucket, cb), [home])
    a, b = np.searchsorted(bucket, used), np.searchsorted(bucket, used, "right")
    ca, cz = np.searchsorted(cb, used), np.searchsorted(cb, used, "right")
    out = [[], [], [], [], [], [], []]
    for k, u in enumerate(used.tolist()):
        counts = np.bincount(rows[a[k] : b[k]], minlength=n_rows) if b[k] > a[k] else np.zeros(0, np.int64)
        for column, value in zip(out, (
            u, grp, _pack(h[a[k] : b[k]]), _counted(counts),
            _pack(common[ca[k] : cz[k]]), times[ca[k] : cz[k]].astype("<u4").tobytes(), docs if u == home else None), strict=True):
            column.append(value)
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                                      names=["bucket", "grp", "h", "cnt", "common_h", "common_n", "docs"])


def _counted(counts: np.ndarray) -> bytes:
    """Shingles of every row in two bytes each, or in four behind a mark where one has more than two bytes hold."""
    return counts.astype("<u2").tobytes() if counts.max(initial=0) < 1 << 16 else b"w" + counts.astype("<u4").tobytes()


def _counts(data: bytes) -> np.ndarray:
    return np.frombuffer(data[1:], "<u4") if len(data) % 2 else np.frombuffer(data, "<u2")


def _count(bits: int):
    """Step 1 in a bucket: document frequencies; only shingles of two documents or more go back."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        top = lambda r: r["bucket"] >> (bits - 8)
        single = [_unpack(r["h"], top(r)) for r in rows]
        common = [_unpack(r["common_h"], top(r)) for r in rows]
        every = np.concatenate([*single, *common])
        weight = np.concatenate([np.ones(sum(map(len, single)), np.int64), *[np.frombuffer(r["common_n"], "<u4") for r in rows]])
        uniq, at = np.unique(every, return_inverse=True)
        df = np.bincount(at, weights=weight, minlength=len(uniq)).astype(np.int64)[at] if len(uniq) else np.zeros(0, np.int64)
        out, a, z = [], 0, sum(map(len, single))
        for r, h, c in zip(rows, single, common, strict=True):
            mine, theirs = df[a : a + len(h)], df[z : z + len(c)]
            a, z = a + len(h), z + len(c)
            keep = mine > 1
            if keep.any() or len(c) or r["docs"] is not None:
                counts = _counts(r["cnt"])
                row = np.repeat(np.arange(len(counts)), counts)[keep]
                out.append((r["grp"], row.astype("<u2").tobytes(), h[keep].tobytes(), np.minimum(mine[keep], 2**32 - 1).astype("<u4").tobytes(),
                            c.tobytes(), np.minimum(theirs, 2**32 - 1).astype("<u4").tobytes(), r["docs"]))
        kinds = [pa.int64(), *[pa.binary()] * 6]
        names = ["grp", "row", "h", "df", "common_h", "common_df", "docs"]
        return pa.Table.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate(kinds)], names=names)
    return run


def _assemble(table: pa.Table) -> pa.Table:
    """Step 2 for a group of documents: rare-first order, and prefixes of the sets that can link."""
    got = table.to_pylist()
    docs = pa.ipc.open_stream(next(r["docs"] for r in got if r["docs"] is not None)).read_all()
    join = lambda name, kind: np.concatenate([np.frombuffer(r[name], kind) for r in got])
    row, h, df = join("row", "<u2").astype(np.int64), join("h", "<u8"), join("df", "<u4")
    ch, cdf = join("common_h", "<u8"), join("common_df", "<u4")
    order = np.argsort(ch)
    ch, cdf = ch[order], cdf[order]
    lists = docs.column("common").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    flat, offs = lists.flatten().to_numpy().view("<u8"), lists.offsets.to_numpy()
    if len(flat):
        row = np.concatenate([row, np.repeat(np.arange(len(docs)), np.diff(offs))])
        h, df = np.concatenate([h, flat]), np.concatenate([df, cdf[np.searchsorted(ch, flat)]])
    order = np.lexsort((h, df, row))
    row, h = row[order], h[order]
    n = docs.column("n").to_numpy()
    bounds = np.searchsorted(row, np.arange(len(docs) + 1))
    unique = n - np.diff(bounds)
    need = n - (8 * n + 9) // 10 + 1  # prefix length
    prefix, bitmaps, sets = [], [], []
    for i in range(len(docs)):
        able = n[i] > 0 and unique[i] < need[i]
        own = h[bounds[i] : bounds[i + 1]] if able else None
        prefix.append(own[: need[i] - unique[i]].view(np.int64) if able else None)
        bitmaps.append(_parities(own) if able else None)
        sets.append(np.sort(own).tobytes() if able else None)
    return pa.Table.from_arrays(
        [docs.column("id"), docs.column("key"), pa.array(n, pa.int64()), docs.column("node"), pa.array(unique, pa.int64()),
         pa.array(prefix, pa.list_(pa.int64())), pa.array(bitmaps, pa.list_(pa.int64())), pa.array(sets, pa.binary())],
        names=["doc_id", "row_key", "n_shingles", "node", "unique_shingles", "prefix", "bitmap", "shingles"])


def _parities(h: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each of 128 bins, as two 64-bit words."""
    bins = (tn.mix(h) & np.uint64(127)).astype(np.int64)
    return np.packbits((np.bincount(bins, minlength=128) & 1).astype(np.uint8)).view(np.int64)


def shingle_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5) -> DataFrame:
    """Steps 1 and 2: one row per document; ``prefix`` and ``shingles`` only where it can link at all."""
    d = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("row_key"))
    total = d.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    bits = int(min(20, max(8, np.ceil(np.log2(max(1, 1.3 * total / BUCKET_BYTES))))))
    sent = d.mapInArrow(_send(bits, size), _SENT)
    back = sent.groupBy("bucket").applyInArrow(_count(bits), _BACK)
    return back.groupBy("grp").applyInArrow(_assemble, _SETS)


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared = [len(np.intersect1d(np.frombuffer(x.as_py(), "<u8"), np.frombuffer(y.as_py(), "<u8"), assume_unique=True))
                  for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("a", "b", "na", "nb")] + [pa.array(shared, pa.int64())],
                                         names=["a", "b", "na", "nb", "shared"])


def verified(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b, distance, link): every pair's exact similarity from the two classes' arrays."""
    own = classes.select("node", "shingles")
    both = pairs.join(own.withColumnsRenamed({"node": "b", "shingles": "sb"}), "b").join(
        own.withColumnsRenamed({"node": "a", "shingles": "sa"}), "a").select("a", "b", "na", "nb", "sa", "sb")
    seen = both.mapInArrow(_overlaps, "a binary, b binary, na long, nb long, shared long")
    union = F.col("na") + F.col("nb") - F.col("shared")
    return seen.select("a", "b", (1 - F.col("shared") / union).alias("distance"), (100 * F.col("shared") >= 80 * union).alias("link"))


def _fits(x, y):
    """Whether two entries of a list (structs n, u, at, bits) can link.

    Sizes within 0.8; after their positions enough shingles left to share; and no
    more shingles in one set alone than a link allows, (n1 + n2) / 9: those found
    in no other set, and one at least per bin whose parities differ.
    """
    total = x["n"] + y["n"]
    least = F.ceil(total * 4 / F.lit(9) - 1e-9)  # shared >= 0.8 / 1.8 of the sizes' sum
    apart = x["u"] + y["u"]
    for k in range(2):
        apart = apart + F.bit_count(x["bits"][k].bitwiseXOR(y["bits"][k]))
    return ((10 * F.least(x["n"], y["n"]) >= 8 * F.greatest(x["n"], y["n"]))
            & (F.least(x["n"] - x["at"], y["n"] - y["at"]) >= least) & (9 * apart <= total))


def links(classes: DataFrame, pivots: int = PIVOTS) -> DataFrame:
    """(node, comp) of the classes that link with another class (steps 3 and 4)."""
    posts = classes.select(
        "node", "n_shingles", "unique_shingles", "bitmap", F.posexplode("prefix").alias("_k", "token")).select(
        "node", "token", F.struct(F.col("n_shingles").alias("n"), F.col("unique_shingles").alias("u"),
                                  (F.col("unique_shingles") + F.col("_k")).alias("at"), F.col("bitmap").alias("bits")).alias("e"))
    chosen = [F.min(F.struct(F.xxhash64(F.lit(r), "token", "node"), F.struct("node", "e"))).alias(f"p{r}") for r in range(pivots)]
    heads = posts.groupBy("token").agg(F.count(F.lit(1)).alias("length"), *chosen).where("length > 1").select(
        "token", F.array_distinct(F.array(*[F.col(f"p{r}.col2") for r in range(pivots)])).alias("pivots"))
    stars = posts.join(heads, "token").withColumn("p", F.explode("pivots")).where(
        (F.col("p.node") != F.col("node")) & _fits(F.col("p.e"), F.col("e")))
    left, right = F.struct(F.col("p.node").alias("x"), F.col("p.e.n").alias("n")), F.struct(F.col("node").alias("x"), F.col("e.n").alias("n"))
    pairs = stars.select(F.least(left, right).alias("l"), F.greatest(left, right).alias("r")).distinct().select(
        F.col("l.x").alias("a"), F.col("r.x").alias("b"), F.col("l.n").alias("na"), F.col("r.n").alias("nb"))
    compared = written(verified(pairs, classes), "compared")
    first = components(compared.where("link"))
    # lists that still span several components
    own = posts.join(first, "node", "left").select("node", "token", "e", F.coalesce("comp", "node").alias("comp"))
    mixed = own.groupBy("token").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo <> _hi").select("token")
    # one list joins itself by size block: a block meets itself and the next larger one only
    block = F.floor(F.log(F.col("e.n").cast("double")) / F.log(F.lit(1.25)) + 1e-9)
    open_lists = written(own.join(mixed, "token").withColumn("block", block), "open-lists")
    small = open_lists.withColumn("block", F.explode(F.array(F.col("block"), F.col("block") + 1))).select(
        "token", "block", F.col("node").alias("a"), F.col("e").alias("ea"), F.col("comp").alias("ca"))
    large = open_lists.select("token", "block", F.col("node").alias("b"), F.col("e").alias("eb"), F.col("comp").alias("cb"))
    na, nb = F.col("ea.n"), F.col("eb.n")
    met = small.join(large, ["token", "block"]).where(
        (F.col("ca") != F.col("cb")) & ((na < nb) | ((na == nb) & (F.col("a") < F.col("b")))) & _fits(F.col("ea"), F.col("eb")))
    rest = met.select("a", "b", na.alias("na"), nb.alias("nb")).distinct()
    done = compared.select(F.least("a", "b").alias("_a"), F.greatest("a", "b").alias("_b"))
    rest = written(rest.join(done, (F.least("a", "b") == F.col("_a")) & (F.greatest("a", "b") == F.col("_b")), "left_anti"), "rest")
    late = written(verified(_by_triangle(rest, compared), classes).where("link"), "late-links")
    if late.limit(1).count() == 0:
        return first
    # the late links join whole components: only these are followed further
    ends = late.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    known = written(first.unionByName(ends.join(first, "node", "left_anti").select("node", F.col("node").alias("comp"))), "first-labels")
    at = lambda side: known.select(F.col("node").alias(side), F.col("comp").alias(f"comp_{side}"))
    joined = components(late.select("a", "b").join(at("a"), "a").join(at("b"), "b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")))
    return known.join(joined.select(F.col("node").alias("comp"), F.col("comp").alias("_whole")), "comp", "left").select(
        "node", F.coalesce("_whole", "comp").alias("comp"))


def _by_triangle(rest: DataFrame, compared: DataFrame) -> DataFrame:
    """Pairs whose distances to their nearest shared pivot do not already rule a link out."""
    near = compared.select(F.col("a").alias("node"), F.struct("distance", F.col("b").alias("pivot")).alias("d")).unionByName(
        compared.select(F.col("b").alias("node"), F.struct("distance", F.col("a").alias("pivot")).alias("d")))
    best = near.groupBy("node").agg(F.min("d").alias("d"))
    known = rest.join(best.select(F.col("node").alias("a"), F.col("d").alias("_da")), "a", "left").join(
        best.select(F.col("node").alias("b"), F.col("d").alias("_db")), "b", "left")
    apart = (F.col("_da.pivot") == F.col("_db.pivot")) & (F.abs(F.col("_da.distance") - F.col("_db.distance")) > 0.2 + 1e-9)
    return known.where(~F.coalesce(apart, F.lit(False))).select("a", "b", "na", "nb")


def _labelled(docs: DataFrame, id_col: str, text_col: str, size: int) -> tuple[DataFrame, DataFrame]:
    """(rows that can link, with their component ``comp``; the other rows). ``row_key`` is a hash of a row's text."""
    sets = written(shingle_sets(docs, id_col, text_col, size), "shingle-sets")
    able = sets.where("shingles is not null")
    classes = written(able.groupBy("node").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("unique_shingles").alias("unique_shingles"),
        F.first("prefix").alias("prefix"), F.first("bitmap").alias("bitmap"), F.first("shingles").alias("shingles")), "classes")
    comps = links(classes)
    labelled = able.select("doc_id", "row_key", "n_shingles", "node").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    return labelled, sets.where("shingles is null")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per input row.

    Pairs inside a component are not compared once it is known: the result tells
    what is reachable, not each set's list of partners. Shingles are told apart
    by 64-bit hashes.
    Edges: a null, empty or wordless text has no shingles, links with nothing and
    is its own component; a text of fewer than ``size`` words is one shingle of
    all of them; equal sets are linked; ids are integers, rows that share an id
    are separate rows, and a null id takes the smallest id of its component (null
    if it has none); an empty table gives an empty result; other columns are
    ignored.
    """
    labelled, rest = _labelled(docs, id_col, text_col, size)
    # written, so that the join below reads two plain exchanges and a component of a third of all rows can be split
    smallest = written(labelled.groupBy("comp").agg(F.min("doc_id").alias("component_id")), "smallest-ids")
    alone = rest.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return labelled.join(smallest, "comp").select("doc_id", "n_shingles", "component_id").unionByName(alone)


def keep_smallest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, same columns.

    The row with the smallest id stays, of several with that id the one whose text
    hash is smallest; so rows that share an id are decided by their own texts.
    Rows that repeat the staying one's id and text all stay, and so do rows
    without an id. The decision is joined by id and text hash, and only for rows
    that a bitmap of the ids that go may hold; other texts never leave the scan.
    """
    labelled, _ = _labelled(docs, id_col, text_col, 5)
    labelled = labelled.where("doc_id is not null").select("comp", F.struct("doc_id", "row_key").alias("r"))
    # narrow rows, so a component of a third of them is split like any skewed join
    first = written(labelled.groupBy("comp").agg(F.min("r").alias("stays")), "smallest-rows")
    goes = written(labelled.join(first, "comp").where(F.col("r") != F.col("stays")).select(
        F.col("r.doc_id").alias("_near_id"), F.col("r.row_key").alias("_near_key"), F.xxhash64("r.doc_id").alias("h")), "near-copies")
    ids = F.col(f"`{id_col}`").cast("long")
    possible, others = split(docs, F.xxhash64(ids), *bitmap(goes))
    own = F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    left = possible.withColumn("_near_own", own).join(
        goes.select("_near_id", "_near_key").distinct(), (ids == F.col("_near_id")) & (F.col("_near_own") == F.col("_near_key")), "left_anti")
    return others.unionByName(left.drop("_near_own"))


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(documents(spark, sf_dir, "doc_id", "text"))


SQL = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
t AS (SELECT doc_id, unnest(s) AS t FROM s),
rare AS (SELECT t FROM t GROUP BY t HAVING count(*) > 1),
u AS (SELECT doc_id, t FROM t JOIN rare USING (t)),
able AS (SELECT doc_id, n FROM n JOIN (SELECT doc_id, count(*) AS k FROM u GROUP BY doc_id) USING (doc_id) WHERE 100 * k >= 80 * n),
v AS (SELECT doc_id, n, t FROM u JOIN able USING (doc_id)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS i
      FROM v a JOIN v b ON a.t = b.t AND a.doc_id < b.doc_id AND 10 * least(a.n, b.n) >= 8 * greatest(a.n, b.n) GROUP BY ALL),
e AS (SELECT a, b FROM p WHERE 100 * i >= 80 * (na + nb - i)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach AS (
  WITH RECURSIVE r(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, x.b FROM r JOIN both_ways x ON r.b = x.a)
  SELECT a AS doc_id, min(b) AS m FROM r GROUP BY a)
SELECT n.doc_id, n AS n_shingles, least(n.doc_id, coalesce(m, n.doc_id)) AS component_id FROM n LEFT JOIN reach USING (doc_id)
"""
