"""Chat formatting by token-level assembly.

A turn is ``[TURN] role [SEP] text [END]``: role and text are encoded on their
own, so no merge can run across a segment border, and the markers are reserved
ids that no text can produce. In the written form the markers read ``### ``,
``: `` and `` </turn>`` plus a line end; where one of the control strings ``### `` or
``</turn>`` occurs inside a role or text, one backslash is put before it and
before the backslashes that already precede it, so reading back takes one away.

Encoding is one independent pass over the turns. Offsets of the turns in their
conversation, and with them the loss mask, are prefix sums of segment lengths.
Reading back decodes the assembled ids. Only the digests of a conversation need
its turns in order; they stream over sorted turns with a fixed state, so a
conversation of any length takes no more memory.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.llm.scratch import ship_package
from marquee.sources.tables import table

#: Control strings of the template, and the markers built from them.
CONTROL = ("### ", "</turn>")
MARKERS = {"turn": "### ", "sep": ": ", "end": " </turn>\n"}
TRAINED_ROLE = "assistant"

_ESCAPE = regex.compile(r"(\\*)(" + "|".join(map(regex.escape, CONTROL)) + ")")
_UNESCAPE = regex.compile(r"\\(\\*)(" + "|".join(map(regex.escape, CONTROL)) + ")")
_SEGMENTS = "conv_id long, turn long, role string, text string, ids binary, n_tokens long, text_from long, text_to long"
_DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
            "n_tokens long, loss_tokens long")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2", text)


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    return t


def reserved(path: str) -> dict[str, int]:
    """Ids of the markers, above the vocabulary."""
    size = _tokenizer(path).get_vocab_size(with_added_tokens=True)
    return {name: size + k for k, name in enumerate(MARKERS)}


def encode_turns(turns: DataFrame, path: str) -> DataFrame:
    """Every turn as ids with markers spliced in, and the place of its text among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, mark = _tokenizer(path), reserved(path)
        for batch in batches:
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            coded = t.encode_batch([escape(x) for pair in zip(roles, texts, strict=True) for x in pair], add_special_tokens=False)
            ids, n, a, z = [], [], [], []
            for k in range(len(roles)):
                role, text = coded[2 * k].ids, coded[2 * k + 1].ids
                whole = [mark["turn"], *role, mark["sep"], *text, mark["end"]]
                ids.append(np.array(whole, "<u4").tobytes())
                n.append(len(whole))
                a.append(len(role) + 2)
                z.append(len(role) + 2 + len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), batch.column("role"), batch.column("text"), pa.array(ids, pa.binary()),
                 *[pa.array(x, pa.int64()) for x in (n, a, z)]],
                names=["conv_id", "turn", "role", "text", "ids", "n_tokens", "text_from", "text_to"])
    return turns.mapInArrow(run, _SEGMENTS)


def assemble(turns: DataFrame, path: str) -> DataFrame:
    """conv_id, seq, ids, start, loss_from, loss_to: the formatted conversations, a row per turn.

    ``start`` is the turn's first position in its conversation, the prefix sum of
    the lengths before it; the loss mask is 1 on [loss_from, loss_to), empty for
    turns that are not trained on. Turns are ordered by number (null first), then
    role, then text.
    """
    segments = encode_turns(turns, path)
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "ids")
    before = F.coalesce(F.sum("n_tokens").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = segments.withColumns({"seq": F.row_number().over(order).cast("long"), "start": before})
    trained = F.col("role") == TRAINED_ROLE
    loss_from = F.col("start") + F.col("text_from")
    return placed.select(
        "conv_id", "seq", "ids", "start", loss_from.alias("loss_from"),
        F.when(trained, F.col("start") + F.col("text_to")).otherwise(loss_from).alias("loss_to"))


def _read_back(path: str):
    """Stream of assembled turns, in order, to one digest row per conversation; everything comes from ids and masks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, mark = _tokenizer(path), reserved(path)
        current, state, done = object(), None, []

        def close() -> None:
            if state is not None:
                done.append((current, state["n"], state["turns"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(),
                             state["chars"], state["tokens"], state["loss_tokens"]))

        for batch in batches:
            ids = [np.frombuffer(x, "<u4") for x in batch.column("ids").to_pylist()]
            start, lo, hi = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("start", "loss_from", "loss_to"))
            cuts, parts = [], []
            for k, x in enumerate(ids):
                sep = int(np.flatnonzero(x == mark["sep"])[0])
                if x[0] != mark["turn"] or x[-1] != mark["end"]:
                    raise ValueError("a turn does not begin and end with its markers")
                parts += [x[1:sep].tolist(), x[sep + 1 : -1].tolist(), x[lo[k] - start[k] : hi[k] - start[k]].tolist()]
                cuts.append(len(x))
            said = t.decode_batch(parts, skip_special_tokens=False)
            for k, conv in enumerate(batch.column("conv_id").to_pylist()):
                role, text, loss = said[3 * k : 3 * k + 3]
                if state is None or conv != current:
                    close()
                    current = conv
                    state = {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0, "tokens": 0, "loss_tokens": 0}
                state["n"] += 1
                state["chars"] += len(role) + len(text) + sum(map(len, MARKERS.values()))
                state["tokens"] += cuts[k]
                state["loss_tokens"] += int(hi[k] - lo[k])
                state["turns"].update(f"{unescape(role)}\n{unescape(text)}\n".encode())
                loss = unescape(loss)
                state["loss"].update(loss.encode())
                state["loss_chars"] += len(loss)
            yield _rows(done)
            done = []
        close()
        yield _rows(done)
    return run


def _rows(done: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in _DIGESTS.split(", ")]
    kinds = [pa.string() if c.endswith("string") else pa.int64() for c in _DIGESTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names=names)


def conversations_of(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    return df.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def read_back(assembled: DataFrame, path: str) -> DataFrame:
    """One row per conversation, from the assembled ids and masks alone."""
    ordered = assembled.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    return ordered.mapInArrow(_read_back(path), _DIGESTS)


def chat_format(df: DataFrame, path: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars (and token counts) per conversation.

    Edges: null roles and texts are empty; a null conversation id is a
    conversation of its own; null turn numbers come first; rows that repeat are
    turns of their own; a conversation without assistant turns has an empty loss
    (the digest of nothing); an empty table gives an empty result.
    """
    return read_back(assemble(conversations_of(df), path), path)


def byte_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    given = table(spark, sf_dir, "conversations")
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(1).select(F.explode(F.array(
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit(said).alias("text")),
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(1).cast("long").alias("turn"), F.lit("assistant").alias("role"), F.lit(said).alias("text")),
    )).alias("t")).select("t.*")
    return chat_format(given.unionByName(extra), byte_bpe_path())
