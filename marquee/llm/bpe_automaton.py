"""BPE encoding and decoding by a tokenization automaton.

``compile_merges`` builds a deterministic automaton whose paths are exactly the
BPE tokenizations. It starts with one state that has an arc to itself for every
base symbol, and applies one gadget per merge ``(u, v) -> uv``, in rank order.
With ``q`` the state that all ``u`` arcs lead to:

* a new state ``q'`` is ``q`` without its ``v`` arc, and the ``u`` arcs now lead to ``q'``
  (after ``u``, the pair ``u v`` may no longer be spelled in two tokens);
* every state with a ``u`` arc gets a ``uv`` arc to where ``q``'s ``v`` arc led.

All arcs with one label lead to the same state, so a state is named by the label
it follows and a time: a copy made at that time lacks one arc more. The compiled
automaton therefore keeps, per removed arc, its time, and per label its time and
two parts; ``arc`` answers from these whether a state has an arc, and answers
are kept as rows of a transition table.

Every prefix of a word has exactly one tokenization, so a place of a word is
reached by one path at most. Encoding walks the automaton along the longest label
that has an arc, and steps back where no arc goes on; a place left that way is
never reached again, so a walk is linear in the word whatever it tries. Decoding emits the
arc labels. Words come from the tokenizer's own normaliser and split rule. Each
worker keeps the tokens of words already seen, in a table of bounded size.
"""

from __future__ import annotations

import functools
import hashlib
import json
import struct
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from sys import getsizeof

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from marquee.llm.scratch import documents, id_and_text
from marquee.llm.textnum import give_back

#: Memory that a worker's remembered runs may take, about, and the longest run that is remembered (characters).
MEMO_BYTES = 32 << 20
MEMO_RUN = 256
#: Place of a remembered run in the dictionary, beside its two texts (bytes, about).
MEMO_ENTRY = 56
#: Rows of the transition table that are kept.
MOST_ARCS = 1 << 18
#: Lengths tried where no longer label begins.
_SHORT = 3, 2, 1
_NOTHING = hashlib.sha256(b"").hexdigest()
_CONTROLS = regex.compile("[\x1c-\x1f]")
_RUN = regex.compile(r"\S+")
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_symbols() -> dict[int, str]:
    """Printable character of every byte in byte-level vocabularies (a public fixed rule)."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    out, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + extra)
            extra += 1
    return out


class Automaton:
    """Deterministic automaton over token labels (small integers); see the module's docstring.

    It is kept in flat arrays and in dictionaries of integers, and nothing that
    only compiling needs stays: every worker holds one.
    """

    def __init__(self, base: list[str], merges: Iterable[tuple[str, str]]):
        labels = list(dict.fromkeys(base))
        number = {x: i for i, x in enumerate(labels)}
        self.symbol = dict(number)  # numbers of the base symbols
        self.made = array("i", [0] * len(labels))  # time of a label's gadget, 0 for base symbols
        self.first, self.second = array("i", [-1] * len(labels)), array("i", [-1] * len(labels))  # a label's two parts
        self.removed: dict[int, int] = {}  # (label followed, arc removed) → time
        self.table: dict[int, bool] = {}  # (label followed, arc) → has it, in the finished automaton
        self.finished = 0
        for u, v in merges:
            self.finished += 1
            a, b = number.get(u), number.get(v)
            if a is not None and b is not None and self.gadget(a, b, self.finished) and u + v not in number:
                number[u + v] = len(labels)
                labels.append(u + v)
                self.made.append(self.finished)
                self.first.append(a)
                self.second.append(b)
        self.labels = labels
        del number
        # labels by the symbols that they spell (a character each, of the symbol's number)
        self.spelled = {"".join(map(chr, self.spelling(i))): i for i in range(len(labels))}
        self.sizes = array("H", map(len, self.spelled))
        # lengths of the labels that can begin at four symbols, longest first; shorter labels are tried anywhere
        long: dict[str, set[int]] = {}
        for text in self.spelled:
            if len(text) >= 4:
                long.setdefault(text[:4], set()).add(len(text))
        same: dict[tuple[int, ...], tuple[int, ...]] = {}
        self.lengths: dict[str, tuple[int, ...]] = {}
        for c, x in long.items():
            ways = *sorted(x, reverse=True), *(k for k in _SHORT if c[:k] in self.spelled)
            self.lengths[c] = same.setdefault(ways, ways)

    def gadget(self, a: int, b: int, time: int) -> bool:
        """Apply the merge of two labels; False where they can never stand side by side: it changes nothing then."""
        if not self.arc(a, b, time - 1):
            return False
        self.removed[a << 20 | b] = time
        return True

    def spelling(self, label: int) -> list[int]:
        """Base symbols of a label."""
        out, todo = [], [label]
        while todo:
            x = todo.pop()
            if self.first[x] < 0:
                out.append(x)
            else:
                todo += (self.second[x], self.first[x])
        return out

    def arc(self, x: int, c: int, time: int) -> bool:
        """Whether the state that ``x`` arcs led to at ``time`` had an arc ``c``."""
        made = self.made
        while True:
            gone = self.removed.get(x << 20 | c)
            if gone is not None and gone <= time:
                return False
            if made[c] >= made[x]:
                if not made[c]:
                    return True  # base symbols, never removed
                c, time = self.first[c], made[c]  # the arc was added where its first part had one
            else:
                x, time = self.second[x], made[x] - 1  # copied from the state that x's second part led to

    def tokens(self, symbols: str) -> list[int]:
        """The path that spells the symbols (a character each, of the symbol's number)."""
        n, spelled, lengths, table, finished = len(symbols), self.spelled.get, self.lengths.get, self.table.get, self.finished
        out: list[int] = []
        before, at, used = -1, 0, 0
        while at < n:
            ways = lengths(symbols[at : at + 4], _SHORT)
            for size in ways[used:] if used else ways:
                label = spelled(symbols[at : at + size])  # beyond the end: all that is left
                if label is None:
                    continue
                if before >= 0:
                    has = table(before | label)
                    if has is None:
                        has = self.arc(before >> 20, label, finished)
                        if len(self.table) >= MOST_ARCS:
                            self.table.clear()
                        self.table[before | label] = has
                    if not has:
                        continue
                out.append(label)
                before, at, used = label << 20, at + size, 0
                break
            else:
                if not out:
                    raise ValueError(f"no path spells the symbols {symbols!r}")
                size = self.sizes[out.pop()]
                at -= size
                used = lengths(symbols[at : at + 4], _SHORT).index(size) + 1
                before = out[-1] << 20 if out else -1
        return out


class WordTokenizer:
    """Encodes and decodes whole texts by the automaton of a word-level-suffix BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        symbols = byte_symbols()
        base = [symbols[b] + e for e in ("", suffix) for b in range(256)]  # a byte inside a word has its own number
        self.automaton = Automaton(base, (m if isinstance(m, list) else m.split(" ") for m in model["merges"]))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.split = regex.compile(split)
        self.special_split = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.packed = [struct.pack("<i", vocab.get(x, -1)) for x in self.automaton.labels]
        self.automaton.labels = []  # from here on labels are their ids
        self.labels = {i: t for t, i in {**vocab, **self.special}.items()}
        self.memo: dict[str, bytes] = {}
        self.memo_left = MEMO_BYTES
        # symbol of a byte at the end of a word
        number = self.automaton.symbol
        self.ending = {chr(b): chr(number[symbols[b] + suffix]) for b in range(256)}

    def word(self, word: str) -> bytes:
        """The ids of one pre-split word as little-endian 32-bit integers."""
        symbols = word if word.isascii() else word.encode("utf-8").decode("latin-1")
        packed = self.packed
        return b"".join([packed[x] for x in self.automaton.tokens(symbols[:-1] + self.ending[symbols[-1]])])

    def chunk(self, chunk: str) -> bytes:
        """The same for a run without white space, remembered; the split rule never matches across white space."""
        found = self.memo.get(chunk)
        if found is None:
            words = self.split.findall(self.normalise(chunk))
            found = self.word(words[0]) if len(words) == 1 else b"".join(map(self.word, words))
            if self.memo_left > 0 and len(chunk) <= MEMO_RUN:
                self.memo[chunk] = found
                self.memo_left -= MEMO_ENTRY + getsizeof(chunk) + getsizeof(found)
        return found

    def normalise(self, text: str) -> str:
        """Composed form and lower case. White space only separates words here, so its folding is left to the split."""
        if text.isascii():
            return text.lower()
        return "".join(map(_lower_char, unicodedata.normalize("NFC", text)))

    def ids(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers: of its white-space runs and special tokens, one after the other."""
        if self.special_split is None or "<|" not in text:
            return self.plain_ids(text)
        out, at = [], 0
        for m in self.special_split.finditer(text):
            out += self.plain_ids(text[at : m.start()]), _pack([self.special[m.group()]])
            at = m.end()
        return b"".join([*out, self.plain_ids(text[at:])])

    def plain_ids(self, text: str) -> bytes:
        memo, chunk = self.memo.get, self.chunk
        # str.split also cuts at four control characters that the file's rule does not count as white space
        runs = text.split() if not _CONTROLS.search(text) else _RUN.findall(text)
        return b"".join([memo(r) or chunk(r) for r in runs])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.ids(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The arc labels emitted in order; the file names no decoder, so labels are joined by spaces."""
        return " ".join([self.labels[i] for i in ids if i in self.labels])

    def digest(self, text: str) -> tuple[int, str, str]:
        """(tokens, digest of ids, digest of the decoded text)."""
        ids = self.ids(text)
        if not ids:
            return 0, _NOTHING, _NOTHING
        shown = " ".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(shown.encode("utf-8")).hexdigest()


def _pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@functools.lru_cache(maxsize=4096)
def _lower_char(c: str) -> str:
    """Lower case of one character on its own (no context rules)."""
    return c.lower()


@functools.lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """One compiled automaton per worker and file."""
    return WordTokenizer(path)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ``ids`` where asked for): one row per input row, no shuffle.

    Edges: a null or empty text has no tokens and the digests of nothing;
    characters outside the split rule (white space) are dropped; control strings
    of the vocabulary inside a text become their reserved ids, as the library
    does; an empty table gives an empty result. ``path`` must be readable on
    every executor (the tokenizer file is part of the installed environment).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        t = tokenizer(path)
        for batch in batches:
            out = [], [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                for column, value in zip(out, t.digest(text), strict=False):
                    column.append(value)
                if with_ids:
                    out[3].append(t.encode(text))
            arrays = [batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                arrays.append(pa.array(out[3], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    d = id_and_text(docs, id_col, text_col)
    schema = SCHEMA.replace("doc_id long", f"doc_id {d.schema['doc_id'].dataType.simpleString()}")
    return d.mapInArrow(run, schema + (", ids array<int>" if with_ids else ""))


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(documents(spark, sf_dir, "doc_id", "text"), word_bpe_path())
