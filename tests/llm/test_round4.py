"""Cost of the work per byte: what stays in the scan, what is done for all rows of a batch at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from marquee.llm import bpe_automaton, repeats
from marquee.llm import textnum as tn


# -- op2 --------------------------------------------------------------------
def test_texts_that_lose_nothing_stay_in_the_jvm(spark):
    long = "".join(f"{i:07d}" for i in range(100))
    rows = [(1, long + " x"), (2, "y " + long), (3, "short é"), (4, None), (5, "z" * 399), (None, "")]
    out = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1  # the removal itself
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], list(r["spans"])) for r in out.collect()}
    assert got == {1: (702, 700, 1, [0, 700]), 2: (702, 700, 1, [2, 702]), 3: (8, 0, 0, []), 4: (0, 0, 0, []), 5: (399, 0, 0, []), None: (0, 0, 0, [])}


def test_intervals_are_joined_for_all_rows_of_a_batch():
    pack = lambda *x: [a << 32 | z for a, z in x]
    gone = pa.array([pack((5, 9), (0, 4), (4, 6)), None, pack((10, 20), (12, 15), (21, 30)), [], pack((0, 3))], pa.list_(pa.int64()))
    start, stop, row = repeats._joined(gone)
    assert list(zip(row.tolist(), start.tolist(), stop.tolist(), strict=True)) == [(0, 0, 9), (2, 10, 20), (2, 21, 30), (4, 0, 3)]
    assert [len(x) for x in repeats._joined(gone.slice(1, 1))] == [0, 0, 0]
    assert repeats._joined(gone.slice(2, 1))[0].tolist() == [10, 21]


def test_blocks_of_many_runs_equal_those_of_one_run_at_a_time():
    rng = np.random.default_rng(3)
    names, rows = ["k1", "k2", "at", "first", "last", "gram", "from", "to", "bytes"], []
    for i in range(400):
        first, windows, reach = int(rng.integers(0, 50)), int(rng.integers(1, 190)), int(rng.integers(0, 100))
        at = first + int(rng.integers(0, 200))
        rows.append((i, -i, at, first, first + windows - 1, i % 7, reach, reach + int(rng.integers(0, 300)), rng.bytes(windows + repeats.LENGTH - 1)))
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 3, pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    batch = lambda part: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part, strict=True), kinds, strict=True)], names=names)
    for width in (repeats.BLOCK, 1):
        split = repeats._split(width)
        whole = [r for b in split(iter([batch(rows)])) for r in b.to_pylist()]
        single = [r for row in rows for b in split(iter([batch([row])])) for r in b.to_pylist()]
        drop = lambda r: {k: v for k, v in r.items() if k != "all" or (r["c1"] % width == 0 and r["c2"] - r["c1"] == width - 1)}
        assert len(whole) > 400 and [drop(r) for r in whole] == [drop(r) for r in single]
        # against plain loops
        for r in whole[::97]:
            raw = np.frombuffer(rows[r["k1"]][8], np.uint8)
            base, p = r["at"] - r["first"], tn.prefix(raw)
            full = tn.range_hash(p, np.array([base - r["c2"]]), np.array([base - r["c1"] + repeats.LENGTH]))
            if r["c2"] - r["c1"] == width - 1:
                assert full.view(np.int64)[0] == r["all"]


# -- op9 --------------------------------------------------------------------
def test_a_walk_looks_up_few_labels_and_steps_back_where_it_must():
    t = bpe_automaton.WordTokenizer(bpe_automaton.word_bpe_path())
    automaton, looked = t.automaton, []

    class Counted(dict):
        def get(self, key, default=None):
            looked.append(key)
            return dict.get(self, key, default)

    automaton.spelled = Counted(automaton.spelled)
    words = ["thedoran", "leonier", "byrestthed", "airément", "inthenhaing", "erteälich", "pfschieauen", "日本語", "a" * 3000, "ab" * 1000, "x"]
    for w in words:
        ids = t.word(w)
        assert "".join(t.labels[i] for i in np.frombuffer(ids, "<u4")).endswith("</w>") and len(looked) <= 40 * len(w.encode())
        looked.clear()
    # a small automaton: the longest label at the start is a dead end, and nothing but the merges' order decides
    small = bpe_automaton.Automaton(list("abc"), [("b", "c"), ("a", "b"), ("ab", "c")])
    shown = lambda text: [small.labels[x] for x in small.tokens("".join(chr("abc".index(c)) for c in text))]
    assert shown("abc") == ["a", "bc"] and shown("ab") == ["ab"] and shown("ababc") == ["ab", "a", "bc"] and shown("") == []
