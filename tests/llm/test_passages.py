"""Shared passages against plain counting: every window, every cover, texts longer than one piece."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import passages, repeats
from marquee.llm.scratch import ship_package


def by_hand(rows, words):
    """rows: (id, text) → words of each row that windows found in another row cover."""
    seen = {}
    split = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for _, t in rows]
    for k, w in enumerate(split):
        for i in range(len(w) - words + 1):
            seen.setdefault(tuple(w[i : i + words]), set()).add(rows[k])
    out = []
    for w in split:
        hit = set()
        for i in range(len(w) - words + 1):
            if len(seen[tuple(w[i : i + words])]) > 1:
                hit.update(range(i, i + words))
        out.append(len(hit))
    return out


def counted(spark, rows, words, gram):
    df = repeats.keyed(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    ship_package(spark)
    found = passages.shared_passages(df, words, gram)
    got = df.join(found, ["k1", "k2"], "left").select("doc_id", "text", F.coalesce("n_passage_words", F.lit(0)).alias("n")).collect()
    return {(r["doc_id"], r["text"]): r["n"] for r in got}


@pytest.mark.parametrize("piece", [1 << 20, 64])
def test_shared_passages_against_hand(spark, monkeypatch, piece):
    monkeypatch.setattr(passages, "_WINDOWS", piece)
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(14))
    rows = []
    for i in range(60):
        w = [rng.choice("abcdefghijklmnop") + str(rng.randrange(3)) for _ in range(rng.randrange(0, 60))]
        if i % 3 == 0:
            w.insert(rng.randrange(len(w) + 1), passage.upper() if i % 2 else passage.replace(" ", "\n "))
        rows.append((i, " ".join(w)))
    rows += [(100, None), (101, ""), (102, passage), (103, passage + " " + passage), (104, " ".join(["x"] * 40)), (105, rows[1][1]), (105, rows[2][1]),
             (106, " ".join(f"q{i}" for i in range(500))), (107, "start " + " ".join(f"q{i}" for i in range(100, 400))), (None, passage + " tail")]
    got = counted(spark, rows, 8, 4)
    for (d, t), n in zip(rows, by_hand(rows, 8), strict=True):
        assert got[(d, t or "")] == n, (d, n)
    assert got[(106, rows[-3][1])] == 300 and got[(104, rows[-6][1])] == 0


def test_rows_equal_in_id_and_text_are_one_document(spark):
    text = " ".join(f"w{i}" for i in range(30))
    assert counted(spark, [(1, text), (1, text)], 8, 4) == {(1, text): 0}
    assert counted(spark, [(1, text), (2, text)], 8, 4) == {(1, text): 30, (2, text): 30}
    assert counted(spark, [], 8, 4) == {}


def test_repeats_tell_of_short_passages(spark):
    passage = " ".join(f"w{i}" for i in range(51))  # under 400 bytes
    rows = [(1, "alpha beta " + passage), (2, passage + " gamma"), (3, " ".join(f"v{i}" for i in range(80)))]
    assert len(passage) < repeats.LENGTH
    got = {r["doc_id"]: r for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), with_passages=True).collect()}
    assert [got[k]["n_passage_words"] for k in (1, 2, 3)] == [51, 51, 0] and all(r["n_removed"] == 0 for r in got.values())


@pytest.mark.parametrize("width", [1, 2, 3, 5, 8, 26])
def test_least_of_every_run(width):
    x = np.random.default_rng(width).integers(0, 1000, 200).astype(np.uint64)
    assert (passages.least(x, width) == np.lib.stride_tricks.sliding_window_view(x, width).min(1)).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_repetitive_texts_against_hand(spark, seed):
    """Two letters only: the same grams stand in many runs, in one text and across texts."""
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 70)))) for i in range(12)]
    rows += [(50, "a " * 90), (51, "a " * 40 + "b " + "a " * 40), (52, "a b " * 30), (53, "c " * 50), (54, rows[3][1] + " c c c " + rows[4][1])]
    got = counted(spark, rows, 12, 5)
    for (d, t), n in zip(rows, by_hand(rows, 12), strict=True):
        assert got[(d, t)] == n, (d, n)
