import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from servicelake.llm import decontamination as op

from .helpers import clashing, corpus, frame, prose


UPPER = str.maketrans({chr(c): chr(c - 32) for c in range(97, 123)})


def slow_tiles(item, doc, least):
    """Greedy string tiling by comparing all places: the longest match first, the earliest in the item, then the document."""
    tiles, a_free, b_free = [], [True] * len(item), [True] * len(doc)
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while i + n < len(item) and d + n < len(doc) and a_free[i + n] and b_free[d + n] and item[i + n] == doc[d + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        n, i, d = best
        if n < least:
            return tiles
        tiles.append((i, d, n))
        a_free[i : i + n] = [False] * n
        b_free[d : d + n] = [False] * n


def test_tiles_match_the_slow_way():
    rng = np.random.default_rng(2)
    for _ in range(150):
        item = rng.integers(0, int(rng.integers(2, 9)), int(rng.integers(3, 25)))
        doc = rng.integers(0, 9, int(rng.integers(0, 60)))
        for _ in range(int(rng.integers(0, 3))):
            at, n = int(rng.integers(0, len(item))), int(rng.integers(1, 12))
            doc = np.insert(doc, int(rng.integers(0, len(doc) + 1)), item[at : at + n])
        for least in (3, 5):
            known = np.where(np.isin(doc, item), doc, -1)
            fast = op.tile(item, known, least)
            slow = slow_tiles(item.tolist(), known.tolist(), least)
            assert fast == slow


def test_equal_hashes_of_other_words_make_no_tile(monkeypatch):
    monkeypatch.setattr(op.Runs, "hashes", lambda self, n, at: np.zeros(len(at), np.uint64))
    rng = np.random.default_rng(4)
    for _ in range(40):
        item, doc = rng.integers(0, 3, 12), rng.integers(0, 3, 30)
        tiles = op.tile(item, doc, 3)
        assert all((item[i : i + n] == doc[d : d + n]).all() for i, d, n in tiles)
        assert [t[2] for t in tiles] == [t[2] for t in slow_tiles(item.tolist(), doc.tolist(), 3)]


def test_long_repeated_words_take_linear_time():
    item = np.concatenate([np.zeros(1000, np.int64), np.arange(1, 1001)])
    seconds = []
    for n in (50_000, 200_000):
        begun = time.process_time()
        assert op.tile(item, np.zeros(n, np.int64), 5) == [(0, 0, 1000)]
        seconds.append(time.process_time() - begun)
    assert seconds[1] < 4 * 2.5 * seconds[0]


def test_items_of_few_words_leak_as_a_whole(spark):
    docs = frame(spark, [(1, "so Forty-two it is", "en", "s", 1), (2, "two and forty", "en", "s", 1), (3, None, None, None, None), (4, "a b c d e f g", "en", "s", 1)])
    benchmark = bench(spark, [(1, "forty two"), (2, ""), (3, None), (4, "b c d f"), (5, "x a b c d e")])
    assert {(r["doc_id"], r["item_id"]) for r in op.find_leaks(docs, benchmark).collect()} == {(1, 1), (4, 5)}
    assert sorted(r["doc_id"] for r in op.remove_leaks(docs, benchmark).collect()) == [2, 3]


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("slice_bytes", [8 << 20, 300])
def test_verbatim_reordered_and_partial_leaks(spark, slice_bytes, monkeypatch):
    monkeypatch.setattr(op.benchmark_slices, "__defaults__", (slice_bytes,))
    rng = random.Random(8)
    items = [prose(rng, 24).split() for _ in range(12)]
    rows = []
    for k, item in enumerate(items):
        reordered = item[16:] + ["or"] + item[8:16] + ["and"] + item[:8]
        for kind, words in enumerate([item, reordered, item[:9], [w for j, w in enumerate(item) if j % 4 != 3]]):
            rows.append((10 * k + kind, prose(rng, 30) + " " + " ".join(words).translate(UPPER) + "! " + prose(rng, 200), "en", "s", 1))
    rows += [(r[0] + 1000 if r[0] is not None else None, *r[1:]) for r in corpus(9)]
    docs = clashing(frame(spark, rows), "item_id", "tiles")
    benchmark = bench(spark, [(k, " ".join(w)) for k, w in enumerate(items)] + [(None, None), (50, "too short"), (3, " ".join(items[3]))]).withColumn("doc_id", F.lit(1))
    found = op.find_leaks(docs, benchmark).collect()
    want = {(10 * k + kind, k) for k in range(12) for kind in (0, 1)}
    assert {(r["doc_id"], r["item_id"]) for r in found} == want
    assert sum(r["item_id"] == 3 for r in found) == 4  # a repeated item is reported as often as it stands
    reordered = next(r for r in found if (r["doc_id"], r["item_id"]) == (21, 2))
    assert reordered["n_tiles"] == 3 and reordered["coverage"] == 1.0 and reordered["tiled_words"] == reordered["item_words"] == 24
    kept = op.remove_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in rows if r[0] not in {d for d, _ in want})


def test_empty_tables(spark):
    some = bench(spark, [(1, "a b c d e f g")])
    assert op.find_leaks(frame(spark, []), some).count() == 0
    assert op.find_leaks(frame(spark, corpus()), bench(spark, [])).count() == 0
    assert op.remove_leaks(frame(spark, corpus()), bench(spark, [])).count() == len(corpus())
