import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from servicelake.llm import lexical_search as op
from servicelake.llm.ball_tree import BallTree

from .helpers import clashing, corpus, frame

TERM = re.compile(op.TERM)


def terms_of(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, k=50):
    bags = [(d, terms_of(t)) for d, t, *_ in docs]
    bags = [(d, len(w), Counter(w)) for d, w in bags if w]
    n_docs, n_terms = len(bags), sum(n for _, n, _ in bags)
    df = Counter(t for _, _, bag in bags for t in bag)
    out = []
    for item, asked in {(i, tuple(sorted(set(terms_of(t))))) for i, t in items}:
        scored = []
        for d, n, bag in bags:
            m = 50 + (50 * n * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in asked if t in bag)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, r + 1, None if gone else d, -s) for r, (s, gone, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def vectors(rng, n, width, most=12):
    sizes = rng.integers(1, most, n)
    terms = np.concatenate([rng.choice(width, s, replace=False) for s in sizes]).astype(np.int32)
    values = rng.integers(0, 10**10, len(terms))
    return terms, values, sizes


@pytest.mark.parametrize("seed", range(6))
def test_tree_finds_what_comparing_all_finds(seed):
    rng = np.random.default_rng(seed)
    width = int(rng.integers(12, 60))
    terms, values, sizes = vectors(rng, int(rng.integers(1, 700)), width)
    if seed % 2:  # many equal rows, so many ties
        terms, values, sizes = np.tile(terms[: sizes[0]], len(sizes)), np.tile(values[: sizes[0]] % 3, len(sizes)), np.full(len(sizes), sizes[0])
    tree = BallTree(terms, values, sizes, width, leaf=5)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    for _ in range(25):
        query = rng.choice(width, int(rng.integers(1, 9)), replace=False)
        scores = np.zeros(len(sizes), np.int64)
        np.add.at(scores, rows, values * np.isin(terms, query))
        k, least = int(rng.integers(1, 40)), int(rng.choice([1, 5 * 10**9]))
        found, got, _ = tree.search(query, k, least)
        limit = max(least, np.sort(scores)[-min(k, len(scores))])
        want = np.flatnonzero(scores >= limit)
        assert sorted(found.tolist()) == want.tolist()
        assert (got == scores[found]).all()


def test_bounds_are_bounds_and_prune():
    rng = np.random.default_rng(9)
    centres = [rng.choice(400, 12, replace=False) for _ in range(40)]
    rows = [(centres[k % 40], 10**9 + rng.integers(0, 10**7, 12)) for k in range(4000)]
    tree = BallTree(np.concatenate([t for t, _ in rows]), np.concatenate([v for _, v in rows]), np.full(4000, 12), 400, leaf=50)
    visited = []
    for centre in centres:
        bounds = tree.bounds(centre)
        for node, (own, terms, values, starts) in tree.leaves.items():
            assert np.add.reduceat(values * np.isin(terms, centre), starts).max() <= bounds[node]
        visited.append(tree.search(centre, 10)[2])
    assert np.mean(visited) < 0.2 * len(tree.leaves)


def items_of(seed):
    rng = random.Random(seed)
    words = [w for _, t, *_ in corpus(seed) for w in (t or "").split()]
    out = [(k, " ".join(rng.choices(words, k=rng.randint(1, 40)))) for k in range(20)]
    return out + [(100, None), (101, ""), (102, "... !"), (103, "word that no document has zzzzqq"), (None, "bara kete"), (1, "bara the"), out[0], (104, "the " * 50_000), (105, "É é ÉA bara\x7fkete\x00mili")]


@pytest.mark.parametrize("limits", [None, (3, 40)])
def test_against_brute_force(spark, monkeypatch, limits):
    if limits:  # many rounds
        monkeypatch.setattr(op, "ROUND_ITEMS", limits[0])
        monkeypatch.setattr(op, "ROUND_TERMS", limits[1])
        monkeypatch.setattr(op, "TREE_DOCS", 64)
        monkeypatch.setattr(op, "SAMPLE_DOCS", 10)
    docs = corpus(4, n=150)
    docs += [(900 + k, docs[10][1], None, None, None) for k in range(80)]  # ties beyond the best 50
    docs.append((2000, "bara kete " * 120_000, None, None, None))
    items = items_of(4)
    table = spark.createDataFrame(items, "item_id long, text string")
    got = op.search(clashing(frame(spark, docs), "n", "terms", "counts", "score"), clashing(table, "terms", "rank"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = frame(spark, corpus(1)), spark.createDataFrame([(1, "bara")], "item_id long, text string")
    assert op.search(docs.limit(0), items).count() == 0
    assert op.search(docs, items.limit(0)).count() == 0
    assert op.search(docs.select("doc_id", (docs["text"].substr(1, 0)).alias("text")), items).count() == 0


def test_lengths_beyond_64_bits():
    weights = op.Weights(10**12, 10**15, np.array([3]))
    assert weights.values(np.array([10**9]), np.array([1]), np.array([0]), np.array([7])).tolist() == [3 * (7 * 10**9 // (7000 + 20 * (50 + 50 * 10**9 * 10**12 // 10**15)))]
