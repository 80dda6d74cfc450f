import numpy as np
import pytest

from servicelake.llm import jaccard_join as op
from servicelake.llm.graph import components

from .helpers import clashing, corpus, frame


def shingles(text, k=3):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, num, den):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(s), least.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets))), key=str)


@pytest.mark.parametrize("rule", [op.Rule(), op.Rule(frequent_from=1, block=4), op.Rule(num=60, frequent_from=2, block=3)])
@pytest.mark.parametrize("seed", [1, 2])
def test_matches_all_pairs(spark, rule, seed):
    rows = corpus(seed)
    found = op.near_duplicates(clashing(frame(spark, rows), "node", "n", "component", "signature"), rule)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, rule.num, rule.den)


def test_near_copies_without_their_original(spark):
    """Copies of which each differs from all others in other places: links form chains, or none at all."""
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(130)]
    rows = []
    for k in range(60):
        words = list(base)
        for at in rng.choice(len(words), rng.integers(1, 4), replace=False):
            words[at] = f"x{k}{at}"
        rows.append((k, " ".join(words), "en", "s", 0))
    for rule in (op.Rule(frequent_from=4, block=8), op.Rule(num=93, frequent_from=2, block=16)):
        found = op.near_duplicates(frame(spark, rows), rule)
        assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, rule.num, rule.den)


def test_prefixes_share_a_signature():
    """Any two sets at the threshold share a signature, whatever tokens are called rare."""
    rng = np.random.default_rng(5)
    rule = op.Rule(num=80)
    for _ in range(300):
        n = int(rng.integers(2, 150))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64) * np.uint64(3))
        b = a.copy()
        while True:
            c = np.unique(np.concatenate([np.delete(b, rng.integers(len(b))), rng.integers(0, 1 << 62, int(rng.integers(0, 2))).astype(np.uint64)])) if len(b) > 1 else b
            shared = len(np.intersect1d(a, c))
            if len(b) < 2 or not rule.links(shared, len(a), len(c)):
                break
            b = c
        share = rng.choice([0.0, 0.3, 1.0])
        rare = lambda s: (s % np.uint64(1000)).astype(float) / 1000 >= share
        assert len(np.intersect1d(op.signatures(a, rare(a), rule), op.signatures(b, rare(b), rule)))


def test_bitmap_bound_is_a_bound():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 62, int(rng.integers(1, 900))).astype(np.uint64))
        b = np.unique(np.concatenate([a[: rng.integers(0, len(a) + 1)], rng.integers(0, 1 << 62, int(rng.integers(0, 900))).astype(np.uint64)]))
        assert op.apart(op.parity(a), op.parity(b)) <= len(np.setxor1d(a, b))


def test_empty_table_and_components(spark):
    assert op.near_duplicates(frame(spark, [])).count() == 0
    assert op.near_duplicates(frame(spark, [(7, None, None, None, None)])).collect() == [(7, 0, 7)]
    links = spark.createDataFrame([(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 100), (5, 5)], "a long, b long")
    for task_links in (500_000, 7):
        found = {r["node"]: r["component"] for r in components(links.repartition(5), task_links).collect()}
        assert found == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_keep_one_with_clashing_columns(spark):
    """Names that the operator uses itself stay what they are."""
    rows = corpus(2)
    names = ["__no_id", "__id", "__key", "no_id", "id", "key", "id_", "a.b"]
    docs = frame(spark, rows)
    plain = {(r["doc_id"], r["text"]) for r in op.keep_one(docs).collect()}
    kept = op.keep_one(clashing(docs, *names))
    assert kept.columns == [*docs.columns, *names]
    found = kept.collect()
    assert {(r["doc_id"], r["text"]) for r in found} == plain
    assert {r[n] for r in found for n in names} == {"other"}
