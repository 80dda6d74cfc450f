import hashlib
import random
import time

import numpy as np
import pytest

from servicelake.llm import suffix_dedup as op
from servicelake.llm import suffix_sort

from .helpers import clashing, corpus, frame


def brute(rows, length):
    first = {}
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        for k in range(len(data) - length + 1):
            if doc_id is not None:
                w = data[k : k + length]
                first[w] = min(first.get(w, doc_id), doc_id)
    out = []
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if doc_id is not None and first[data[k : k + length]] < doc_id:
                gone[k : k + length] = b"\1" * length
        spans = len([s for s in bytes(gone).split(b"\0") if s])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("rule", [op.Rule(), op.Rule(hot=2), op.Rule(length=20, gram=9, hot=5)])
@pytest.mark.parametrize("seed", [1, 4])
def test_matches_brute_force(spark, rule, seed, monkeypatch):
    monkeypatch.setattr(op, "SHARD_BYTES", 1 << 12)
    monkeypatch.setattr(op, "PART_BYTES", 1 << 13)
    rows = corpus(seed)
    found = op.digest(op.remove_repeats(clashing(frame(spark, rows), "block", "part"), rule, block_bytes=3000))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, rule.length)


def test_overlaps_periods_and_hot_passages(spark):
    rng = random.Random(2)
    common = "".join(rng.choice("abcde ") for _ in range(90))
    rows = [(k, f"{k}" * 7 + common * (1 + k % 3) + "xy" * k, None, None, None) for k in range(40)]
    rows += [(100 + k, "ab" * (20 + k), None, None, None) for k in range(30)]
    for rule in (op.Rule(), op.Rule(hot=4)):
        found = op.digest(op.remove_repeats(frame(spark, rows), rule, block_bytes=1500))
        assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, 50)


def test_empty_table(spark):
    assert op.remove_repeats(frame(spark, [])).count() == 0
    assert op.digest(op.remove_repeats(frame(spark, [(1, None, None, None, None)]))).collect()[0][:4] == (1, 0, 0, 0)


def test_suffix_arrays_and_common_prefixes(monkeypatch):
    rng = np.random.default_rng(0)
    for few, many in ((64, 2048), (1, 2048), (64, 2), (1, 1)):  # by arrays, one by one, and both
        monkeypatch.setattr(suffix_sort, "FEW", few)
        monkeypatch.setattr(suffix_sort, "MANY_SYMBOLS", many)
        for _ in range(300):
            symbols = int(rng.integers(1, 6))
            s = rng.integers(0, symbols, int(rng.integers(0, 70)))
            assert suffix_sort.suffix_array(s, symbols).tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    for _ in range(100):
        s = rng.integers(97, 99, int(rng.integers(1, 90))).astype(np.uint8)
        room = np.minimum(np.arange(len(s), 0, -1), int(rng.integers(1, 40)))
        sa = suffix_sort.suffix_array(s.astype(np.int64), 256)
        common = suffix_sort.permuted_lcp(s, sa, room)
        for a, b in zip(sa[1:], sa[:-1]):
            m = 0
            while m < min(room[a], room[b]) and s[a + m] == s[b + m]:
                m += 1
            assert common[a] == m


def test_text_of_some_hundred_kilobytes_is_sorted_by_recursion(monkeypatch):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    data = " ".join(rng.choice(words) for _ in range(60_000)).encode()
    levels = []
    whole = suffix_sort.suffix_array
    monkeypatch.setattr(suffix_sort, "suffix_array", lambda s, symbols: levels.append((len(s), symbols)) or whole(s, symbols))
    sa = suffix_sort.suffix_array(np.frombuffer(data, np.uint8).astype(np.int64), 256)
    assert len(levels) > 2 and any(symbols > suffix_sort.MANY_SYMBOLS for _, symbols in levels)
    assert all(2 * b[0] <= a[0] for a, b in zip(levels, levels[1:]))
    assert sorted(sa.tolist()) == list(range(len(data)))
    assert all(data[a : a + 400] < data[b : b + 400] for a, b in zip(sa[:-1].tolist(), sa[1:].tolist()))


def test_long_runs_of_one_byte_take_linear_time():
    seconds = []
    for n in (250_000, 1_000_000):
        begun = time.process_time()
        whole, some = op.judge([b"x" + b"a" * n, b"y" + b"a" * n], np.array([1, 1], np.uint64), np.array([1, 2]), 50)
        seconds.append(time.process_time() - begun)
        assert not whole.any() and len(some[0]) == 0 and some[1].tolist() == list(range(1, n - 48))
    assert seconds[1] < 4 * 2.5 * seconds[0]
