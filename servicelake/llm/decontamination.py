"""Operator 4: benchmark decontamination by greedy string tiling.

Runs of ``min_match`` words are the seeds (an item of fewer words has one, all
its words).  A document is compared with a benchmark item only if they share a
seed, and only if the item's words under shared seeds could reach the threshold.
Then, again and again, the longest common runs of words not yet in a tile are
found by running Karp-Rabin and marked as tiles; an item whose words lie in
tiles up to the threshold is a leak, in whatever order its passages stand.

The hashes of all runs of a length follow from one running sum, whatever the
length, and a shorter run is common where a longer one is; so the next length
is found by halving.  Of equal hashes one place after the other is taken, never
each with each.

The benchmark is dealt into slices of bounded size; each slice's index is
broadcast and the documents are scanned once for each slice, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelake.llm.common import chunks, documents

_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)

SCHEMA = (
    "doc_id long, item_id long, item_words long, tiled_words long, n_tiles long, longest_tile long, coverage double, "
    "tiles array<struct<item_word: long, doc_word: long, words: long>>"
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) words: runs of letters, digits and characters beyond ASCII."""
    return text.translate(_WORDS).split()


class Runs:
    """Karp-Rabin hashes of the runs of any length in ids of words, modulo 2 ** 64, from running sums."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        powers = np.full(len(ids) + 1, _BASE, np.uint64)
        backs = np.full(len(ids) + 1, _BACK, np.uint64)
        powers[0] = backs[0] = 1
        self.powers, backs = np.cumprod(powers), np.cumprod(backs)
        # a run from i of n words: the sum of word[i + k] * base ** -k, for k under n
        mixed = (ids.astype(np.uint64) + np.uint64(7)) * np.uint64(0xC2B2AE3D27D4EB4F)
        mixed ^= mixed >> np.uint64(29)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * backs[: len(ids)], dtype=np.uint64)])

    def hashes(self, n: int, at: np.ndarray) -> np.ndarray:
        """Of the runs of ``n`` words that begin at the places ``at``."""
        return (self.sums[at + n] - self.sums[at]) * self.powers[at]


def window_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every run of ``n`` ids."""
    return Runs(ids).hashes(n, np.arange(max(0, len(ids) - n + 1)))


def tile(item: np.ndarray, doc: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (item start, document start, words) of the tiles, longest first.

    ``item`` and ``doc`` are word ids; a word foreign to the item has the id
    -1.  Ties go to the earlier place in the item, then in the document.
    """
    tiles: list[tuple[int, int, int]] = []
    a, b = Runs(item), Runs(doc)
    free_item, free_doc = np.ones(len(item), bool), doc >= 0
    longest = len(item)
    while longest >= min_match:
        # of the document only words under seeds that are free on both sides can be in a tile
        at_doc = _free_windows(free_doc, min_match)
        seeds = at_doc[np.isin(b.hashes(min_match, at_doc), a.hashes(min_match, _free_windows(free_item, min_match)))]
        if not len(seeds):
            break
        free_doc = _covered(seeds, min_match, len(doc))
        low, high = min_match, longest + 1  # runs of ``low`` words are common, those of ``high`` are not
        while high - low > 1:
            n = (low + high) // 2
            at_doc = _free_windows(free_doc, n)
            if len(at_doc) and np.isin(b.hashes(n, at_doc), a.hashes(n, _free_windows(free_item, n))).any():
                low = n
            else:
                high = n
        tiles += _mark(a, b, free_item, free_doc, low)
        longest = low - 1  # common runs of ``low`` words are all taken
    return tiles


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """The places of runs of ``n`` from distinct ``starts``."""
    steps = np.zeros(size + 1, np.int64)
    steps[starts] += 1
    steps[starts + n] -= 1
    return np.cumsum(steps[:-1]) > 0


def _free_windows(free: np.ndarray, n: int) -> np.ndarray:
    """Starts of the runs of ``n`` places that are all free."""
    if len(free) < n:
        return np.empty(0, np.int64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(taken[n:] == taken[:-n])


def _mark(a: Runs, b: Runs, free_item: np.ndarray, free_doc: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Tiles of ``n`` words, the longest that are common: each place of the item takes the first equal one that is free.

    All runs looked at are free at first and of one length, so a tile marked
    here overlaps one if and only if it holds its first or last place.
    """
    at_item, at_doc = _free_windows(free_item, n), _free_windows(free_doc, n)
    hashes = b.hashes(n, at_doc)
    order = np.argsort(hashes, kind="stable")
    hashes, at_doc = hashes[order], at_doc[order]
    own = a.hashes(n, at_item)
    begin, end = np.searchsorted(hashes, own), np.searchsorted(hashes, own, side="right")
    some = np.flatnonzero(end > begin)
    passed: dict[int, int] = {}  # by the first of equal hashes: those before are taken
    tiles = []
    for i, first, last in zip(at_item[some].tolist(), begin[some].tolist(), end[some].tolist(), strict=True):
        if not (free_item[i] and free_item[i + n - 1]):
            continue
        k = passed.get(first, first)
        while k < last and not (free_doc[at_doc[k]] and free_doc[at_doc[k] + n - 1]):
            k += 1
        passed[first] = k
        while k < last:
            d = int(at_doc[k])
            if free_doc[d] and free_doc[d + n - 1] and np.array_equal(a.ids[i : i + n], b.ids[d : d + n]):
                tiles.append((i, d, n))
                free_item[i : i + n] = False
                free_doc[d : d + n] = False
                break
            k += 1  # other words of the same hash
    return tiles


class Index:
    """Seeds and words of one slice of the benchmark; ``seeds`` by their number of words."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], min_match: int):
        self.ids = [i for i, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        self.items = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], np.int64) for _, words in items]
        self.seed_words = [min(min_match, len(x)) for x in self.items]
        self.seeds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in sorted(set(self.seed_words)):
            own = [k for k, size in enumerate(self.seed_words) if size == n]
            hashes = [np.unique(window_hashes(self.items[k], n)) for k in own]
            owners = np.repeat(own, [len(h) for h in hashes])
            flat = np.concatenate(hashes)
            order = np.argsort(flat, kind="stable")
            self.seeds[n] = flat[order], owners[order]

    def leaks(self, text: bytes, threshold: float) -> list[tuple]:
        """Items that lie in the text up to the threshold: (item index, tiles)."""
        get = self.vocabulary.get
        doc = np.array([get(w, -1) for w in words_of(text)], np.int64)
        runs = None
        found = []
        for n, (seeds, of) in self.seeds.items():
            at = _free_windows(doc >= 0, n)
            if not len(at):
                continue
            runs = runs or Runs(doc)
            hits = np.unique(runs.hashes(n, at))
            first, last = np.searchsorted(seeds, hits), np.searchsorted(seeds, hits, side="right")
            shared = last > first
            hits = hits[shared]
            owners = {k for x, y in zip(first[shared].tolist(), last[shared].tolist(), strict=True) for k in of[x:y].tolist()}
            for k in owners:
                item = self.items[k]
                under = _covered(np.flatnonzero(np.isin(window_hashes(item, n), hits)), n, len(item))
                if under.sum() < threshold * len(item):
                    continue
                tiles = tile(item, np.where(np.isin(doc, item), doc, -1), n)
                if sum(t[2] for t in tiles) >= threshold * len(item):
                    found.append((k, tiles))
        return sorted(found, key=lambda f: f[0])


def benchmark_slices(benchmark: DataFrame, min_match: int, slice_bytes: int = 8 << 20) -> Iterator[Index]:
    """Indexes of slices of the benchmark, each of about ``slice_bytes`` of text whatever the benchmark's size.

    Items without words have no seed and never leak; equal items are kept apart.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // slice_bytes)
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        rows = sorted(((r[0], words_of(r[1].encode())) for r in part.toLocalIterator()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield Index([r for r in rows if r[1]], min_match)


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, threshold: float = 0.5) -> DataFrame:
    """One row for each document and benchmark item of which at least ``threshold`` of the words lie in tiles.

    A tile has at least ``min_match`` words; an item of fewer words leaks where
    all of them stand in a row, and one without words never.  Null text counts as empty and leaks nothing; null ids stay null; repeated
    rows are judged each for itself; other columns are ignored; an empty
    benchmark or table gives no rows.
    """
    rows = documents(docs)
    found = rows.sparkSession.createDataFrame([], SCHEMA)
    for index in benchmark_slices(benchmark, min_match):
        shared = rows.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch, texts in chunks(batches, "text", 1 << 23):
                out = [
                    (doc_id, own.ids[k], len(own.items[k]), sum(t[2] for t in tiles), len(tiles), tiles[0][2], sum(t[2] for t in tiles) / len(own.items[k]), [{"item_word": i, "doc_word": d, "words": n} for i, d, n in tiles])
                    for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True)
                    for k, tiles in own.leaks(text, threshold)
                ]
                if out:
                    kinds = [pa.int64()] * 6 + [pa.float64(), pa.list_(pa.struct([("item_word", pa.int64()), ("doc_word", pa.int64()), ("words", pa.int64())]))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["doc_id", "item_id", "item_words", "tiled_words", "n_tiles", "longest_tile", "coverage", "tiles"])

        found = found.unionByName(rows.mapInArrow(run, SCHEMA))
    return found


def remove_leaks(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark item leaks; null text stays."""
    for index in benchmark_slices(benchmark, min_match):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for batch, texts in chunks(batches, "text", 1 << 23):
                yield batch.filter(pa.array([not (t and own.leaks(t, threshold)) for t in texts]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
