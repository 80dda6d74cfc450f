"""Operator 5: language-model scores by stupid backoff.

Counts of all n-grams of the corpus (orders 1 to ``order``) are a relation
partitioned by hash; the n-grams that each block of documents explodes into are
joined to it, and a document's score is the sum over its words.  A document is
scored against the rest of the corpus: its own occurrences are taken from each
count, for otherwise no n-gram would ever be unseen.

score(w | context) is count(context w) / count(context) where the n-gram is
seen elsewhere, else ``alpha`` times the score for the context without its
first word; a word seen nowhere else scores as if it occurred once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelake.llm.blocks import Block, decode_keys, encode_keys, gathered, make_blocks, pack, partition_of, read_block, text_bytes, unpack
from servicelake.llm.common import WordHashes, ngram_hashes

SCHEMA = "doc_id long, n_words long, score double, mean_score double, n_unseen long, hits array<long>"
#: Bytes of text for each hash partition: some four million n-grams.
PART_BYTES = 16 << 20
#: Bytes that tell n-grams of a partition apart.
KEY_BYTES = 6


def _words(block: Block, known: WordHashes) -> list[np.ndarray]:
    return [known.of(t.lower().split()) for t in block.texts()]


def _grams(words: list[np.ndarray], order: int) -> list[np.ndarray]:
    """For each order the hashes of all n-grams of all documents, end to end; an order has a hash space of its own."""
    return [np.concatenate([ngram_hashes(w, n) for w in words] or [np.empty(0, np.uint64)]) for n in range(1, order + 1)]


def _distinct(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(grams), return_counts=True)


def score_documents(docs: DataFrame, order: int = 3, alpha: float = 0.4, block_bytes: int = 8 << 20) -> DataFrame:
    """One row for each document: ``score`` (the sum of log scores), ``mean_score`` for each word, ``n_unseen`` words
    seen nowhere else, and ``hits``: the words whose longest n-gram seen elsewhere has 1, 2, ... words.

    Words are split at ASCII white space, ASCII lower case.  Null or wordless
    texts score 0 over no words, with a null mean.  Repeated rows are documents
    of their own, and so see each other; null ids stay null; other columns are
    ignored; an empty table gives no rows.
    """
    parts = max(1, -(-text_bytes(docs) // PART_BYTES))
    blocks = make_blocks(docs, block_bytes)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for row in batch.to_pylist():
                block = read_block(row)
                words = _words(block, known)
                keys, counts = _distinct(_grams(words, order))
                cuts = np.searchsorted(partition_of(keys, parts), np.arange(parts + 1))
                out = [(p, block.block, encode_keys(keys[a:b], p, parts, KEY_BYTES), pack(counts[a:b].astype("<u4").tobytes()), sum(map(len, words)) if not p else 0) for p, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if b > a]
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["part", "block", "codes", "counts", "words"])

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        codes = [decode_keys(x, KEY_BYTES) for x in frame["codes"]]
        counts = np.concatenate([np.frombuffer(unpack(x), "<u4") for x in frame["counts"]]).astype(np.int64)
        flat = np.concatenate(codes)
        order_ = np.argsort(flat, kind="stable")
        ordered = flat[order_]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        sums = np.add.reduceat(counts[order_], first)
        total = np.empty(len(flat), np.int64)
        total[order_] = np.repeat(sums, np.diff(np.append(first, len(flat))))
        ends = np.cumsum([len(c) for c in codes])
        replies = [pack(total[e - len(c) : e].astype("<u4").tobytes()) for c, e in zip(codes, ends.tolist(), strict=True)]
        return pd.DataFrame({"block": frame["block"], "part": frame["part"], "answer": replies})

    asked = blocks.mapInArrow(ask, "part long, block long, codes binary, counts binary, words long")
    replies = gathered(asked.groupBy("part").applyInPandas(answer, "block long, part long, answer binary"))
    total = _corpus_words(blocks)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for row in batch.to_pylist():
                block = read_block(row)
                words = _words(block, known)
                grams = _grams(words, order)
                _, index = np.unique(np.concatenate(grams), return_inverse=True)
                given = sorted((r["part"], r["answer"]) for r in row["replies"] or [])
                counts = np.concatenate([np.frombuffer(unpack(a), "<u4") for _, a in given] or [np.empty(0, "<u4")]).astype(np.int64)
                starts = np.cumsum([0, *map(len, grams)])[:-1]
                sizes = np.array([len(w) for w in words], np.int64)
                before = [start + np.cumsum(np.maximum(sizes - k, 0)) - np.maximum(sizes - k, 0) for k, start in enumerate(starts)]
                rows = [_document(int(size), [index[b[d] : b[d] + max(size - k, 0)] for k, b in enumerate(before)], counts, total, alpha) for d, size in enumerate(sizes)]
                sizes, scores, unseen, hits = zip(*rows, strict=True)
                columns = [
                    pa.array(block.ids, mask=block.missing),
                    pa.array(sizes, pa.int64()),
                    pa.array(scores, pa.float64()),
                    pa.array([s / n if n else None for s, n in zip(scores, sizes, strict=True)], pa.float64()),
                    pa.array(unseen, pa.int64()),
                    pa.array(hits, pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "score", "mean_score", "n_unseen", "hits"])

    return blocks.join(replies, "block", "left").mapInArrow(score, SCHEMA)


def _corpus_words(blocks: DataFrame) -> int:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = sum(len(t.split()) for row in batch.to_pylist() for t in read_block(row).texts())
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return blocks.mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0


def _document(size: int, grams: list[np.ndarray], counts: np.ndarray, total: int, alpha: float) -> tuple[int, float, int, list[int]]:
    """(words, score, unseen words, hits by order) of one document, from its n-grams' places among ``counts``."""
    order = len(grams)
    if not size:
        return 0, 0.0, 0, [0] * order
    # count of each n-gram elsewhere, by the place of its last word
    elsewhere = []
    for k, own in enumerate(grams):
        distinct, inverse, here = np.unique(own, return_inverse=True, return_counts=True)
        elsewhere.append(np.concatenate([np.zeros(min(k, size), np.int64), (counts[distinct] - here)[inverse]]))
    rest_words = total - size
    unigram = np.maximum(elsewhere[0], 1) / max(rest_words, 1)
    value, found = np.log(unigram), (elsewhere[0] > 0).astype(np.int64)
    back = np.log(alpha)
    for n in range(2, order + 1):
        seen = elsewhere[n - 1] > 0
        context = np.concatenate([[0], elsewhere[n - 2][:-1]])
        at = np.flatnonzero(seen)
        shorter = value.copy()
        value = np.where(np.arange(size) >= n - 1, shorter + back, shorter)  # at a text's start the context is no longer
        value[at] = np.log(elsewhere[n - 1][at] / context[at])
        found[at] = n
    return size, float(value.sum()), int((found == 0).sum()), [int((found == n).sum()) for n in range(1, order + 1)]
