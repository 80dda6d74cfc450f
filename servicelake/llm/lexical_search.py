"""Ranked lexical search: the best documents for each item of a query table, exactly.

A document's vector has, for each term, the term's weight times its saturated
frequency; an item's score is the sum over its terms.  A first pass turns texts
into the frequencies of those terms that some item has.  Weights are counted
over all documents.  Then each task builds ball trees over runs of documents and
searches them for every item; a tree's size is bounded by what it takes in
memory.  No document is shuffled; what leaves a tree are its best documents for
an item, and of these only such as reach the score that the best of a sample of
all documents already have, so there are few however many trees there are.

Items go in rounds of bounded size; the broadcast terms of a round are bounded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from servicelake.llm.ball_tree import BallTree
from servicelake.llm.common import chunks, documents, forget, release, written

#: Terms: runs of ASCII letters and digits and of characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

#: Items, and terms of items, that one round searches for at most (an item that alone has more is a round's only one, mostly).
ROUND_ITEMS, ROUND_TERMS = 1024, 1 << 16

#: Bytes of the means of one tree, and its documents.
TREE_BYTES, TREE_DOCS, LEAF = 64 << 20, 1 << 14, 64

#: Documents, about, whose best scores are the first thresholds.  They spare work; results do not depend on them.
SAMPLE_DOCS = 4096

VECTORS = "doc_id long, n long, terms binary, counts binary"
HITS = "item int, item_id long, doc_id long, score long"


@dataclass
class Round:
    """Items and their terms; a term's place in ``vocabulary`` is its number."""

    items: list[tuple[int | None, list[bytes]]]
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    queries: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self) -> None:
        for _, terms in self.items:
            self.queries.append(np.array(sorted(self.vocabulary.setdefault(t, len(self.vocabulary)) for t in terms), np.int64))


@dataclass
class Weights:
    """Counts over all documents: with a term, and terms with repeats; and each term's weight."""

    n_docs: int
    n_terms: int
    weight: np.ndarray

    def values(self, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """A document's score for each of its terms: weight times saturated frequency, in integers."""
        if len(n) and int(n.max()) * 50 * self.n_docs < 1 << 62:
            m = 50 + 50 * n * self.n_docs // self.n_terms
        else:  # beyond 64 bits on the way
            m = np.array([50 + 50 * int(x) * self.n_docs // self.n_terms for x in n], np.int64)
        return self.weight[terms] * (1_000_000_000 * counts // (1000 * counts + 20 * np.repeat(m, sizes)))


def item_rounds(items: DataFrame) -> Iterator[Round]:
    """Rounds of the distinct items, dealt by a hash; the driver holds one round."""
    text = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0))))
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), terms.alias("terms")).distinct().where(F.size("terms") > 0)
    total = rows.agg(F.count("*").alias("items"), F.sum(F.size("terms")).alias("terms")).first()
    n = max(-(-total["items"] // ROUND_ITEMS), -(-(total["terms"] or 0) // ROUND_TERMS))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(n)) == k) if n > 1 else rows
        found = sorted(((r[0], [t.encode() for t in r[1]]) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        if found:
            yield Round(found)


def _vectors(docs: DataFrame, asked: Round) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with a term: its length and how often it has each term of the round."""
    shared = docs.sparkSession.sparkContext.broadcast(asked.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.get
        for batch, texts in chunks(batches, "text", 4 << 20):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                words = text.translate(_SPLIT).split()
                if words:
                    met = np.array([t for t in map(known, words) if t is not None], np.int64)
                    terms, counts = np.unique(met, return_counts=True)
                    out.append((doc_id, len(words), terms.astype("<i4").tobytes(), counts.astype("<i4").tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["doc_id", "n", "terms", "counts"])

    return documents(docs).mapInArrow(run, VECTORS)


def _weights(vectors: DataFrame, n_terms: int) -> Weights:
    """Document frequencies of the round's terms, added up in each task, then over the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_terms + 2, np.int64)
        for batch in batches:
            met = np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<i4")
            counts[:n_terms] += np.bincount(met, minlength=n_terms)
            counts[n_terms] += batch.num_rows
            counts[n_terms + 1] += batch.column("n").to_numpy().sum()
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(counts[own], pa.int64())], names=["term", "c"])

    frequency = np.zeros(n_terms + 2, np.int64)
    for row in vectors.select("n", "terms").mapInArrow(run, "term long, c long").groupBy("term").agg(F.sum("c").alias("c")).collect():
        frequency[row["term"]] = row["c"]
    n = int(frequency[n_terms])
    weight = [math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in frequency[:n_terms].tolist()]
    return Weights(n, int(frequency[n_terms + 1]), np.array(weight, np.int64))


def _tree_docs(width: int) -> int:
    """Documents of a tree whose means (two nodes for each leaf) take ``TREE_BYTES`` at most."""
    nodes = TREE_BYTES // (8 * max(width, 1))
    return max(LEAF, min(TREE_DOCS, LEAF * (nodes // 4)))


def _search(vectors: DataFrame, asked: Round, weights: Weights, least: np.ndarray, k: int) -> DataFrame:
    """(item, item_id, doc_id, score): of each tree, the ``k`` best documents for each item that reach ``least``."""
    width = len(asked.vocabulary)
    at_once = _tree_docs(width)
    shared = vectors.sparkSession.sparkContext.broadcast((asked.queries, [i for i, _ in asked.items], weights, least))

    def best_of(batches: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        queries, item_ids, weights, least = shared.value
        table = pa.Table.from_batches(batches)
        blobs = table.column("terms").to_pylist()
        sizes = np.array([len(b) // 4 for b in blobs], np.int64)
        terms = np.frombuffer(b"".join(blobs), "<i4")
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), "<i4").astype(np.int64)
        missing = table.column("doc_id").is_null().to_numpy()
        ids = table.column("doc_id").fill_null(0).to_numpy()
        tree = BallTree(terms, weights.values(table.column("n").to_numpy(), sizes, terms, counts), sizes, width, LEAF)
        out: list[list] = [[], [], [], []]
        for item, query in enumerate(queries):
            rows, scores, _ = tree.search(query, k, int(least[item]))
            order = np.lexsort((ids[rows], missing[rows], -scores))[:k]
            out[0] += [item] * len(order)
            out[1] += [item_ids[item]] * len(order)
            out[2] += [None if gone else i for i, gone in zip(ids[rows[order]].tolist(), missing[rows[order]].tolist(), strict=True)]
            out[3] += scores[order].tolist()
        release()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["item", "item_id", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            first = 0
            while first < batch.num_rows:
                part = batch.slice(first, at_once - size)
                held.append(part)
                size += part.num_rows
                first += part.num_rows
                if size >= at_once:
                    yield best_of(held)
                    held, size = [], 0
        if held:
            yield best_of(held)

    return vectors.where(F.octet_length("terms") > 0).mapInArrow(run, HITS)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _first_thresholds(vectors: DataFrame, asked: Round, weights: Weights, k: int) -> np.ndarray:
    """For each item a score that its ``k`` best documents reach: the ``k``-th best of a sample (1 where it has fewer)."""
    least = np.ones(len(asked.items), np.int64)
    every = max(1, weights.n_docs // SAMPLE_DOCS)
    sample = vectors.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(every)) == 0)
    for row in _ranked(_search(sample, asked, weights, least, k), k).where(F.col("rank") == k).select("item", "score").collect():
        least[row["item"]] = row["score"]
    return least


def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents for each item, of those with a score above 0.

    Terms, weights and scores are those of the module's constants and
    ``Weights``; all are whole numbers but for a weight's logarithm.  Equal
    scores rank by document id, null ids last.  Null texts have no terms.
    Every row of ``docs`` is a document, also where ids or rows repeat; of
    ``items``, rows with the same id and the same terms are one item, and items
    without terms find nothing.  Other columns are ignored; an empty table on
    either side gives no rows.
    """
    spark = docs.sparkSession
    found = None
    for asked in item_rounds(items):
        vectors = written(_vectors(docs, asked), "term-vectors")
        weights = _weights(vectors, len(asked.vocabulary))
        least = _first_thresholds(vectors, asked, weights, k)
        hits = written(_ranked(_search(vectors, asked, weights, least, k), k).select("item_id", "rank", "doc_id", "score"), "ranked")
        forget(vectors)
        found = hits if found is None else found.unionByName(hits)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if found is None else found
