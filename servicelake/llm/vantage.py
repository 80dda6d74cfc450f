"""Operator 9: nearest neighbours by inner product with vantage-point trees, one for each shard, under common upper levels.

A metric is needed, so vectors get one coordinate more: with M the largest
norm, x becomes (x, sqrt(M^2 - |x|^2)) and a query (q, 0).  Then
|x' - q'|^2 = |q|^2 + M^2 - 2 q.x, so the nearest point has the largest inner
product.  A tree node holds a vantage point and the bounds of its two
children's distances from it.  A child is passed over if the triangle
inequality puts all of it beyond the k-th best so far:
|d(q, v) - bound| * factor > tau; a factor of 1 is exact, a larger one searches
less.

The upper levels are one tree over a bounded sample of the vectors.  Its leaves
are cells; every vector goes down to a cell, and a cell's vectors are dealt by
hash into shards of bounded size.  Each shard's tree is built once and stored.
A query is first searched in its own cell, which gives it a k-th best score, then
in those cells alone that the bounds of the upper levels let hold a better one.
Blocks of queries for one cell meet its shards in a join, and the answers are
merged by score.  Scores are sums in the order of the components, in double
precision.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from servicelake.llm.common import written

RESULT = "query_id long, vec_id long, score double"


class Tree:
    """A vantage-point tree over distinct vectors; equal ones share a point and keep their ids, ascending."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, radius: float, leaf: int = 512, seed: int = 5):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        self.points, inverse = np.unique(vectors, axis=0, return_inverse=True)
        inverse = inverse.ravel()
        by_point = np.argsort(inverse, kind="stable")
        self.repeat = np.bincount(inverse)
        self.ids = np.split(ids[by_point], np.cumsum(self.repeat)[:-1])
        extra = np.sqrt(np.maximum(radius**2 - (self.points**2).sum(1), 0.0))
        self.lifted = np.concatenate([self.points, extra[:, None]], 1)
        self.radius, self.leaf = radius, leaf
        self.rng = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(self.points)))

    def _distances(self, own: np.ndarray, v: int) -> np.ndarray:
        return np.sqrt(((self.lifted[own] - self.lifted[v]) ** 2).sum(1))

    def _build(self, own: np.ndarray):
        """A leaf is its points; an inner node (vantage point, inner bounds, outer bounds, inner, outer)."""
        if len(own) <= self.leaf:
            return own
        v = int(own[self.rng.integers(len(own))])
        rest = own[own != v]
        d = self._distances(rest, v)
        half = len(rest) // 2
        order = np.argsort(d, kind="stable")
        near, far = order[:half], order[half:]
        return v, (d[near].min(), d[near].max()), (d[far].min(), d[far].max()), self._build(rest[near]), self._build(rest[far])

    def search(self, queries: np.ndarray, k: int, factor: float, limit: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, point), by query: the points that hold its k best ids or tie with them, by an estimate of the scores.

        Queries go down the tree together; at each node those are left whose
        bounds let the node hold one of their k best.  ``limit``: the score of
        each query's k-th best elsewhere; points with less are of no use.
        """
        n = len(queries)
        lifted = np.concatenate([queries, np.zeros((n, 1))], 1)
        base = (queries**2).sum(1) + self.radius**2
        slack = 1e-9 * (1.0 + base)
        # squared distance of the k-th best so far: of ids, so a point counts as often as it has ids
        best = np.full((n, k), np.inf)
        if limit is not None:
            best[:, :] = np.maximum(base - 2.0 * limit, 0.0)[:, None]
        seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def visit(own: np.ndarray, who: np.ndarray) -> np.ndarray:
            square = np.maximum(base[who, None] - 2.0 * (queries[who] @ self.points[own].T), 0.0)
            many = square if len(own) == self.repeat[own].sum() else np.repeat(square, np.minimum(self.repeat[own], k), axis=1)
            best[who] = np.partition(np.concatenate([best[who], many], 1), k - 1, axis=1)[:, :k]
            row, column = np.nonzero(square <= (best[who, k - 1] + slack[who])[:, None])
            seen.append((who[row], own[column], square[row, column]))
            return square

        stack = [(self.root, np.arange(n), np.zeros(n))]
        while stack:
            node, who, bound = stack.pop()
            open_ = bound * factor <= np.sqrt(best[who, k - 1] + slack[who])
            who = who[open_]
            if not len(who):
                continue
            if isinstance(node, np.ndarray):
                if len(node):
                    visit(node, who)
                continue
            v, inner, outer, a, b = node
            d = np.sqrt(visit(np.array([v]), who)[:, 0])
            to_a = np.maximum(np.maximum(inner[0] - d, d - inner[1]), 0.0)
            to_b = np.maximum(np.maximum(outer[0] - d, d - outer[1]), 0.0)
            nearer = d <= (inner[1] + outer[0]) / 2
            # the child on the query's side first, so its bound is tight when the other is looked at
            for mask in (nearer, ~nearer):
                first, second = ((a, to_a), (b, to_b)) if mask is nearer else ((b, to_b), (a, to_a))
                if mask.any():
                    stack.append((second[0], who[mask], second[1][mask]))
                    stack.append((first[0], who[mask], first[1][mask]))
        if not seen:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        who, own, square = (np.concatenate(c) for c in zip(*seen, strict=True))
        kept = square <= best[who, k - 1] + slack[who]
        order = np.argsort(who[kept], kind="stable")
        return who[kept][order], own[kept][order]


class Cells:
    """The upper levels: vantage points and median distances over a sample; the leaves are cells, numbered from ``first``."""

    def __init__(self, sample: np.ndarray, radius: float, depth: int, first: int, least: int = 8, seed: int = 7):
        self.radius, self.first, self.n = radius, first, 0
        self.rng = np.random.default_rng(seed)
        self.root = self._build(self.lift(sample), depth, least)

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        return np.concatenate([vectors, np.sqrt(np.maximum(self.radius**2 - (vectors**2).sum(1), 0.0))[:, None]], 1)

    def _build(self, points: np.ndarray, depth: int, least: int):
        """A cell's number, or (vantage point, median distance, inner, outer)."""
        if depth and len(points) >= 2 * least:
            v = points[self.rng.integers(len(points))]
            d = _from(points, v)
            middle = float(np.median(d))
            if (d > middle).any():
                return v, middle, self._build(points[d <= middle], depth - 1, least), self._build(points[d > middle], depth - 1, least)
        self.n += 1
        return self.first + self.n - 1

    def of(self, lifted: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        out = np.empty(len(lifted), np.int64)
        stack = [(self.root, np.arange(len(lifted)))]
        while stack:
            node, own = stack.pop()
            if isinstance(node, int):
                out[own] = node
                continue
            v, middle, inner, outer = node
            near = _from(lifted[own], v) <= middle
            stack += [(inner, own[near]), (outer, own[~near])]
        return out

    def admitted(self, lifted: np.ndarray, reach: np.ndarray, factor: float) -> Iterator[tuple[int, np.ndarray]]:
        """Each cell with the points that have something of it within their ``reach``, relaxed by the factor."""
        stack = [(self.root, np.arange(len(lifted)))]
        while stack:
            node, own = stack.pop()
            if isinstance(node, int):
                yield node, own
                continue
            v, middle, inner, outer = node
            d = _from(lifted[own], v)
            stack += [(inner, own[(d - middle) * factor <= reach[own]]), (outer, own[(middle - d) * factor <= reach[own]])]


def _from(points: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - v) ** 2).sum(1))


def inner_products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed component by component, in order: one rounding for one pair of vectors, wherever computed."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out = out + x[:, j] * q[:, j]
    return out


def _best(tree: Tree, own: np.ndarray, scores: np.ndarray, query_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the ``k`` best points, best first, ties to the smaller id, but for the query's own."""
    many = tree.repeat[own]
    if len(own) and (many > 1).any():
        # as far as the score that holds the k-th id beside the query's own; of one point the least ids
        last = scores[min(np.searchsorted(np.cumsum(many), k + 1), len(own) - 1)]
        own, scores = own[scores >= last], scores[scores >= last]
        held = [tree.ids[p][: k + 1] for p in own.tolist()]
        ids, scores = np.concatenate(held), np.repeat(scores, [len(h) for h in held])
    else:
        ids = np.array([tree.ids[p][0] for p in own.tolist()], np.int64)
    order = np.lexsort((ids, -scores))
    order = order[ids[order] != query_id][:k]
    return ids[order], scores[order]


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as doubles) without vectors that are null, empty, zero, or hold null or non-finite components; rows without an id are left out."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return rows.where("vec_id is not null and embedding is not null and size(embedding) > 0").where(~bad & F.exists("embedding", lambda x: x != 0))


def _by_length(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of batches with vectors of one length, stacked."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            sizes = np.diff(part.column("embedding").offsets.to_numpy())
            for size in np.unique(sizes).tolist():
                own = part.filter(pa.array(sizes == size))
                yield own, own.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _upper_levels(usable: DataFrame, n: int, radius: float, shard_rows: int, sample_rows: int) -> dict[int, Cells]:
    """By length of the vectors, from about ``sample_rows`` of all: as many levels as make cells of ``shard_rows``, if the sample is large enough."""
    every = max(1, n // sample_rows)
    # twice the sample's rows are never met by a hash but for chance; the limit bounds the driver's memory, whatever the ids
    rows = usable.where(F.pmod(F.xxhash64("vec_id", F.lit(9)), F.lit(every)) == 0).limit(2 * sample_rows).select("embedding").toArrow()
    sample: dict[int, list[np.ndarray]] = {}
    for batch in rows.to_batches():
        for _, vectors in _by_length([batch]):
            sample.setdefault(vectors.shape[1], []).append(vectors)
    out, first = {}, 0
    for size, held in sorted(sample.items()):
        # rows in order, so that the levels do not depend on the order in which they came
        points = np.unique(np.concatenate(held), axis=0)
        out[size] = Cells(points, radius, max(0, int(np.ceil(np.log2(max(1, n / shard_rows))))), first)
        first += out[size].n
    return out


def _cell_of_length(size: int) -> int:
    """The one cell of vectors of a length that the sample does not hold."""
    return -size


def _dealt(rows: DataFrame, most: int, name: str) -> DataFrame:
    """Rows of (cell, vec_id, ...) with the number ``name`` of a group of their cell: groups of about ``most`` rows, by hash."""
    counts = rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(most)).alias("groups"))
    return rows.join(counts, "cell").withColumn(name, F.pmod(F.xxhash64("vec_id"), F.col("groups"))).drop("groups")


def _stored_trees(celled: DataFrame, radius: float, leaf: int, shard_rows: int) -> DataFrame:
    """(cell, shard, tree): each shard's tree, built once."""

    def build(own, frame: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(frame["vec_id"].to_numpy(np.int64), np.stack(frame["embedding"].to_numpy()), radius, leaf)
        return pd.DataFrame({"cell": [own[0]], "shard": [own[1]], "tree": [pickle.dumps(tree, protocol=5)]})

    dealt = _dealt(celled, shard_rows, "shard")
    return written(dealt.groupBy("cell", "shard").applyInPandas(build, "cell long, shard long, tree binary"), "trees")


def _blocks(asks: DataFrame, block_rows: int) -> DataFrame:
    """(cell, block, query_ids, query_vectors, limits) of queries (cell, vec_id, embedding, score)."""

    def pack(own, frame: pd.DataFrame) -> pd.DataFrame:
        held = np.stack(frame["embedding"].to_numpy()).astype("<f8").tobytes()
        return pd.DataFrame({
            "cell": [own[0]], "block": [own[1]], "query_ids": [frame["vec_id"].to_numpy("<i8").tobytes()],
            "query_vectors": [held], "limits": [frame["score"].to_numpy("<f8").tobytes()],
        })

    dealt = _dealt(asks, block_rows, "block")
    return dealt.groupBy("cell", "block").applyInPandas(pack, "cell long, block long, query_ids binary, query_vectors binary, limits binary")


def _found(trees: DataFrame, blocks: DataFrame, k: int, factor: float) -> DataFrame:
    """(query_id, vec_id, score): of each shard the ``k`` best of each query of its cell, as far as they reach the query's limit."""
    work = trees.join(blocks, "cell").repartition("cell", "shard", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in ("tree", "query_ids", "query_vectors", "limits")}
                tree = pickle.loads(row["tree"])
                ids, limits = np.frombuffer(row["query_ids"], "<i8"), np.frombuffer(row["limits"], "<f8")
                asked = np.frombuffer(row["query_vectors"], "<f8").reshape(len(ids), -1)
                out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                for at in range(0, len(ids), 512):
                    # one more than k, for the query's own row may be among them
                    some = asked[at : at + 512]
                    who, own = tree.search(some, k + 1, factor, limits[at : at + 512])
                    scores = inner_products(tree.points[own], some[who])
                    order = np.lexsort((-scores, who))
                    who, own, scores = who[order], own[order], scores[order]
                    cuts = np.searchsorted(who, np.arange(len(some) + 1)).tolist()
                    for q, a, b in zip(range(len(some)), cuts[:-1], cuts[1:], strict=True):
                        best, values = _best(tree, own[a:b], scores[a:b], int(ids[at + q]), k)
                        out.append((np.full(len(best), ids[at + q]), best, values))
                if out:
                    columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    return work.mapInArrow(run, RESULT)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    factor: float = 1.0,
    shard_rows: int = 8192,
    block_rows: int = 2048,
    leaf: int = 512,
    sample_rows: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's ``k`` nearest vectors by inner product, nearest first.

    Ties go to the smaller vec_id; a query's own row is no candidate; fewer
    candidates give fewer rows.  Vectors that are null, empty or zero or hold
    null or non-finite components take no part, and neither do queries of that
    kind or rows without an id.  Rows are told apart by vec_id; of rows that
    repeat one, the vector least in order stands.  Vectors of another length
    than a query are no candidates of it.

    ``sample_rows``: about so many vectors (twice as many at most) fit the upper
    levels, on the driver; all are indexed.  A sample that does not suit the
    data costs time and, with a factor of 1, nothing else.
    """
    unique = lambda rows: _usable(rows).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    usable = written(unique(vectors), "vectors")
    asked = written(unique(queries), "queries")
    n, radius = usable.agg(F.count(F.lit(1)), F.max(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)))).first()
    spark = vectors.sparkSession
    if not n or asked.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    radius = float(radius)
    upper = _upper_levels(usable, n, radius, shard_rows, sample_rows)
    types = "cell long, vec_id long, embedding array<double>"

    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, points in _by_length(batches):
            size = points.shape[1]
            cells = upper[size].of(upper[size].lift(points)) if size in upper else np.full(len(points), _cell_of_length(size))
            yield pa.RecordBatch.from_arrays([pa.array(cells), rows.column("vec_id"), rows.column("embedding")], names=["cell", "vec_id", "embedding"])

    def lifted(points: np.ndarray) -> np.ndarray:
        return np.concatenate([points, np.zeros((len(points), 1))], 1)

    def own_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, points in _by_length(batches):
            size = points.shape[1]
            cells = upper[size].of(lifted(points)) if size in upper else np.full(len(points), _cell_of_length(size))
            arrays = [pa.array(cells), rows.column("vec_id"), rows.column("embedding"), pa.array(np.full(len(points), -np.inf))]
            yield pa.RecordBatch.from_arrays(arrays, names=["cell", "vec_id", "embedding", "score"])

    def other_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, points in _by_length(batches):
            size = points.shape[1]
            if size not in upper:
                continue
            limits = rows.column("score").to_numpy(zero_copy_only=False)
            base = (points**2).sum(1) + radius**2
            reach = np.sqrt(np.maximum(base - 2.0 * limits, 0.0) + 1e-9 * (1.0 + base))
            reach += 1e-9 * (1.0 + reach)
            own = upper[size].of(lifted(points))
            for c, who in upper[size].admitted(lifted(points), reach, factor):
                who = pa.array(who[own[who] != c])
                if len(who):
                    some = rows.take(who)
                    arrays = [pa.array(np.full(len(who), c)), some.column("vec_id"), some.column("embedding"), some.column("score")]
                    yield pa.RecordBatch.from_arrays(arrays, names=["cell", "vec_id", "embedding", "score"])

    trees = _stored_trees(usable.mapInArrow(cell, types), radius, leaf, shard_rows)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = lambda rows: rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    near = written(best(_found(trees, _blocks(asked.mapInArrow(own_cell, types + ", score double"), block_rows), k, factor)), "near")
    kth = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "score")
    limited = asked.join(kth, "vec_id", "left").select("vec_id", "embedding", F.coalesce("score", F.lit(float("-inf"))).alias("score"))
    far = _found(trees, _blocks(limited.mapInArrow(other_cells, types + ", score double"), block_rows), k, factor)
    return best(near.drop("rank").unionByName(far)).select("query_id", "rank", "vec_id", "score")
