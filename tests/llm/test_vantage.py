import numpy as np
import pytest
from pyspark.sql import functions as F

from servicelake.llm import vantage as op

from .helpers import clashing


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def usable(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, k):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows if i is not None and usable(v)]
    out = []
    for q, x in good:
        if q % 20 == 0:
            scored = []
            for i, y in good:
                if i != q and len(x) == len(y):
                    s = 0.0
                    for a, b in zip(x, y):
                        s += a * b
                    scored.append((-s, i))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def rows_of(seed, n=700, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    vectors = (centres[rng.integers(6, size=n)] + 0.3 * rng.normal(size=(n, dim))).astype(np.float32)
    vectors[100:260] = vectors[100]  # one very common vector
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(vectors)]
    odd = [None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [float("nan")] + [1.0] * (dim - 1), [float("inf")] + [1.0] * (dim - 1)]
    rows += [(1000 + 20 * k, v, None) for k, v in enumerate(odd)]
    rows += [(None, [1.0] * dim, 1), (2000, [1.0] * 3, 1), (2001, [2.0] * 3, 1)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_factor_one_is_exact(spark, seed):
    rows = rows_of(seed)
    vectors = clashing(table(spark, rows), "shard", "block", "ids")
    found = op.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), shard_rows=150, block_rows=11, leaf=7)
    assert sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()) == brute(rows, 20)


def test_larger_factor_still_recalls_most(spark):
    rows = rows_of(3)
    vectors = table(spark, rows)
    found = {(r[0], r[2]) for r in op.nearest(vectors, vectors.where("vec_id % 20 = 0"), factor=1.3, shard_rows=300).collect()}
    right = {(q, i) for q, _, i, _ in brute(rows, 20)}
    assert len(found & right) >= 0.9 * len(right)


def test_few_or_no_vectors(spark):
    none = table(spark, [])
    assert op.nearest(none, none).count() == 0
    two = table(spark, [(0, [1.0, 2.0], 0), (1, [3.0, -1.0], 0), (1, [3.0, -1.0], 0)])
    assert [tuple(r) for r in op.nearest(two, two.where("vec_id = 0")).collect()] == [(0, 1, 1, 1.0)]


def test_queries_go_only_to_cells_that_their_bounds_admit():
    rng = np.random.default_rng(4)
    centres = 10 * rng.normal(size=(16, 8))
    points = np.repeat(centres, 200, axis=0) + 0.1 * rng.normal(size=(3200, 8))
    radius = float(np.sqrt((points**2).sum(1)).max())
    cells = op.Cells(points[::4], radius, 4, 0)
    lifted = cells.lift(points)
    own = cells.of(lifted)
    assert set(own.tolist()) == set(range(cells.n)) and cells.n > 8
    reach = np.full(len(points), 0.5)
    admitted = {c: set(who.tolist()) for c, who in cells.admitted(lifted, reach, 1.0)}
    near = (lifted**2).sum(1)[:, None] + (lifted**2).sum(1) - 2 * lifted @ lifted.T <= 0.25
    for c, who in admitted.items():
        assert set(np.flatnonzero(near[:, own == c].any(1)).tolist()) <= who
    assert sum(map(len, admitted.values())) < cells.n * len(points) / 4


def test_no_sample_of_a_length_and_more_shards_than_cells(spark):
    rows = rows_of(5)
    vectors = table(spark, rows)
    found = op.nearest(vectors, vectors.where("vec_id % 20 = 0"), shard_rows=40, block_rows=5, leaf=7, sample_rows=60)
    assert sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect()) == brute(rows, 20)
