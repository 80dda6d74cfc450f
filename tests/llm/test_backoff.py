import math
from collections import Counter

import pytest

from servicelake.llm import backoff as op

from .helpers import clashing, corpus, frame


def brute(rows, order=3, alpha=0.4):
    docs = [(r[0], "".join(c.lower() if c.isascii() else c for c in r[1] or "").encode().split()) for r in rows]
    grams = lambda w, n: [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
    total = Counter(g for _, w in docs for n in range(1, order + 1) for g in grams(w, n))
    size = sum(len(w) for _, w in docs)
    out = []
    for doc_id, w in docs:
        own = Counter(g for n in range(1, order + 1) for g in grams(w, n))
        rest = lambda g: total[g] - own[g]
        score, hits, unseen = 0.0, [0] * order, 0
        for i in range(len(w)):
            back = 1.0
            for n in range(min(order, i + 1), 0, -1):
                g = tuple(w[i - n + 1 : i + 1])
                if rest(g):
                    score += math.log(back * rest(g) / (rest(g[:-1]) if n > 1 else size - len(w)))
                    hits[n - 1] += 1
                    break
                if n > 1:
                    back *= alpha
            else:
                unseen += 1
                score += math.log(back / max(size - len(w), 1))
        out.append((doc_id, len(w), score, unseen, hits))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(op, "PART_BYTES", 1 << 12)
    rows = corpus(seed)
    found = op.score_documents(clashing(frame(spark, rows), "part", "block"), block_bytes=4000).collect()
    want = brute(rows)
    found = sorted(((r["doc_id"], r["n_words"], r["score"], r["n_unseen"], list(r["hits"])) for r in found), key=lambda r: (str(r[0]), r[1]))
    want = sorted(want, key=lambda r: (str(r[0]), r[1]))
    assert [(a, b, d, e) for a, b, _, d, e in found] == [(a, b, d, e) for a, b, _, d, e in want]
    assert all(math.isclose(x[2], y[2], rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(found, want))


def test_empty_table_and_empty_texts(spark):
    assert op.score_documents(frame(spark, [])).count() == 0
    row = op.score_documents(frame(spark, [(1, None, None, None, None)])).collect()[0]
    assert (row["n_words"], row["score"], row["mean_score"]) == (0, 0.0, None)
