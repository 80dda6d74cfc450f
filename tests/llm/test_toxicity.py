import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from servicelake.llm import toxicity as op

from .helpers import WORDS, clashing, corpus, frame, prose

BAD = {"en": ["vilexa", "vilexo", "vilexum"], "de": ["grobian", "grobiung", "grobiheit"]}


def labelled(n=500, seed=3):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        lang = rng.choice(["en", "de"])
        toxic = int(rng.random() < 0.25)
        words = prose(rng, rng.randint(3, 80)).split(" ")
        for _ in range(rng.randint(1, 3) if toxic else 0):
            words.insert(rng.randrange(len(words) + 1), rng.choice(BAD[lang]))
        rows.append((k, " ".join(words), lang, "s", toxic))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = labelled()
    docs = frame(spark, rows).withColumn("n_chars", F.length("text").cast("long"))
    labels = spark.createDataFrame([(r[0], 1, r[4]) for r in rows] + [(None, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    return rows, docs, labels


@pytest.fixture(scope="module")
def model(tables):
    _, docs, labels = tables
    return op.train(op.training_rows(docs, labels), buckets=1 << 12, min_steps=250)


def test_held_out_accuracy(tables, model):
    rows, docs, _ = tables
    scores = {r["doc_id"]: r["score"] for r in op.score(clashing(docs, "score"), model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    right = sum((scores[r[0]] >= 0.3) == bool(r[4]) for r in held)
    assert len(held) > 80 and right >= 0.95 * len(held)
    assert all(0 <= s <= 1 for s in scores.values())


def test_held_out_column_is_the_checksum(spark):
    found = spark.range(50).toDF("doc_id").select("doc_id", op.held_out().alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert spark.sql("select cast(null as long) doc_id").select(op.held_out()).first()[0] is False


def test_training_never_sees_held_out_labels(tables):
    rows, docs, labels = tables
    other = labels.withColumn("toxic", F.when(op.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    same = lambda x: sorted(tuple(r) for r in op.training_rows(docs, x).collect())
    assert same(labels) == same(other) and len(same(labels)) == sum(zlib.crc32(str(r[0]).encode()) % 4 != 2 for r in rows)
    assert 0 < op.training_rows(docs, labels, max_train=50).count() <= 60


def test_scores_do_not_depend_on_neighbours_or_length(model):
    texts = [b"", b"one", b"vilexa", " ".join(WORDS * 2000).encode() + b" vilexum", " ".join(WORDS * 2000).encode()]
    scorer = op.Scorer(model)
    together = scorer.scores(texts)
    assert np.allclose(together, [op.Scorer(model).scores([t])[0] for t in texts])
    assert together[3] > 0.3 > together[4]
    # by position, as the filters are defined
    for text in texts[:3]:
        ids = op.words_of(text)
        vocabulary = op.Vocabulary(model.buckets)
        own = vocabulary.of(ids)
        x = model.embedding[vocabulary.rows()[own]].sum(1)
        pooled = [op._convolve(x, model.filters[w]).max(0) if len(x) else np.zeros(model.filters[w].shape[2]) for w in model.widths()]
        logit = np.maximum(np.concatenate(pooled) + model.bias, 0) @ model.out + model.out_bias
        assert np.isclose(scorer.logits([text])[0], logit, atol=1e-4)


def test_filter_keeps_clean_rows_and_odd_ones(spark, model, tables):
    rows, docs, _ = tables
    kept = {r["doc_id"] for r in op.remove_toxic(docs, model).collect()}
    clean = {r[0] for r in rows if not r[4]}
    assert len(kept & clean) >= 0.97 * len(clean) and len(kept - clean) <= 0.05 * len(rows)
    odd = frame(spark, corpus())
    left = op.remove_toxic(clashing(odd, "score"), model)
    assert left.columns == [*odd.columns, "score"]
    assert op.score(odd, model).count() == odd.count()
    assert op.remove_toxic(frame(spark, []), model).count() == 0


def test_without_both_labels(spark):
    model = op.train(spark.createDataFrame([], "text string, lang string, label int"))
    assert op.Scorer(model).scores([b"a", b""]).tolist() == pytest.approx([0.5, 0.5])
    model = op.train(spark.createDataFrame([("a b", None, 0), (None, "en", 1), ("c", "en", None)], "text string, lang string, label int"))
    assert op.Scorer(model).scores([b"a"])[0] < 0.3


def test_threshold_of_best_f1():
    assert op.best_threshold(np.array([0.9, 0.8, 0.4, 0.1]), np.array([1, 1, 0, 0]), 0.3) == pytest.approx(0.6)
    assert op.best_threshold(np.array([0.5, 0.5]), np.array([1, 0]), 0.3) == pytest.approx(0.25)
    assert op.best_threshold(np.array([0.5]), np.array([1]), 0.3) == 0.3


def test_training_reads_whole_texts(monkeypatch):
    rng = np.random.default_rng(3)
    features, emb = rng.integers(0, 40, (30, 2)), rng.normal(size=(40, 5)).astype(np.float32)
    filters = {w: rng.normal(size=(w, 5, 4)).astype(np.float32) for w in (1, 2, 3)}
    for n in (0, 1, 2, 3, 8, 9, 10, 11, 50):
        ids = rng.integers(0, 30, n)
        monkeypatch.setattr(op, "STRETCH", 1 << 14)
        whole = op._pool(ids, emb, features, filters, (1, 2, 3))
        monkeypatch.setattr(op, "STRETCH", 4)
        parts = op._pool(ids, emb, features, filters, (1, 2, 3))
        for w in whole[0]:
            assert np.allclose(whole[0][w], parts[0][w], atol=1e-5) and (whole[1][w] == parts[1][w]).all()


def test_long_texts_train_by_words_anywhere_in_them(spark):
    rng = random.Random(4)
    calm = lambda n: " ".join(rng.choice(["sun", "tree", "road", "house", "river", "stone"]) for _ in range(n))
    rows = [(calm(9000) + " vileword " + calm(9000) if k % 2 else calm(18000), "en", k % 2) for k in range(24)]
    model = op.train(spark.createDataFrame(rows, "text string, lang string, label int"), buckets=1 << 10, min_steps=60)
    low, high = op.Scorer(model).scores([calm(20000).encode(), (calm(15000) + " vileword " + calm(5000)).encode()])
    assert low < 0.3 <= high


def test_labels_that_repeat_or_contradict(spark):
    docs = spark.createDataFrame([(k, f"text {k}", "en") for k in range(8)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, x) for k in range(8) for x in (0, k % 2, 0)], "doc_id long, toxic int")
    found = sorted(tuple(r) for r in op.training_rows(docs, labels).collect())
    want = [(f"text {k}", "en", k % 2) for k in range(8) if zlib.crc32(str(k).encode()) % 4 != 2]
    assert found == sorted(want)
