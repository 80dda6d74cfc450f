import importlib
import sys

import pytest

import corpus_pipeline
from servicelake.llm import packing, queries

from .helpers import corpus, frame

SF = "/root/testdata/sf0.001"


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "jaccard_join", "sentence_dedup", "decontamination", "packing"]
    assert len(queries.QUERIES) == 13 and set(queries.ORACLES) <= set(queries.QUERIES)


def test_stages_give_the_columns_of_documents(spark):
    docs = frame(spark, corpus(6))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert [(f.name, f.dataType) for f in kept.schema] == [(f.name, f.dataType) for f in docs.schema]
        docs = spark.createDataFrame(kept.collect(), docs.schema)
    assert "sequence_id" in corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns


def test_near_duplicates_leave_one_of_each_group(spark):
    from .test_jaccard_join import shingles

    rows = corpus(5)
    kept = corpus_pipeline.near_duplicates(spark, frame(spark, rows), SF).collect()
    left = [shingles(r["text"], 5) for r in kept if shingles(r["text"], 5)]
    similar = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    assert not any(similar(a, b) for i, a in enumerate(left) for b in left[:i])
    whole = [shingles(r[1], 5) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for i in range(len(rows)):
        for j in range(i):
            if whole[i] and whole[j] and similar(whole[i], whole[j]):
                parent[find(i)] = find(j)
    groups = {find(i) for i in range(len(rows)) if whole[i]}
    assert len(left) == len(groups)
    assert sum(not shingles(r["text"], 5) for r in kept) == len({(r[0], r[1]) for r in rows if not shingles(r[1], 5)})


def test_run_equals_its_stages_over_the_given_documents(spark):
    pieces = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
    want = packing.digest(packing.pack(docs)).groupBy("doc_id").sum("length").collect()
    assert sorted(map(tuple, pieces.groupBy("doc_id").sum("length").collect())) == sorted(map(tuple, want))
    assert 0.5 * spark.read.parquet(f"{SF}/documents.parquet").count() < len(want)


@pytest.mark.parametrize("hidden", ["corpus_pipeline", "servicelake.llm"])
def test_the_entry_module_works_without_them(hidden, monkeypatch):
    import __spark_entry__ as entry

    monkeypatch.setitem(sys.modules, hidden, None)
    if hidden == "servicelake.llm":
        for name in [m for m in sys.modules if m.startswith("servicelake.llm.") or m == "corpus_pipeline"]:
            monkeypatch.delitem(sys.modules, name)
        monkeypatch.delattr("servicelake.llm")
    try:
        importlib.reload(entry)
        assert "sla_performance" in entry.queries() and not any(n.startswith("op") and n[2:3].isdigit() for n in entry.queries())
        assert set(entry.oracle_sql()) <= set(entry.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
    assert "pipeline" in entry.queries()
