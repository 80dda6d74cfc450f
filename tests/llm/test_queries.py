import duckdb
import pytest

from servicelake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    found = QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    got, right = ([tuple(r) for r in rows] for rows in (found.select(*columns).collect(), want.fetchall()))
    assert sorted(got, key=repr) == sorted(right, key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_answers_for_every_document(spark, name):
    found = QUERIES[name](spark, SF)
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    ids = found.select("doc_id").distinct()
    if name.startswith("op4_"):
        assert found.count() and ids.join(documents, "doc_id", "left_anti").count() == 0
    else:
        assert ids.count() == documents.count()
