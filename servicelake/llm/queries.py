"""The registered queries of the operators: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servicelake.llm import backoff, conversation_repair, decontamination, jaccard_join, lexical_search, licenses, packing, sentence_dedup, suffix_dedup, token_files, toxicity, url_rules, vantage
from servicelake.llm.common import read_table, scratch, ship
from servicelake.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(read_table(spark, sf_dir, "documents"), slice_bytes=1 << 24))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(toxicity.training_rows(docs, read_table(spark, sf_dir, "labels")))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = sentence_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_sentences", "n_removed", "removed", "text")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "tokens")
    token_files.write_tokens(read_table(spark, sf_dir, "documents"), path)
    return token_files.catalogue(spark, path)


def op5_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = backoff.score_documents(read_table(spark, sf_dir, "documents"))
    hits = [F.col("hits")[k].alias(f"hits_{k + 1}") for k in range(3)]
    return scored.select("doc_id", "n_words", F.round("score", 6).alias("score"), "n_unseen", *hits)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_vantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return vantage.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents")))


#: The rules by which pages are judged.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge_urls(pages, url_rules.rule_rows(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations")
    return conversation_repair.digest(conversations, conversation_repair.repair(*conversation_repair.damaged(conversations)))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=50)


Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


_OWN: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_toxicity": op2_toxicity,
    "op3_licenses": op3_licenses,
    "op4_decontamination": op4_decontamination,
    "op5_backoff": op5_backoff,
    "op6_token_files": op6_token_files,
    "op7_sentence_dedup": op7_sentence_dedup,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_vantage": op9_vantage,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_url_rules": op11_url_rules,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_lexical_search": op13_lexical_search,
}
QUERIES: dict[str, Query] = {name: _shipped(query) for name, query in _OWN.items()}
