"""URL rules by host suffix and path prefix, by Spark's own functions only.

A rule names a host and the beginning of a path; it fits that host and all its
subdomains.  Each url is expanded into the expressions a rule could be written
as: suffixes of its host (as many labels as some rule has) followed by
beginnings of its path (as long as some rule's).  Expressions and rules meet by
the first four bytes of their SHA-256, the whole digest confirms them, and of
the rules that fit the longest decides.

What a url's verdict depends on is its last labels and the beginning of its
path alone, as far as rules reach.  Urls are therefore first reduced to the
distinct such heads; a host that holds a third of all pages is a few of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from servicelake.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Hexadecimal digits of a digest by which expressions and rules first meet.
SHORT = 8

#: A key of more than this share of the rows is looked up by broadcast; so many such keys there can be at most.
HOT_KEYS = 256

RULE = "host string, path string, verdict string"


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case, other letters untouched."""
    return F.translate(text, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case; then up to ``?``, ``#`` or the end.

    Both are empty where ``url`` is null or has no ``://``.
    """
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return lowered(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def labels_of(host: Column) -> Column:
    return F.size(F.split(host, "\\."))


def digest_of(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def known_rules(rules: DataFrame) -> DataFrame:
    """(short, found): rules by the beginning of their digest; ``found`` holds digest, rule and verdict of each.

    Hosts are taken in lower case.  Null hosts or paths count as empty, and a
    rule without a host fits nothing.  Of rules that stand twice with different
    verdicts, ``block`` holds.
    """
    clean = rules.select(lowered(F.coalesce("host", F.lit(""))).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").where("host <> ''")
    text = F.concat("host", "path")
    own = clean.groupBy(text.alias("rule")).agg(F.max("verdict").alias("verdict"))
    own = own.select(digest_of(F.col("rule")).alias("digest"), "rule", "verdict")
    return own.groupBy(F.left("digest", F.lit(SHORT)).alias("short")).agg(F.collect_list(F.struct("digest", "rule", "verdict")).alias("found"))


def look_up(rows: DataFrame, table: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``table``, which has at most one row for each ``key``; rows without one stay, with nulls.

    ``counts`` (key, n) holds how many of ``rows`` have a key.  Keys of more
    than one of ``HOT_KEYS`` parts of all rows are at most that many, so their
    rows of ``table`` are broadcast and the rows that ask for them never move;
    the others are shuffled by key, none of them large.
    """
    least = counts.agg((F.sum("n") / F.lit(HOT_KEYS)).alias("least"))
    hot = counts.where(F.col("n") > least.scalar()).select(key)
    answers = hot.join(table, key, "left")
    here = rows.join(F.broadcast(answers), key, "inner")
    rest = rows.join(F.broadcast(hot), key, "left_anti").join(table, key, "left")
    return here.unionByName(rest)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has host, path and verdict (allow or block).  A rule fits a url
    whose host is the rule's or ends in a dot and the rule's, and whose path
    starts with the rule's, letter by letter.  Of those that fit, the longest
    text (host and path together) wins; of equally long ones, which then differ
    in where the host ends, the one with the longer host.  Where none fits,
    ``rule`` is null and ``verdict`` is ``default``.

    Null urls and urls without ``://`` have an empty host and path, which no
    rule fits.  Repeated rows, null ids and other columns stay as they are;
    columns named like one of the four new ones are replaced.
    """
    host, path = host_and_path(F.col(url))
    reach = rules.select(lowered(F.coalesce("host", F.lit(""))).alias("host"), F.length(F.coalesce("path", F.lit(""))).alias("long")).where("host <> ''")
    reach = reach.select(labels_of(F.col("host")).alias("labels"), "long").agg(
        F.coalesce(F.max("labels"), F.lit(0)).alias("labels"),
        F.coalesce(F.max("long"), F.lit(0)).alias("long"),
        F.array_sort(F.collect_set(F.struct("labels", "long"))).alias("shapes"),
    )
    most_labels, longest = (reach.select(c).scalar() for c in ("labels", "long"))

    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    parsed = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("page"), host.alias("host"), path.alias("path"))
    ends = F.split("host", "\\.")
    tail = F.array_join(F.slice(ends, F.greatest(F.size(ends) - most_labels, F.lit(0)) + 1, F.size(ends)), ".")
    parsed = parsed.withColumn("tail", tail).withColumn("head", F.left("path", longest))
    parsed = parsed.withColumn("key", digest_of(F.concat("tail", "head")))

    heads = written(parsed.groupBy("key", "tail", "head").agg(F.count("*").alias("n")), "url-heads")
    expressions = written(_expressions(heads, reach), "url-expressions")
    short_counts = expressions.groupBy("short").agg(F.count("*").alias("n"))
    met = look_up(expressions, written(known_rules(rules), "url-rules"), "short", short_counts).where("found IS NOT NULL")
    right = met.select("key", "host_long", F.explode(F.filter("found", lambda r: r["digest"] == F.col("digest"))).alias("r"))
    best = F.max(F.struct(F.length("r.rule").alias("long"), F.col("host_long"), F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict")))
    verdicts = written(right.groupBy("key").agg(best.alias("best")).select("key", "best.rule", "best.verdict"), "url-verdicts")

    judged = look_up(parsed.drop("tail", "head"), verdicts, "key", heads.select("key", "n"))
    return judged.select("page.*", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _expressions(heads: DataFrame, reach: DataFrame) -> DataFrame:
    """(key, digest, short, host_long): the expressions of each head in the shapes (labels of the host, length of the path) that rules have."""
    ends = F.split("tail", "\\.")
    host = F.array_join(F.slice(ends, F.size(ends) - F.col("shape.labels") + 1, F.col("shape.labels")), ".")
    rows = heads.where("tail <> ''").select("key", "tail", "head", reach.select("shapes").scalar().alias("shapes"))
    rows = rows.select("key", "tail", "head", F.explode("shapes").alias("shape"))
    rows = rows.where((F.col("shape.labels") <= F.size(ends)) & (F.col("shape.long") <= F.length("head")))
    rows = rows.select("key", F.length(host).alias("host_long"), digest_of(F.concat(host, F.left("head", F.col("shape.long")))).alias("digest"))
    return rows.select("key", "digest", F.left("digest", F.lit(SHORT)).alias("short"), "host_long")


def rule_rows(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A table of (host, path, verdict), made without Python workers."""
    fields = T.StructType([T.StructField(c, T.StringType()) for c in ("host", "path", "verdict")])
    if not rules:
        return spark.range(0).select(*[F.lit(None).cast("string").alias(f.name) for f in fields])
    one = spark.range(1)
    return reduce(DataFrame.unionByName, [one.select(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in rules])
