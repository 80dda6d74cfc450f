import random

import pytest
from pyspark.sql import functions as F

from servicelake.llm import url_rules as op

from .helpers import clashing

RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
MORE = [
    *RULES,
    ("Shop.Example.com", "", "block"),
    ("a.b", "/x", "allow"),
    ("b", "/x/y", "block"),  # as long as the next two lines' texts
    ("c.b", "/x/", "allow"),
    ("twice.net", "/", "allow"),
    ("twice.net", "/", "block"),
    ("", "/all", "block"),
    (None, "/all", "block"),
    ("null-path.net", None, "block"),
]


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url is not None and "://" in url else ""
    host, path = "", ""
    for k, ch in enumerate(rest):
        if ch in "?#":
            break
        if ch == "/" or path:
            path += ch
        else:
            host += ch.lower() if ch.isascii() else ch
    fits = []
    for h, p, v in rules:
        h, p = (h or "").lower(), p or ""
        if h and (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(h) + len(p), len(h), h + p, v))
    best = max(fits, default=None)
    return (host, path, best[2] if best else None, best[3] if best else default)


def urls(n=400, seed=1):
    rng = random.Random(seed)
    hosts = ["example.org", "EXAMPLE.org", "www.example.org", "xexample.org", "example.com", "m.a.b", "c.b", "b", "x.c.b", "shop.example.com", "y.shop.example.com", "twice.net", "null-path.net", "org", ".org", "org.", "a..org", "exämple.org", "ÄÖ.com", "u:p@example.org:80"]
    paths = ["", "/", "/es", "/es/", "/es/q", "/en/1", "/en/12/x", "/en/2", "/fr/", "/de/1", "/DE/1", "/x", "/x/", "/x/y", "/x/yz", "/all", "//es/", "/é/ü"]
    ends = ["", "?q=/es/", "#/en/1", "?a#b", "#?"]
    out = [rng.choice(["http", "HTTPS", "", "a://b"]) + "://" + rng.choice(hosts) + rng.choice(paths) + rng.choice(ends) for _ in range(n)]
    out += [None, "", "no scheme", "example.org/es/", "://", ":///es/", "http://example.org\n.org/es/\nx", "http://" + "a." * 3000 + "example.org/es/" + "p" * 200_000, "http://" + "h" * 100_000, "http://example.org/en/1" + "/1" * 50_000]
    return out + ["http://www.example.org/es/same"] * 300


@pytest.mark.parametrize("rules", [RULES, MORE, []])
def test_against_brute_force(spark, rules):
    texts = urls()
    pages = spark.createDataFrame([(None if k % 50 == 0 else k, t) for k, t in enumerate(texts)], "page_id long, url string").repartition(4)
    found = op.judge_urls(pages, op.rule_rows(spark, rules))
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == sorted([(None if k % 50 == 0 else k, t, *brute(t, rules)) for k, t in enumerate(texts)], key=repr)


def test_other_default_empty_table_and_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://x.y/z"), (2, "http://example.org/es/1")], "page_id long, url string")
    rules = op.rule_rows(spark, RULES)
    names = ("host", "verdict", "key", "tail", "head", "page", "n", "short", "digest", "found", "a.b")
    found = op.judge_urls(clashing(pages, *names), rules, default="block")
    assert {"key", "tail", "head", "page", "n", "short", "digest", "found", "a.b"} < set(found.columns)
    rows = {r["page_id"]: r for r in found.collect()}
    assert rows[1]["verdict"] == "block" and rows[1]["rule"] is None and rows[1]["host"] == "x.y" and rows[1]["key"] == "other"
    assert rows[2]["rule"] == "example.org/es/"
    assert op.judge_urls(pages.limit(0), rules).count() == 0


def test_large_rule_list_and_skew(spark):
    """A rule for each of many hosts, half of all urls on one of them."""
    rules = [(f"h{k}.net", f"/{k % 7}/", "block" if k % 2 else "allow") for k in range(600)]
    table = spark.createDataFrame(rules, op.RULE)
    texts = [f"http://w.h{0 if k % 2 else k % 900}.net/{k % 7}/{k}" for k in range(4000)]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, url string")
    got = op.judge_urls(pages, table).select("page_id", "host", "path", "rule", "verdict").collect()
    by_host = {h: [(h, p, v)] for h, p, v in rules}
    want = [(k, *brute(t, by_host.get(t.split("/")[2][2:], []))) for k, t in enumerate(texts)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://x.y/z")], "page_id long, url string").select("page_id", F.col("url"))
    plan = op.judge_urls(pages, op.rule_rows(spark, RULES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
