import random
import re
import time

import pytest

from servicelake.llm import licenses as op

from .helpers import clashing, corpus, frame


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in op.BASE:
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                places.append(k)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_columns_match_brute_force(spark):
    rng = random.Random(5)
    pieces = ["GNU General Public License", "gnu--general\npublic license", "Apache License,", "CC BY", "cc-by 4.0", "MIT", "license", "MIT License", "é", "日本", "xgnu general public license", "\0", "7"]
    rows = [(k, " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))), None, None, None) for k in range(300)] + [(1000 + r[0] if r[0] is not None else None, *r[1:]) for r in corpus()]
    found = {}
    for r in op.scan_licenses(clashing(frame(spark, rows), "labels", "score")).collect():
        found.setdefault(r["doc_id"], []).append((r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert bool(r["labels"]) == (r["score"] > 0)
    for r in rows:
        assert brute(r[1]) in found[r[0]]


@pytest.mark.parametrize(
    ("text", "postfix", "families", "permissive"),
    [
        ("MIT", "MIT", {"mit"}, True),
        ("MIT OR GPL-2.0-only", "MIT GPL-2.0-only or", {"mit", "gpl"}, True),
        ("MIT AND GPL-2.0-only", "MIT GPL-2.0-only and", {"mit", "gpl"}, False),
        ("GPL-2.0+ WITH Classpath-exception-2.0 OR BSD-3-Clause AND ISC", "GPL-2.0+ Classpath-exception-2.0 with BSD-3-Clause ISC and or", {"gpl", "bsd", "isc"}, True),
        ("(MIT or Apache-2.0) and (CC-BY-4.0)", "MIT Apache-2.0 or CC-BY-4.0 and", {"mit", "apache", "cc-by"}, False),
        ("MIT */ and so on", "MIT", {"mit"}, True),
        ("MIT this is prose", "MIT", {"mit"}, True),
        ("MIT OR", "MIT", {"mit"}, True),
        ("MIT OR (Apache-2.0", "MIT", {"mit"}, True),
    ],
)
def test_expressions(text, postfix, families, permissive):
    parsed = op.parse(text)
    assert " ".join(parsed) == postfix
    assert op.evaluate(parsed) == (frozenset(families), permissive)


def test_no_expression():
    assert op.parse("") == op.parse("OR MIT") == op.parse("( )") == op.parse(")") == []


def test_tags_and_notices(spark):
    rows = [
        (1, "// SPDX-License-Identifier: (MIT OR GPL-2.0-only)\nint x;\n# spdx-license-identifier: ISC AND AGPL-3.0-only", None, None, None),
        (2, "Redistribution and use in source and binary forms, with or without", None, None, None),
        (3, "the SPDX license identifier is", None, None, None),
        (4, "Permission is hereby granted, free of charge, to any person obtaining a copy. MIT License", None, None, None),
    ]
    found = {r["doc_id"]: r for r in op.scan_licenses(frame(spark, rows)).collect()}
    assert (found[1]["labels"], found[1]["permissive"]) == ("agpl,gpl,isc,mit", False)
    assert found[1]["expressions"] == ["MIT GPL-2.0-only or", "ISC AGPL-3.0-only and"]
    assert (found[2]["labels"], found[2]["base_labels"]) == ("bsd", "")
    assert (found[3]["labels"], found[3]["score"], found[3]["permissive"]) == ("", 0.0, None)
    assert found[4]["score"] > found[2]["score"]
    assert op.scan_licenses(frame(spark, [])).count() == 0


def test_a_megabyte_of_one_phrase_or_expression_takes_linear_time():
    machine = op.automaton()
    seconds = []
    for n in (20_000, 80_000):
        begun = time.process_time()
        found = op.scan(b"The MIT License; " * n, machine)
        assert found[:4] == (3 * n, n, 1, 3 * n - 2) and found[4] == found[5] == "mit"
        expression = " OR ".join(f"L{k}-1" for k in range(n))
        assert op.scan(f"SPDX-License-Identifier: {expression}".encode(), machine)[5].count(",") == n - 1
        seconds.append(time.process_time() - begun)
    assert seconds[1] < 4 * 2.5 * seconds[0]
