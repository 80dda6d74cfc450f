"""Operator 3: license scans.

An Aho-Corasick automaton over the words of a text (lower-cased, single
spaces between them) finds license names, notice phrases and the words of the
identifier tag in one pass.  Where the tag stands, the licence expression
after it is parsed by a shunting-yard parser (``WITH`` binds tightest, then
``AND``, then ``OR``) and evaluated twice: to the set of licence families it
names, and to whether it can be met with permissive licences alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from servicelake.llm.common import chunks, documents

# Phrases that stand for a licence by themselves.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: Phrases of licence notices, as words.
NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu library general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("boost software license", "bsl"),
    ("creative commons attribution", "cc-by"),
    ("creative commons zero", "cc0"),
    ("isc license", "isc"),
    ("released into the public domain", "unlicense"),
]
TAG = "spdx license identifier"
PERMISSIVE = frozenset({"mit", "bsd", "apache", "isc", "bsl", "cc0", "unlicense", "zlib", "0bsd"})
#: How sure one kind of evidence is of a licence.
WEIGHT = {"tag": 0.95, "notice": 0.8, "base": 0.7}

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_TAG_LINE = re.compile(rb"SPDX-License-Identifier[ \t]*:[ \t]*([^\r\n]*)", re.I)
_TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9.+:-]+)")
_BINDS = {"or": 1, "and": 2, "with": 3}

SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>, permissive boolean"


def family(identifier: str) -> str:
    """The label of a licence identifier: its first part, but for the two of one publisher."""
    parts = identifier.lower().rstrip("+").split("-")
    if parts[0] == "cc":
        return "cc-by" if "by" in parts else "cc"
    return parts[0]


def parse(text: str) -> list[str]:
    """The longest licence expression that begins ``text``, in postfix order (empty: there is none).

    Words that fit no expression (prose after it, a closing comment mark) end it.
    """
    out: list[str] = []
    stack: list[str] = []
    best: tuple[int, list[str]] = (0, [])  # how much of ``out``, and the operators behind it (outside brackets at most three)
    operand_next, at, opened = True, 0, 0
    while m := _TOKEN.match(text, at):
        at = m.end()
        token = m[1]
        word = token.lower()
        if operand_next:
            if token == "(":
                stack.append(token)
                opened += 1
                continue
            if token == ")" or word in _BINDS:
                break
            out.append(token)
            operand_next = False
        elif token == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
            opened -= 1
        elif word in _BINDS:
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[word]:
                out.append(stack.pop())
            stack.append(word)
            operand_next = True
            continue
        else:
            break
        if not opened:
            best = len(out), stack[::-1]
    return out[: best[0]] + best[1]


def evaluate(postfix: list[str]) -> tuple[frozenset[str], bool]:
    """The families that an expression names, and whether permissive licences alone can meet it.

    An exception after ``WITH`` names no licence and leaves its licence's answer.
    """
    stack: list[tuple[set[str], bool]] = []
    for token in postfix:
        if token in _BINDS:
            (b, b_free), (a, a_free) = stack.pop(), stack.pop()
            if token != "with":
                a, b = (a, b) if len(a) >= len(b) else (b, a)
                a |= b  # the smaller into the larger: long expressions stay cheap
                a_free = (a_free and b_free) if token == "and" else (a_free or b_free)
            stack.append((a, a_free))
        else:
            name = family(token)
            stack.append(({name}, name in PERMISSIVE))
    return frozenset(stack[-1][0]), stack[-1][1]


def automaton():
    """Aho-Corasick over single-spaced words; each phrase is held between spaces, so only whole words match."""
    import ahocorasick

    found = ahocorasick.Automaton()
    kinds: dict[str, list] = {}
    for kind, phrases in (("base", BASE), ("notice", NOTICES), ("tag", [(TAG, "")])):
        for phrase, label in phrases:
            kinds.setdefault(f" {phrase} ", []).append((kind, label))
    for key, what in kinds.items():
        found.add_word(key, (len(key), what))
    found.make_automaton()
    return found


def scan(text: bytes, machine) -> tuple:
    """One document's row, without its id."""
    words = text.translate(_LOWER).split()
    spaced = b" %b " % b" ".join(words)
    places: list[int] = []
    base: set[str] = set()
    evidence: set[tuple[str, str]] = set()
    tagged = False
    for end, (size, what) in machine.iter(spaced.decode("latin-1")):
        for kind, label in what:
            if kind == "tag":
                tagged = True
                continue
            evidence.add((kind, label))
            if kind == "base":
                base.add(label)
                places.append(end - size + 1)
    if places:  # characters to words: each has one space before it
        gaps = np.flatnonzero(np.frombuffer(spaced, np.uint8) == 32)
        places = np.searchsorted(gaps, places).tolist()
    expressions: list[str] = []
    free = None
    for m in _TAG_LINE.findall(text) if tagged else ():
        if postfix := parse(m.decode(errors="replace")):
            families, met = evaluate(postfix)
            expressions.append(" ".join(postfix))
            free = met if free is None else free and met
            evidence.update(("tag", f) for f in families)
    doubt = 1.0
    for kind, _ in sorted(evidence):
        doubt *= 1.0 - WEIGHT[kind]
    labels = base | {label for _, label in evidence}
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 - doubt if evidence else 0.0, expressions, free)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``.

    ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and
    ``last_word`` (their smallest and largest start, null without any),
    ``base_labels`` and ``labels`` (distinct, sorted, comma-joined; empty
    without any), ``score`` (0 without evidence, near 1 with much),
    ``expressions`` (postfix, in the order of the text) and ``permissive``
    (null without an expression, else whether all can be met so).  Null text
    counts as empty; a null doc_id stays null; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton()
        kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.list_(pa.string()), pa.bool_()]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions", "permissive"]
        for rows, texts in chunks(batches, "text", 1 << 23):
            columns = zip(*(scan(t, machine) for t in texts), strict=True)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    return documents(docs).mapInArrow(run, SCHEMA)
