import hashlib
import itertools
import random
import re
import zlib

import pytest

from servicelake.llm import audit_trail as trail
from servicelake.llm import conversation_repair as op

from .helpers import clashing

SCHEMA = "conv_id long, turn long, role string, text string"
FORM = re.compile(r"(s?(ua)+)?\Z")


def all_repairs(symbols):
    """Every string of edits with at most two insertions in a row: (cost, string)."""
    found = []
    holes = ["", "I", "II"]
    for edits in itertools.product("DKR", repeat=len(symbols)):
        if any(s == "-" and e != "D" for s, e in zip(symbols, edits)):
            continue
        for puts in itertools.product(holes, repeat=len(symbols) + 1):
            text = puts[0] + "".join(e + p for e, p in zip(edits, puts[1:]))
            roles, cost, at = "", 0, 0
            for e in text:
                due = "u" if not roles or roles[-1] in "sa" else "a"
                if e == "I":
                    roles, cost = roles + due, cost + 2
                    continue
                symbol, at = symbols[at], at + 1
                if e == "D":
                    cost += 3
                else:
                    roles += due if e == "R" else symbol.lower()
                    cost += (2 if e == "R" else 0) + symbol.isupper()
            if FORM.match(roles):
                found.append((cost, text))
    return min(found)


def test_least_repair_against_all_strings():
    for n in range(4):
        for symbols in itertools.product("-suaxUA", repeat=n):
            assert trail.repair("".join(symbols)) == all_repairs(symbols), symbols
    rng = random.Random(5)
    for _ in range(25):
        symbols = "".join(rng.choice("-suaxUAS") for _ in range(4))
        assert trail.repair(symbols) == all_repairs(symbols)


def plain(symbols):
    """The same program with strings copied and compared whole."""
    best = {trail.START: (0, "")}
    for symbol in [*symbols, None]:
        for state in (trail.START, trail.SYSTEM, trail.ASSISTANT, trail.USER):
            if state in best:
                after = trail.DUE[state][1]
                best[after] = min(best.get(after, (10**9, "")), (best[state][0] + 2, best[state][1] + "I"))
        if symbol is None:
            break
        new = {}
        for state, (cost, text) in best.items():
            ways = [(state, cost + 3, "D")]
            if symbol != "-":
                ways.append((trail.DUE[state][1], cost + 2 + symbol.isupper(), "R"))
                if trail.kept_state(state, symbol) is not None:
                    ways.append((trail.kept_state(state, symbol), cost + symbol.isupper(), "K"))
            for after, price, letter in ways:
                new[after] = min(new.get(after, (10**9, "")), (price, text + letter))
        best = new
    return min(best[s] for s in (trail.START, trail.ASSISTANT) if s in best)


@pytest.mark.parametrize("hash_of", [None, lambda before, letter: 0, lambda before, letter: (before + ord(letter)) % 3])
def test_long_ties_and_colliding_hashes(hash_of):
    """Hashes that collide always, or often, change nothing."""
    rng = random.Random(7)
    for _ in range(30):
        symbols = "".join(rng.choice("-suaxUAX") for _ in range(rng.randint(1, 90)))
        cost, _, text = trail.Repairs(symbols, trail.START, trail.Trail(hash_of)).best(None)
        assert (cost, text) == plain(symbols)


def test_pieces_add_up():
    rng = random.Random(8)
    for _ in range(60):
        symbols = "".join(rng.choice("-suaxUA") for _ in range(rng.randint(1, 40)))
        cuts = sorted(rng.choices(range(len(symbols) + 1), k=3))
        pieces = [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)])]
        to_go = [trail.END_COST]
        for piece in reversed(pieces):
            to_go.insert(0, trail.costs_to_go(trail.cost_matrix(piece), to_go[0]))
        state, text = trail.START, ""
        for k, piece in enumerate(pieces):
            _, state, part = trail.Repairs(piece, state).best(to_go[k + 1] if k + 1 < len(pieces) else None)
            text += part
        assert (to_go[0][trail.START], text) == trail.repair(symbols)


def test_time_is_nearly_linear():
    symbols = "uxuaXUA-s" * 2500
    cost, text = trail.repair(symbols)
    assert len(text) >= len(symbols) and (cost, text) == plain(symbols)


def brute(rows):
    """The digest's rows, by the plain program."""
    after = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        after += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        symbols, seen, counts = "", set(), [0, 0, 0]
        for _, _, role, text in own:
            if not re.search("[^\x20\x09-\x0d]", text):
                counts[0] += 1
                symbols += "-"
            elif (role, text) in seen:
                counts[1] += 1
                symbols += "-"
            else:
                cut = not re.search("[.!?][\x20\x09-\x0d]*\\Z", text)
                counts[2] += cut
                initial = role[:1] if role[:1] in list("sua") else "x"
                symbols += initial.upper() if cut else initial
            seen.add((role, text))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = plain(symbols)
        lines, state, at = [], trail.START, 0
        for e in audit:
            if e == "D":
                at += 1
                continue
            role = own[at][2] if e == "K" else trail.DUE[state][0]
            state = trail.kept_state(state, role[:1]) if e == "K" else trail.DUE[state][1]
            lines.append(f"{role}:{'' if e == 'I' else own[at][3]}")
            at += e != "I"
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed=1):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \t\n", "same. ", "end?\x0b", "\x1f", "é…", None, "a:b\nc.", "long " * 40 + "."]
    rows = []
    for conv in range(80):
        n = rng.choice([0, 1, 2, 5, 9, 30])
        role = itertools.cycle(["user", "assistant"])
        for turn in range(n):
            kind = rng.random()
            rows.append((conv, turn * (3 if kind > 0.9 else 1), next(role) if kind < 0.8 else rng.choice(["system", "tool", "", None, "Sys", "util", "user"]), rng.choice(texts) if kind < 0.5 else f"text {rng.randint(0, 40)}."))
    rows += [(None, k, "user", f"null id {k}") for k in range(6)] + [(500, None, "user", "a."), (500, None, "assistant", "b."), (501, -5, "system", "s."), (501, 9, "user", "u")]
    rows += [(7, k % 90, rng.choice(["user", "assistant", "system", "x"]), rng.choice([f"hot {k // 3}.", "again.", "", f"cut {k}"])) for k in range(1200)]  # two thirds of all rows
    rows += rows[:20]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("piece_rows", [1, 7, op.PIECE_ROWS])
def test_against_brute_force(spark, piece_rows):
    rows = conversations()
    given = clashing(spark.createDataFrame(rows, SCHEMA), "copies", "k", "part", "whole", "audit", "at").repartition(5)
    got = op.digest(given, op.repair(*op.damaged(given), piece_rows=piece_rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_repaired_rows_are_in_form(spark):
    given = spark.createDataFrame(conversations(2), SCHEMA)
    rows = op.repaired_rows(op.repair(given, piece_rows=50)).orderBy("conv_id", "part", "k", "position").collect()
    for _, own in itertools.groupby(rows, key=lambda r: r["conv_id"]):
        assert FORM.match("".join(r["role"][:1] for r in own))


def test_empty_table_and_one_long_text(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert op.digest(none, op.repair(*op.damaged(none))).count() == 0
    rows = [(1, 0, "user", "w " * 500_000 + "."), (1, 1, "assistant", "x" * 1_000_000), (2, 0, "user", "a.")]
    given = spark.createDataFrame(rows, SCHEMA)
    got = op.digest(given, op.repair(*op.damaged(given), piece_chars=1000))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
