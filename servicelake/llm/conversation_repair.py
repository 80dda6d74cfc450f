"""Repair of conversations: roles in order, no blank or repeated turns, at least cost.

One shuffle sorts all rows by conversation and turn over ranges of any
conversation ids; a conversation that lies within one range is repaired where
it is read.  One that spans ranges, or has more rows than a piece may hold, is
repaired in pieces, so that a conversation of a third of all rows is spread
like any other rows: each piece gives its least costs from state to state,
these are added up from the end of the conversation, and with them each piece
chooses its own edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servicelake.llm import audit_trail
from servicelake.llm.common import written

#: White space of ASCII; a text of nothing else is blank.
SPACE = " \t\n\x0b\x0c\r"

#: Initials of roles that may stand one after the other.
LEGAL = {"su", "ua", "au"}

#: Rows and characters of a piece; a conversation of more is cut.
PIECE_ROWS, PIECE_CHARS = 8192, 16 << 20

_LONGS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PIECES = "conv_id long, part int, k long, whole boolean, " + ", ".join(f"{c} long" for c in _LONGS) + ", audit string, roles array<string>, texts array<string>, min_turn long, max_turn long, n_turns long"
_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.bool_(), *[pa.int64()] * 6, pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), *[pa.int64()] * 3]
_NAMES = ["conv_id", "part", "k", "whole", *_LONGS, "audit", "roles", "texts", "min_turn", "max_turn", "n_turns"]


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def judged(roles: list[str], texts: list[str], firsts: set[int] | None = None) -> tuple[str, tuple[int, int, int]]:
    """(symbols, (blank, duplicate, truncated)): the first fault of each row.

    ``firsts`` are the places of rows whose role and text do not stand earlier;
    without it they are found here, for a conversation that is whole.
    """
    symbols, blank, duplicate, truncated, seen = [], 0, 0, 0, set()
    for at, (role, text) in enumerate(zip(roles, texts, strict=True)):
        body = text.rstrip(SPACE)
        if firsts is None:
            again = (role, text) in seen
            seen.add((role, text))
        else:
            again = at not in firsts
        if not body:
            blank += 1
            symbols.append(audit_trail.MUST_GO)
        elif again:
            duplicate += 1
            symbols.append(audit_trail.MUST_GO)
        else:
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            cut = body[-1] not in ".!?"
            truncated += cut
            symbols.append(initial.upper() if cut else initial)
    return "".join(symbols), (blank, duplicate, truncated)


def illegal_pairs(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:]))


def gaps_of(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else high - low + 1 - distinct


def _pieces(piece_rows: int, piece_chars: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one range: whole conversations repaired, the first, the last and the long ones as they are, cut into pieces."""
    part = TaskContext.get().partitionId()
    out: list[tuple] = []
    out_chars = 0
    k = 0
    now: object = out  # no id yet
    roles: list[str] = []
    texts: list[str] = []
    turns: list[int | None] = []
    chars, first, cut = 0, True, False

    def flush(whole: bool) -> None:
        nonlocal k, roles, texts, turns, chars, out_chars
        if not roles:
            return
        known = [t for t in turns if t is not None]
        low, high, distinct = (known[0], known[-1], len(set(known))) if known else (None, None, 0)
        if whole:
            symbols, faults = judged(roles, texts)
            cost, audit = audit_trail.repair(symbols)
            new_roles, new_texts, _ = audit_trail.apply(audit, audit_trail.START, roles, texts)
            out.append((now, part, k, True, gaps_of(low, high, distinct), *faults, illegal_pairs(roles), cost, audit, new_roles, new_texts, None, None, None))
        else:
            out.append((now, part, k, False, 0, 0, 0, 0, 0, 0, None, roles, texts, low, high, distinct))
        k += 1
        out_chars += chars
        roles, texts, turns, chars = [], [], [], 0

    for batch in batches:
        for conv, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")), strict=True):
            if conv != now:
                flush(not (first or cut))
                first = now is out
                now, cut = conv, False
            elif len(roles) >= piece_rows or chars >= piece_chars:
                cut = True
                flush(False)
            roles.append(role)
            texts.append(text)
            turns.append(turn)
            chars += len(text)
            if out_chars >= piece_chars or len(out) >= 4096:
                yield _batch(out, _NAMES, _KINDS)
                out, out_chars = [], 0
    flush(False)
    if out:
        yield _batch(out, _NAMES, _KINDS)


_COSTS = "conv_id long, part int, k long, blank long, duplicate long, truncated long, illegal long, first string, last string, min_turn long, max_turn long, n_turns long, symbols string, costs array<int>"
_COST_NAMES = [c.split()[0] for c in _COSTS.split(", ")]
_COST_KINDS = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.string(), *[pa.int64()] * 3, pa.string(), pa.list_(pa.int32())]


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            symbols, faults = judged(row["roles"], row["texts"], set(row["firsts"] or ()))
            roles = row["roles"]
            one = (row["conv_id"], row["part"], row["k"], *faults, illegal_pairs(roles), roles[0][:1], roles[-1][:1], row["min_turn"], row["max_turn"], row["n_turns"], symbols, audit_trail.cost_matrix(symbols))
            yield _batch([one], _COST_NAMES, _COST_KINDS)


_TOLD = "part int, k long, gaps long, illegal_before long, cost long, last_piece boolean, to_go array<int>"
_TOLD_NAMES = [c.split()[0] for c in _TOLD.split(", ")]
_TOLD_KINDS = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int32())]


def _fold(table: pa.Table) -> pa.Table:
    """What each piece of one conversation must know of the others; the conversation's totals go to its first piece."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["k"]))
    to_go = [audit_trail.END_COST]
    for row in reversed(rows):
        to_go.append(audit_trail.costs_to_go(row["costs"], to_go[-1]))
    to_go.reverse()
    low = high = None
    distinct = 0
    out = []
    for at, row in enumerate(rows):
        illegal = at > 0 and rows[at - 1]["last"] + row["first"] not in LEGAL
        if row["min_turn"] is not None:
            distinct += row["n_turns"] - (row["min_turn"] == high)
            low = row["min_turn"] if low is None else low
            high = row["max_turn"]
        out.append([row["part"], row["k"], 0, int(illegal), 0, at == len(rows) - 1, to_go[at + 1]])
    out[0][2], out[0][4] = gaps_of(low, high, distinct), to_go[0][audit_trail.START]
    return pa.Table.from_batches([_batch(out, _TOLD_NAMES, _TOLD_KINDS)])


_CHOICE = "conv_id long, part int, k long, ends array<int>, audits array<string>"


def _choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From each state that a piece may begin in: its edits, and the state they end in."""
    for batch in batches:
        for row in batch.to_pylist():
            to_go = None if row["last_piece"] else tuple(row["to_go"])
            found = [audit_trail.Repairs(row["symbols"], start).best(to_go) for start in audit_trail.STATES]
            one = (row["conv_id"], row["part"], row["k"], [f[1] for f in found], [f[2] for f in found])
            yield _batch([one], ["conv_id", "part", "k", "ends", "audits"], [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.string())])


def _chain(table: pa.Table) -> pa.Table:
    """The state in which each piece of one conversation begins."""
    state, out = audit_trail.START, []
    for row in sorted(table.to_pylist(), key=lambda r: (r["part"], r["k"])):
        out.append((row["part"], row["k"], state))
        state = row["ends"][state]
    return pa.Table.from_batches([_batch(out, ["part", "k", "start"], [pa.int32(), pa.int64(), pa.int32()])])


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            audit = r["audits"][r["start"]]
            roles, texts, _ = audit_trail.apply(audit, r["start"], r["roles"], r["texts"])
            yield _batch([(r["conv_id"], r["part"], r["k"], False, *(r[c] for c in _LONGS), audit, roles, texts, None, None, None)], _NAMES, _KINDS)


def repair(conversations: DataFrame, copies: Column | None = None, piece_rows: int = PIECE_ROWS, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Repaired conversations: conv_id, part, k, whole, the counts, cost, audit, and ``roles`` and ``texts`` of the repaired rows.

    A conversation's rows are taken by turn (nulls first), equal turns by role,
    then text.  A row's first fault counts: blank (no character but white
    space), duplicate (role and text seen earlier), truncated (the last
    character that is no white space is none of ``.!?``).  Blank and duplicate
    rows must go; other edits are chosen by ``audit_trail``.

    There is one row for each conversation (``whole``), or one for each of its
    pieces: their numbers add up, their audits and rows follow each other by
    (part, k).  ``copies`` is how often a row counts (null or none: once).

    Null texts and roles are one space; a null conv_id is a conversation like
    any other; other columns are ignored; an empty table gives no rows.
    Memory of a task follows a piece, 8,192 rows or 16 million characters (``piece_rows``, ``piece_chars``).  The
    steps on the pieces of one conversation keep some 200 bytes for each piece.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        *([] if copies is None else [F.explode(F.array_repeat(F.lit(0), F.coalesce(copies, F.lit(1)))).alias("copy")]),
    ).select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("at"))
    order = ["conv_id", "turn", "role", "text", "at"]  # the last spreads rows that are equal
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("at")
    first = written(dealt.mapInArrow(partial(_pieces, piece_rows, piece_chars), PIECES), "conversation-pieces")
    whole, cut = first.where("whole"), first.where("NOT whole")

    each = cut.select("conv_id", "part", "k", F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "row"))
    seen = each.groupBy("conv_id", F.col("row.roles").alias("role"), F.sha2(F.col("row.texts").cast("binary"), 256).alias("digest")).agg(F.min(F.struct("part", "k", "pos")).alias("at"))
    firsts = seen.groupBy("at.part", "at.k").agg(F.collect_list("at.pos").alias("firsts"))
    costs = written(cut.join(firsts, ["part", "k"], "left").mapInArrow(_costs, _COSTS), "conversation-costs")
    told = costs.groupBy("conv_id").applyInArrow(_fold, _TOLD)
    told = written(costs.drop("min_turn", "max_turn", "n_turns", "costs").join(told, ["part", "k"]), "conversation-told")
    chosen = written(told.mapInArrow(_choices, _CHOICE), "conversation-choices")
    starts = chosen.select("conv_id", "part", "k", "ends").groupBy("conv_id").applyInArrow(_chain, "part int, k long, start int")
    known = told.select("part", "k", "gaps", "blank", "duplicate", "truncated", (F.col("illegal") + F.col("illegal_before")).alias("illegal"), "cost")
    edited = cut.select("conv_id", "part", "k", "roles", "texts").join(known, ["part", "k"]).join(chosen.drop("conv_id", "ends"), ["part", "k"]).join(starts, ["part", "k"])
    return whole.unionByName(edited.mapInArrow(_edited, PIECES)).drop("min_turn", "max_turn", "n_turns")


def repaired_rows(repaired: DataFrame) -> DataFrame:
    """(conv_id, part, k, position, role, text): the rows of ``repair``'s result, in order by (part, k, position)."""
    rows = repaired.select("conv_id", "part", "k", F.posexplode(F.arrays_zip("roles", "texts")).alias("position", "row"))
    return rows.select("conv_id", "part", "k", "position", F.col("row.roles").alias("role"), F.col("row.texts").alias("text"))


_DIGEST = "conv_id long, " + ", ".join(f"{c} long" for c in _LONGS) + ", audit string, repaired_sha256 string"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of conversations in order, each conversation's hash carried on from piece to piece."""
    names = [c.split()[0] for c in _DIGEST.split(", ")]
    kinds = [*[pa.int64()] * 7, pa.string(), pa.string()]
    now: object = names
    sums, audit, any_row, digest = [0] * 6, [], False, hashlib.sha256()
    for batch in batches:
        for row in batch.to_pylist():
            if row["conv_id"] != now:
                if now is not names:
                    yield _batch([(now, *sums, "".join(audit), digest.hexdigest())], names, kinds)
                now, sums, audit, any_row, digest = row["conv_id"], [0] * 6, [], False, hashlib.sha256()
            sums = [s + row[c] for s, c in zip(sums, _LONGS, strict=True)]
            audit.append(row["audit"])
            for role, text in zip(row["roles"], row["texts"], strict=True):
                digest.update(f"{chr(10) if any_row else ''}{role}:{text}".encode())
                any_row = True
    if now is not names:
        yield _batch([(now, *sums, "".join(audit), digest.hexdigest())], names, kinds)


def digest(conversations: DataFrame, repaired: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations``: counts, cost, audit and the SHA-256 of the repaired rows.

    A hash runs over its text from the first byte to the last, so the pieces of
    a cut conversation pass one task, one after the other.  Conversations of
    which no row is left have zeros, an empty audit and the hash of no text.
    """
    line = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit(":"), t)), "\n")
    whole = repaired.where("whole").select("conv_id", *_LONGS, "audit", F.sha2(line.cast("binary"), 256).alias("repaired_sha256"))
    pieces = repaired.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "part", "k")
    found = whole.unionByName(pieces.mapInArrow(_digest, _DIGEST)).withColumnRenamed("conv_id", "found")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    return ids.join(found, ids["conv_id"].eqNullSafe(found["found"]), "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in _LONGS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


def damaged(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """(rows, copies): damage by the remainder of crc32 of ``conv_id:turn`` (nulls: one space) by 20.

    0 drops a row, 1 empties its text, 2 removes ``.``, ``!`` and ``?`` from it, 3 doubles the row, 4 makes its role user.
    """
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name.cast("binary")) % 20
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return rows, F.col("copies")
