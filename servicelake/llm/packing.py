"""Operator 1: cost-balanced packing of token sequences.

A piece of ``l`` tokens costs ``linear * l + quadratic * l ** 2`` (its own
attention).  Documents are taken in descending cost and each goes to the
sequence of lowest cost that has room for it.  A document longer than a
sequence fills whole sequences first; one that no sequence can hold whole is
cut, and its front fills the sequence with most room.

Work is done in blocks of bounded size that a task forms from the rows it
reads, in order, so nothing is shuffled and memory follows the block.  A
block of T tokens has T // capacity whole sequences and, for the rest of its
tokens, one sequence for each power of two in T % capacity: every sequence is
full, and none needs padding.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelake.llm.common import documents, slices
from servicelake.llm.tokens import DEFAULT_TOKENIZER, encoder

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, capacity long, cost double"


def pack_block(lengths: np.ndarray, capacity: int, linear: float = 1.0, quadratic: float | None = None):
    """(document, start, length, sequence, offset, sequence's capacity, its cost) of each piece, as arrays.

    Ties go to the earlier document and the earlier sequence.  Documents
    without tokens have no piece.
    """
    quadratic = 1.0 / capacity if quadratic is None else quadratic
    total = int(lengths.sum())
    room = [capacity] * (total // capacity) + [1 << k for k in range(capacity.bit_length() - 1, -1, -1) if (total % capacity) >> k & 1]
    size = np.array(room, np.int64)
    left, cost = size.copy(), np.zeros(len(size))
    pieces: list[tuple[int, int, int, int, int]] = []

    def put(d: int, start: int, n: int, s: int) -> None:
        pieces.append((d, start, n, s, int(size[s] - left[s])))
        left[s] -= n
        cost[s] += linear * n + quadratic * n * n

    free = 0
    waiting = []
    for d, n in enumerate(lengths.tolist()):
        whole = n // capacity
        for k in range(whole):
            put(d, k * capacity, capacity, free)
            free += 1
        if n % capacity:
            waiting.append((-(n % capacity), d, whole * capacity))
    heapq.heapify(waiting)
    while waiting:
        n, d, start = heapq.heappop(waiting)
        n = -n
        at = np.where(left >= n, cost, np.inf)
        s = int(at.argmin())
        if at[s] < np.inf:
            put(d, start, n, s)
            continue
        s = int(left.argmax())
        cut = int(left[s])
        put(d, start, cut, s)
        heapq.heappush(waiting, (cut - n, d, start + cut))
    found = np.array(pieces, np.int64).reshape(-1, 5)
    return (*found.T, size[found[:, 3]], cost[found[:, 3]])


def pack(
    docs: DataFrame,
    capacity: int = 2048,
    end_id: int = 1,
    tokenizer: str = DEFAULT_TOKENIZER,
    block_tokens: int = 1 << 21,
    block_docs: int = 1 << 15,
    linear: float = 1.0,
    quadratic: float | None = None,
    slice_bytes: int = 1 << 22,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` tokens (a power of two).

    One row for each piece: ``doc_id``, ``start`` (the document's ids before
    it), ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id``, ``offset`` there, the sequence's ``capacity`` and
    ``cost``.  Null or empty text is a document of the end id alone; a null
    doc_id stays null; repeated rows are documents of their own; other columns
    are ignored; an empty table gives no pieces.  Texts are encoded in slices
    of about ``slice_bytes``: what a worker holds besides its block follows the
    slice.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        next_id = TaskContext.get().partitionId() << 36
        ids: list[int | None] = []
        held: list[bytes] = []
        tokens = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal next_id, ids, held, tokens
            lengths = np.array([len(x) // 4 for x in held], np.int64)
            d, start, length, seq, offset, size, cost = pack_block(lengths, capacity, linear, quadratic)
            cut = [held[i][4 * a : 4 * (a + n)] for i, a, n in zip(d.tolist(), start.tolist(), length.tolist(), strict=True)]
            columns = [pa.array([ids[i] for i in d.tolist()], pa.int64()), start, length, pa.array(cut, pa.binary()), lengths[d], seq + next_id, offset, size, cost]
            out = pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "capacity", "cost"])
            next_id += int(seq.max()) + 1
            ids, held, tokens = [], [], 0
            for at in range(0, out.num_rows, 4096):
                yield out.slice(at, 4096)

        for rows in slices(batches, "text", slice_bytes):
            flat, ends = encode(rows.column("text"), end_id)
            blob, at = memoryview(flat).cast("B"), 0
            for doc_id, end in zip(rows.column("doc_id").to_pylist(), (4 * ends).tolist(), strict=True):
                ids.append(doc_id)
                held.append(bytes(blob[at:end]))
                tokens += (end - at) // 4
                at = end
                if tokens >= block_tokens or len(held) >= block_docs:
                    yield from flush()
        if held:
            yield from flush()

    return documents(docs).mapInArrow(run, SCHEMA)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "capacity", "cost")
