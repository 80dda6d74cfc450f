"""Documents in blocks: rows that hold some megabytes of text each, written once to the shared folder.

Operators that count or match billions of small things (n-grams, byte windows)
go over blocks in numpy: a block sends, for each hash partition, its distinct
keys as one array; a partition's reducer puts the blocks' arrays together and
answers each with an array in the same order.  So the shuffle moves a few bytes
for each distinct key and block, a key that is everywhere is one entry of a
block, and a written table makes every pass see the same blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelake.llm.common import chunks, documents, release, written

SCHEMA = "block long, ids binary, missing binary, sizes binary, payload binary"


def pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


@dataclass
class Block:
    """Ids (0 where ``missing``), text sizes and the texts end to end, in ascending order of id, then text."""

    block: int
    ids: np.ndarray
    missing: np.ndarray
    sizes: np.ndarray
    data: bytes

    def texts(self) -> list[bytes]:
        ends = np.cumsum(self.sizes).tolist()
        return [self.data[e - n : e] for e, n in zip(ends, self.sizes.tolist(), strict=True)]


def read_block(row: dict) -> Block:
    release()  # what the block before took
    return Block(row["block"], np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["missing"], np.bool_), np.frombuffer(row["sizes"], "<i8"), unpack(row["payload"]))


def make_blocks(docs: DataFrame, block_bytes: int = 8 << 20) -> DataFrame:
    """Blocks of whole documents, about ``block_bytes`` of text or 65,536 documents each, written and reread."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = TaskContext.get().partitionId() << 32
        held: list[tuple[bool, int, bytes]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, size, next_id
            held.sort()
            ids = np.array([i for _, i, _ in held], "<i8").tobytes()
            missing = np.array([m for m, _, _ in held], np.bool_).tobytes()
            sizes = np.array([len(t) for *_, t in held], "<i8").tobytes()
            row = [[next_id], [ids], [missing], [sizes], [pack(b"".join(t for *_, t in held))]]
            next_id += 1
            held, size = [], 0
            return pa.RecordBatch.from_arrays([pa.array(row[0], pa.int64()), *(pa.array(x, pa.binary()) for x in row[1:])], names=["block", "ids", "missing", "sizes", "payload"])

        for rows, texts in chunks(batches, "text", block_bytes):
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), texts, strict=True):
                held.append((doc_id is None, doc_id or 0, text))
                size += len(text)
                if size >= block_bytes or len(held) >= 1 << 16:
                    yield flush()
        if held:
            yield flush()

    return written(documents(docs).mapInArrow(run, SCHEMA), "blocks", codec="uncompressed")


def text_bytes(docs: DataFrame) -> int:
    return documents(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0


def gathered(replies: DataFrame) -> DataFrame:
    """(block, replies): a block's answers (part, answer), one of each partition it asked."""
    return replies.groupBy("block").agg(F.collect_list(F.struct("part", "answer")).alias("replies"))


def partition_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The hash partition of mixed 64-bit values: by their upper 32 bits, so it ascends with them."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def encode_keys(hashes: np.ndarray, part: int, parts: int, size: int) -> bytes:
    """Ascending mixed hashes of one partition by their ``size`` upper bytes beyond what the partition tells.

    Steps from one to the next are small, so their upper bytes, stored together, take little.
    """
    base = np.uint64(-(-(part << 32) // parts) << 32)
    down = np.uint64(max(0, 64 - 8 * size - (parts.bit_length() - 1)))
    steps = np.diff((hashes - base) >> down, prepend=np.uint64(0)).astype("<u8")
    return pack(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes())


def decode_keys(blob: bytes, size: int) -> np.ndarray:
    planes = np.frombuffer(unpack(blob), np.uint8).reshape(size, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :size] = planes.T
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)
