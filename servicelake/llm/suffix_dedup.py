"""Operator 10: removal of repeated byte strings with suffix arrays.

Every string of ``length`` bytes has a minimizer, the least hash of the
``gram``-byte strings in it; equal strings have equal minimizers.  A text falls
into regions: maximal runs of starts whose strings share their minimizer.  Only
regions whose minimizer stands in several documents can repeat; they are dealt
by it to shards, each distinct region of a block once, with the least document
that holds it there.  A shard sorts the suffixes of its distinct regions by
induced sorting, computes their permuted common prefixes, and so has the strings
of ``length`` bytes in groups; the least document of a group keeps its string.
The verdicts go back to the blocks, which cut the texts.

A minimizer in very many regions is split: its strings are dealt one by one,
by their own hash, so equal ones still meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelake.llm.blocks import Block, decode_keys, encode_keys, gathered, make_blocks, pack, partition_of, read_block, text_bytes, unpack
from servicelake.llm.common import mix64
from servicelake.llm.suffix_sort import permuted_lcp, suffix_array

SCHEMA = "doc_id long, n_bytes long, removed array<struct<start: long, end: long>>, kept binary"
#: Bytes of text for each hash partition of minimizers (some two million), and for each shard of regions.
PART_BYTES = 32 << 20
SHARD_BYTES = 4 << 20
_PIECE = 1 << 18
_BASE = np.uint64(0x9E3779B97F4A7C15)
_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * _BASE)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@dataclass(frozen=True)
class Rule:
    length: int = 50
    gram: int = 24
    #: Regions of one minimizer beyond which its strings are dealt one by one.
    hot: int = 1 << 16


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Mixed hashes of all k-byte strings, put together from those of powers of two."""
    parts, power = {1: _VALUES[data]}, {1: _BASE}
    n = 1
    with np.errstate(over="ignore"):
        while 2 * n <= k:
            parts[2 * n] = parts[n][:-n] * power[n] + parts[n][n:]
            power[2 * n] = power[n] * power[n]
            n *= 2
        out, at = parts[n], n
        for size in sorted(parts, reverse=True):
            while k - at >= size:
                tail = parts[size][at:]
                out = out[: len(tail)] * power[size] + tail
                at += size
    return mix64(out)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    out, n = values, 1
    while 2 * n <= width:
        out = np.minimum(out[:-n], out[n:])
        n *= 2
    size = len(values) - width + 1
    return np.minimum(out[:size], out[width - n : width - n + size])


@dataclass
class Regions:
    """Of a block: document (index), start in the block's data, number of strings, minimizer; and hashes to tell any stretch of bytes."""

    doc: np.ndarray
    start: np.ndarray
    count: np.ndarray
    key: np.ndarray

    def of(self, keep: np.ndarray) -> "Regions":
        return Regions(self.doc[keep], self.start[keep], self.count[keep], self.key[keep])


def regions_of(block: Block, rule: Rule) -> Regions:
    """All regions of a block's documents that have an id, in order."""
    data = np.frombuffer(block.data, np.uint8)
    ends = np.cumsum(block.sizes)
    found: list[tuple[np.ndarray, ...]] = []
    first = 0
    while first < len(ends):  # some documents at a time, for the arrays' sake
        base = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + _PIECE, side="right")))
        piece = data[base : int(ends[last - 1])]
        own = np.arange(first, last)
        sizes = np.where(block.missing[own], 0, np.maximum(block.sizes[own] - rule.length + 1, 0))
        if sizes.sum():
            minima = window_minima(gram_hashes(piece, rule.gram), rule.length - rule.gram + 1)
            begin = ends[own] - block.sizes[own] - base
            many = np.flatnonzero(sizes)
            doc = np.repeat(own[many], sizes[many])
            at = np.arange(len(doc)) + np.repeat(begin[many] - (np.cumsum(sizes[many]) - sizes[many]), sizes[many])
            value = minima[at]
            cut = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])]))
            # least values are small ones: mixed again they spread over the partitions
            found.append((doc[cut], at[cut] + base, np.diff(np.append(cut, len(at))), mix64(value[cut] ^ _BASE)))
        first = last
    if not found:
        return Regions(*(np.empty(0, np.int64) for _ in range(3)), np.empty(0, np.uint64))
    return Regions(*(np.concatenate(c) for c in zip(*found, strict=True)))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """Powers of an odd number from 0 to n - 1; kept, for every block needs the same."""
    held = _POWERS.get(int(base))
    if held is None or len(held) < n:
        with np.errstate(over="ignore"):
            held = _POWERS[int(base)] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, base)]), dtype=np.uint64)
    return held[:n]


_POWERS: dict[int, np.ndarray] = {}


class Stretches:
    """Hashes of stretches of a byte array by sums of powers; equal stretches have equal hashes."""

    def __init__(self, data: np.ndarray):
        self.back = _powers(_INVERSE, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_VALUES[data] * _powers(_BASE, len(data) + 1)[:-1], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.sums[start + size] - self.sums[start]) * self.back[start] + size.astype(np.uint64))


def _keys_of(regions: Regions) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A block's distinct minimizers, ascending; whether several documents hold each, and in how many regions it stands."""
    order = np.argsort(regions.key, kind="stable")
    key, doc = regions.key[order], regions.doc[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    counts = np.diff(np.append(first, len(key)))
    several = (np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first)) if len(key) else np.empty(0, bool)
    return key[first], several, counts


@dataclass
class Entries:
    """What a block asks the shards: its distinct regions that may repeat, by shard; and where each occurs."""

    shard: np.ndarray  # of each entry, ascending
    route: np.ndarray
    start: np.ndarray
    size: np.ndarray  # bytes
    doc: np.ndarray  # the least document (index) that holds it
    occurs: Regions
    entry: np.ndarray  # of each occurrence


def entries_of(block: Block, replies: list, rule: Rule, parts: int, shards: int) -> Entries:
    regions = regions_of(block, rule)
    keys, several, _ = _keys_of(regions)
    elsewhere, hot = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    cuts = np.searchsorted(partition_of(keys, parts), np.arange(parts + 1))
    for part, answer in replies:
        a, b = cuts[part], cuts[part + 1]
        bits = np.unpackbits(np.frombuffer(unpack(answer), np.uint8))
        elsewhere[a:b], hot[a:b] = bits[: b - a], bits[len(bits) // 2 : len(bits) // 2 + b - a]
    index = np.searchsorted(keys, regions.key)
    keep = (elsewhere | several)[index]
    split = hot[index] & keep
    occurs = regions.of(keep & ~split)
    stretches = Stretches(np.frombuffer(block.data, np.uint8))
    if split.any():  # strings of hot minimizers, one by one
        own = regions.of(split)
        each = np.repeat(np.arange(len(own.doc)), own.count)
        start = own.start[each] + np.arange(len(each)) - np.repeat(np.cumsum(own.count) - own.count, own.count)
        one = np.ones(len(each), np.int64)
        single = Regions(own.doc[each], start, one, stretches.of(start, one * rule.length))
        occurs = Regions(*(np.concatenate([x, y]) for x, y in zip((occurs.doc, occurs.start, occurs.count, occurs.key), (single.doc, single.start, single.count, single.key), strict=True)))
    size = occurs.count + rule.length - 1
    content = stretches.of(occurs.start, size) if len(size) else np.empty(0, np.uint64)
    shard = (mix64(occurs.key) % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((occurs.start, content, occurs.key, shard))
    occurs, size, content, shard = occurs.of(order), size[order], content[order], shard[order]
    new = np.concatenate([[True], (content[1:] != content[:-1]) | (occurs.key[1:] != occurs.key[:-1])]) if len(size) else np.empty(0, bool)
    at = np.flatnonzero(new)
    return Entries(shard[at], occurs.key[at], occurs.start[at], size[at], occurs.doc[at], occurs, np.cumsum(new) - 1)


def _marked(starts: np.ndarray, sizes: np.ndarray, total: int) -> np.ndarray:
    """Places of ``total`` that lie in any of the stretches."""
    steps = np.zeros(total + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + sizes, -1)
    return np.cumsum(steps[:-1]) > 0


def judge(strings: list[bytes], routes: np.ndarray, docs: np.ndarray, length: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each string whether it stands whole in a smaller document, and else which of its starts do.

    The starts' strings of ``length`` bytes are compared through the suffix
    array of the distinct strings.  A string that is alone with its minimizer
    has no partner and stays out of it.
    """
    index: dict[tuple[int, bytes], int] = {}
    own = np.array([index.setdefault(k, len(index)) for k in zip(routes.tolist(), strings, strict=True)], np.int64)
    least = np.full(len(index), np.iinfo(np.int64).max)
    np.minimum.at(least, own, docs)
    distinct = [s for _, s in index]
    route = np.fromiter((r for r, _ in index), np.uint64, len(index))
    _, group, size = np.unique(route, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(size[group] > 1)
    verdict: list[np.ndarray] = [np.empty(0, np.int64)] * len(distinct)
    if len(shared):
        sizes = np.array([len(distinct[k]) for k in shared], np.int64)
        text = np.frombuffer(b"\0".join(distinct[k] for k in shared) + b"\0", np.uint8)
        ends = np.cumsum(sizes + 1) - 1
        symbols = text.astype(np.int32) + 1
        symbols[ends] = 0
        of = np.repeat(np.arange(len(shared)), sizes + 1)
        room = ends[of] - np.arange(len(text))
        sa = suffix_array(symbols, 257)
        common = permuted_lcp(text, sa, np.minimum(room, length))  # whether ``length`` bytes agree is all that is asked
        full = sa[room[sa] >= length]
        first = np.flatnonzero(np.concatenate([[True], common[full[1:]] < length]))
        doc = least[shared][of[full]]
        smallest = np.repeat(np.minimum.reduceat(doc, first), np.diff(np.append(first, len(full))))
        gone = np.sort(full[smallest < doc])
        begin = ends - sizes
        cuts = np.searchsorted(of[gone], np.arange(len(shared) + 1))
        for k, a, b in zip(range(len(shared)), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if b > a:
                verdict[shared[k]] = gone[a:b] - begin[k]
    whole = docs > least[own]
    return whole, [verdict[k] for k in own.tolist()]


def remove_repeats(docs: DataFrame, rule: Rule = Rule(), block_bytes: int = 4 << 20) -> DataFrame:
    """(doc_id, n_bytes, removed, kept): each text's UTF-8 bytes without those that lie in a string of ``length`` bytes
    that also starts in a document with a smaller id; ``removed`` are the maximal stretches.

    Judged on the input: overlaps count, matches do not cross documents.  Null
    text counts as empty.  A null id is neither smaller nor larger than
    another: such rows keep all and take nothing from others.  Rows with equal
    ids take nothing from each other.  Other columns are ignored; an empty
    table gives no rows.
    """
    total = text_bytes(docs)
    parts, shards = max(1, -(-total // PART_BYTES)), max(1, -(-total // SHARD_BYTES))
    blocks = make_blocks(docs, block_bytes)

    def ask_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = read_block(row)
                keys, _, counts = _keys_of(regions_of(block, rule))
                cuts = np.searchsorted(partition_of(keys, parts), np.arange(parts + 1))
                out = []
                for p, a, b in zip(range(parts), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    if b > a:  # the few keys of many regions go with their number
                        many = np.flatnonzero(counts[a:b] > 8)
                        out.append((p, block.block, encode_keys(keys[a:b], p, parts, 4), many.astype("<u4").tobytes(), counts[a:b][many].astype("<u4").tobytes()))
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["part", "block", "codes", "many", "counts"])

    def answer_keys(frame: pd.DataFrame) -> pd.DataFrame:
        codes = [decode_keys(x, 4).astype(np.uint32) for x in frame["codes"]]
        flat = np.concatenate(codes)
        ends = np.cumsum([len(c) for c in codes])
        weight = np.ones(len(flat), np.int64)
        for end, own, many, counts in zip(ends.tolist(), codes, frame["many"], frame["counts"], strict=True):
            weight[end - len(own) + np.frombuffer(many, "<u4")] = np.frombuffer(counts, "<u4")
        order = np.argsort(flat, kind="stable")
        ordered = flat[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        size = np.diff(np.append(first, len(flat)))
        several, hot = np.empty(len(flat), bool), np.empty(len(flat), bool)
        several[order] = np.repeat(size > 1, size)
        hot[order] = np.repeat(np.add.reduceat(weight[order], first) > rule.hot, size)
        replies = [pack(np.packbits(several[e - len(c) : e]).tobytes() + np.packbits(hot[e - len(c) : e]).tobytes()) for c, e in zip(codes, ends.tolist(), strict=True)]
        return pd.DataFrame({"block": frame["block"], "part": frame["part"], "answer": replies})

    asked = blocks.mapInArrow(ask_keys, "part long, block long, codes binary, many binary, counts binary")
    known = blocks.join(gathered(asked.groupBy("part").applyInPandas(answer_keys, "block long, part long, answer binary")), "block", "left")
    known = known.withColumnRenamed("replies", "key_replies")

    def ask_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = read_block(row)
                found = entries_of(block, [(r["part"], r["answer"]) for r in row["key_replies"] or []], rule, parts, shards)
                cuts = np.append(np.flatnonzero(np.diff(found.shard, prepend=-1)), len(found.shard)).tolist()
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    texts = b"".join([block.data[s : s + n] for s, n in zip(found.start[a:b].tolist(), found.size[a:b].tolist(), strict=True)])
                    columns = [
                        pa.array([int(found.shard[a])], pa.int64()),
                        pa.array([block.block], pa.int64()),
                        pa.array([pack(found.route[a:b].astype("<u8").tobytes())], pa.binary()),
                        pa.array([pack(block.ids[found.doc[a:b]].astype("<i8").tobytes())], pa.binary()),
                        pa.array([pack(found.size[a:b].astype("<u4").tobytes())], pa.binary()),
                        pa.array([pack(texts)], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "routes", "docs", "sizes", "texts"])

    def answer_shards(frame: pd.DataFrame) -> pd.DataFrame:
        routes = [np.frombuffer(unpack(x), "<u8") for x in frame["routes"]]
        docs_ = [np.frombuffer(unpack(x), "<i8") for x in frame["docs"]]
        strings: list[bytes] = []
        for sizes, texts in zip(frame["sizes"], frame["texts"], strict=True):
            data, ends = unpack(texts), np.cumsum(np.frombuffer(unpack(sizes), "<u4").astype(np.int64))
            strings += [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
        whole, some = judge(strings, np.concatenate(routes), np.concatenate(docs_), rule.length)
        replies, at = [], 0
        for own in routes:
            n = len(own)
            parts_ = some[at : at + n]
            lengths = np.array([len(x) for x in parts_], "<u4")
            flat = np.concatenate(parts_).astype("<u4") if lengths.sum() else np.empty(0, "<u4")
            replies.append(pack(np.packbits(whole[at : at + n]).tobytes() + lengths.tobytes() + flat.tobytes()))
            at += n
        return pd.DataFrame({"block": frame["block"], "part": frame["part"], "answer": replies})

    sent = known.mapInArrow(ask_shards, "part long, block long, routes binary, docs binary, sizes binary, texts binary")
    judged = gathered(sent.groupBy("part").applyInPandas(answer_shards, "block long, part long, answer binary"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = read_block(row)
                found = entries_of(block, [(r["part"], r["answer"]) for r in row["key_replies"] or []], rule, parts, shards)
                gone = _gone(block, found, [(r["part"], r["answer"]) for r in row["replies"] or []], rule)
                yield from _cut(block, gone)

    return known.join(judged, "block", "left").mapInArrow(cut, SCHEMA)


def _gone(block: Block, found: Entries, replies: list, rule: Rule) -> np.ndarray:
    """Which bytes of a block are to go."""
    n = len(found.shard)
    whole = np.zeros(n, bool)
    partial: list[tuple[np.ndarray, np.ndarray]] = []  # (entries, starts within)
    for shard, answer in replies:
        a, b = np.searchsorted(found.shard, [shard, shard + 1])
        blob = unpack(answer)
        bits = -(-(b - a) // 8)
        whole[a:b] = np.unpackbits(np.frombuffer(blob[:bits], np.uint8))[: b - a]
        lengths = np.frombuffer(blob[bits : bits + 4 * (b - a)], "<u4").astype(np.int64)
        starts = np.frombuffer(blob[bits + 4 * (b - a) :], "<u4").astype(np.int64)
        partial.append((np.repeat(np.arange(a, b), lengths), starts))
    occurs, entry = found.occurs, found.entry
    # an occurrence goes whole if its region does, or if a smaller document of the block holds the region too
    all_of_it = whole[entry] | (block.ids[occurs.doc] > block.ids[found.doc[entry]])
    starts, sizes = [occurs.start[all_of_it]], [occurs.count[all_of_it] + rule.length - 1]
    if partial:
        entries, within = (np.concatenate(c) for c in zip(*partial, strict=True))
        order = np.argsort(entries, kind="stable")
        entries, within = entries[order], within[order]
        left = np.flatnonzero(~all_of_it)
        a, b = np.searchsorted(entries, entry[left]), np.searchsorted(entries, entry[left], side="right")
        many = b - a
        at = np.repeat(a - (np.cumsum(many) - many), many) + np.arange(many.sum())
        starts.append(np.repeat(occurs.start[left], many) + within[at])
        sizes.append(np.full(len(at), rule.length, np.int64))
    return _marked(np.concatenate(starts), np.concatenate(sizes), len(block.data))


def _cut(block: Block, gone: np.ndarray) -> Iterator[pa.RecordBatch]:
    data = np.frombuffer(block.data, np.uint8)
    ends = np.cumsum(block.sizes)
    # stretches end with their document
    inner = np.zeros(len(data), bool)
    begin = (ends - block.sizes)[block.sizes > 0]
    inner[begin] = True
    edge = np.flatnonzero(gone & np.concatenate([[True], ~gone[:-1]]) | gone & inner)
    stop = np.flatnonzero(gone & np.concatenate([~gone[1:] | inner[1:], [True]])) + 1 if len(data) else edge
    of = np.searchsorted(ends, edge, side="right")
    cuts = np.searchsorted(of, np.arange(len(ends) + 1))
    kept = data[~gone].tobytes()
    left = np.concatenate([[0], np.cumsum(~gone)])
    kept_at = left[np.concatenate([[0], ends])].tolist()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for a in range(0, len(ends), 4096):
        b = min(a + 4096, len(ends))
        spans = []
        for d in range(a, b):
            base = int(ends[d] - block.sizes[d])
            spans.append([{"start": x - base, "end": y - base} for x, y in zip(edge[cuts[d] : cuts[d + 1]].tolist(), stop[cuts[d] : cuts[d + 1]].tolist(), strict=True)])
        columns = [pa.array(block.ids[a:b], mask=block.missing[a:b]), pa.array(block.sizes[a:b]), pa.array(spans, kind), pa.array([kept[kept_at[d] : kept_at[d + 1]] for d in range(a, b)], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "removed", "kept"])


def digest(cut: DataFrame) -> DataFrame:
    """Counts and a checksum in place of the stretches and bytes."""
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
