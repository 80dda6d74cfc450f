"""Operator 7: substring deduplication by sliding sentence spans.

Texts are cut into sentences (at ``.``, ``!``, ``?`` and line ends); a
sentence of more than ``_WINDOW`` words is cut on after the words whose hash is
the least of a window of ``_WINDOW`` words (the last such word, if several are), so a
passage is cut alike wherever it stands, but for ``_WINDOW`` words at either
end, and no piece is longer.  Every run of ``span`` consecutive pieces (of
more, if they have few words) is hashed, the hashes are joined globally, and the pieces of
every run but a hash's first (smallest document, then place) are removed.

A passage of 51 words in mid-sentence shares 32 words at least that are cut
alike, and the runs in them cover all of these.  In scripts without spaces a
character is what a word is elsewhere, and counts half of one; full-width stops
end sentences.  Windows bound the pieces of any text, whatever stands in it.

Most runs stand once.  So a chunk of documents first asks each hash partition
which of its distinct hashes other chunks have too: some bytes for each, and a
run that a third of all documents hold is one entry of a chunk.  Only runs that
recur become rows; where each one's first stands is found with partial sums
before the shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from servicelake.llm.blocks import decode_keys, encode_keys, gathered, pack, partition_of, unpack
from servicelake.llm.common import WordHashes, chunks, forget, fresh, mix64, release, slices, text_key, utf8, written

#: A word with the space about it; with a stop, the last of its sentence.
_TOKEN = re.compile(rb"[^\S\n]*[^\s.!?]*(?:[.!?\n]+[ \t]*|[^\S\n]+)?")
_WINDOW = 10

#: Characters of scripts written without spaces (Thai, Lao, Burmese, Khmer, kana, Han), each a token that counts half a word.
_CHAR = rb"(?:\xe0[\xb8-\xbb][\x80-\xbf]|\xe1[\x80-\x82\x9e\x9f][\x80-\xbf]|[\xe3-\xe9][\x80-\xbf]{2}|\xf0[\xa0-\xbf][\x80-\xbf]{2})"
_WIDE_STOP = rb"(?:\xe3\x80\x82|\xef\xbc[\x81\x8e\x9f]|\xef\xbd\xa1)"
_UNSPACED = re.compile(_CHAR)
_WIDE_LEAD = re.compile(rb"[\xe0\xe1\xe3-\xe9\xef\xf0]")
_STOPS = re.compile(rb"(?:[.!?\n]|%b)" % _WIDE_STOP)
_WIDE_TOKEN = re.compile(rb"[^\S\n]*(?:(?!%b)%b|(?:(?!%b|%b)[^\s.!?])*)(?:(?:[.!?\n]|%b)+[ \t]*|[^\S\n]+)?" % (_WIDE_STOP, _CHAR, _CHAR, _WIDE_STOP, _WIDE_STOP))

#: A stretch without spaces of more bytes than 50 words is cut into characters, each of which counts a sixth of a word.
_STRETCH = 306
_CHARACTER = re.compile(rb"\s*[\x00-\x7f\xc0-\xff][\x80-\xbf]*")

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

#: Low bits of a token's value: whether it ends a sentence, and how many words it counts (in sixths, by these three bits).
_SIXTHS = np.array([0, 6, 12, 18, 24, 30, 3, 1])
_FLAGS = 4
_HASH = np.uint64((1 << 64) - (1 << _FLAGS))
_HALF, _LOW = np.uint64(32), np.uint64((1 << 32) - 1)

SPANS = "doc_id long, text_key long, place int, size int, span long"
CHUNKS = "block long, n long, doc_id array<long>, text_key array<long>, pieces array<int>, runs binary, spans binary"
#: Runs for each hash partition, and bytes that tell those of a partition apart (beyond them, rows do).
PART_RUNS = 1 << 19
KEY_BYTES = 4


class Tokens(WordHashes):
    """Token bytes -> hash of its words, lower-cased (A-Z), with flags in the low bits.  A character of a long stretch is asked for as text."""

    def __init__(self, most: int = 250_000):
        super().__init__(most)
        import xxhash

        self.digest = xxhash.xxh3_64_intdigest
        self.raised = self.lowered = np.ones(1, np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """``_ODD`` to the powers 0 to ``n`` at least, and its inverse."""
        if len(self.raised) <= n:
            self.raised, self.lowered = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, x)]), dtype=np.uint64) for x in (_ODD, _ODD_INVERSE))
        return self.raised, self.lowered

    def __missing__(self, token: bytes | str) -> int:
        if isinstance(token, str):
            return self.digest(token.lower().encode()) >> _FLAGS << _FLAGS | 7 << 1
        word = token.strip()
        many, ends = 1 if word else 0, word.endswith((b".", b"!", b"?"))
        if not word.isascii():
            many = 6 if _UNSPACED.match(word) else many
            ends = _STOPS.search(word) is not None
        if b"\n" in token:  # the one space that may stand within
            words = word.split()
            word, many, ends = b" ".join(words), min(len(words), 5) if many < 6 else many, True
        value = self.digest(word.lower()) >> _FLAGS << _FLAGS | many << 1 | ends
        if len(self) >= self.most:
            self.clear()
        self[token] = value
        return value


def _least(hashes: np.ndarray) -> np.ndarray:
    """For each window, the place of the last of its least hashes (their upper halves)."""
    least = (hashes >> _HALF << _HALF) + np.arange(len(hashes))[::-1].astype(np.uint64)
    wide = 1
    while wide < _WINDOW:
        more = min(wide, _WINDOW - wide)
        least = np.minimum(least[:-more], least[more:])
        wide += more
    return len(hashes) - 1 - (least & _LOW).astype(np.int64)


def _characters(tokens: list[bytes]) -> tuple[list[bytes], list[bytes | str]]:
    """The tokens, those of long stretches character by character, and what to ask ``Tokens`` for."""
    out: list[bytes] = []
    asked: list[bytes | str] = []
    for token in tokens:
        body = token.rstrip(b".!? \t\n\r\f\v")
        if len(body.lstrip()) > _STRETCH:
            out += (own := _CHARACTER.findall(body))
            asked += [c.strip().decode() for c in own]
            token = token[len(body) :]
        if token:
            out.append(token)
            asked.append(token)
    return out, asked


def cut(text: bytes, known: Tokens) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The tokens of a text, their values, and how many tokens end with each piece."""
    wide = not text.isascii() and _WIDE_LEAD.search(text)
    tokens = (_WIDE_TOKEN if wide else _TOKEN).findall(text)
    if tokens and not tokens[-1]:
        tokens.pop()
    if tokens and len(max(tokens, key=len)) > _STRETCH:
        tokens, asked = _characters(tokens)
        values = known.of(asked)
    else:
        values = known.of(tokens)
    n = len(tokens)
    is_end = values & np.uint64(1) == 1
    if n:
        is_end[-1] = True
    ends = np.flatnonzero(is_end) + 1
    if n > _WINDOW:
        # windows that lie in one sentence, of those that are longer than a window
        sizes = ends.copy()
        sizes[1:] -= ends[:-1]
        before = np.cumsum(is_end)
        whole = (before[_WINDOW - 1 :] - is_end[_WINDOW - 1 :] == before[: n - _WINDOW + 1] - is_end[: n - _WINDOW + 1]) & np.repeat(sizes > _WINDOW, sizes)[: n - _WINDOW + 1]
        is_end[_least(values)[whole]] = True
        ends = np.flatnonzero(is_end) + 1
    return tokens, values, ends


def sentences(text: bytes, known: Tokens | None = None) -> list[bytes]:
    """The pieces of a text; together they are the text."""
    tokens, _, ends = cut(text, Tokens() if known is None else known)
    ends = ends.tolist()
    return [b"".join(tokens[a:b]) for a, b in zip([0, *ends], ends, strict=False)]


def span_hashes(text: bytes, span: int, min_words: int, known: Tokens) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """The pieces of a text, and (place of the first piece, number of pieces, hash) of its runs.

    From every piece on, and back from every piece, the run of ``span``
    pieces, or of as many more as it takes to have ``min_words`` words; of a
    text of fewer pieces but so many words, all of it.  So
    every piece of a passage is in runs that lie in the passage, its ends
    included.  A piece counts by its words, lower-cased (A-Z), whatever
    stands between them.
    """
    _, values, ends = cut(text, known)
    n = len(ends)
    counts = _SIXTHS[((values >> np.uint64(1)) & np.uint64(7)).astype(np.int64)]
    if 0 < n < span and counts.sum() >= 6 * min_words:
        span = n  # a whole text of few pieces
    if n < span or not n:
        return len(ends), np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.int64)
    flat = values[counts > 0] & _HASH
    pieces, starts = n, np.concatenate([[0], ends])
    words = np.concatenate([[0], np.cumsum(counts)])[starts]
    ends = np.concatenate([[0], np.cumsum(counts > 0)])[starts]
    sizes = np.diff(ends)
    # a piece's hash: its token hashes, each turned by its place, summed
    turned = mix64(flat + (np.arange(len(flat)) - np.repeat(ends[:-1], sizes)).astype(np.uint64) * _ODD)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(turned, dtype=np.uint64)])
    own = mix64(sums[ends[1:]] - sums[ends[:-1]] + sizes.astype(np.uint64))
    # a run's: the pieces' hashes times powers, summed, and turned back to its start
    with np.errstate(over="ignore"):
        powers, back = known.powers(n)
        chain = np.concatenate([[np.uint64(0)], np.cumsum(own * powers[:n], dtype=np.uint64)])
    at = np.arange(n + 1)
    stop = np.maximum(at + span, np.searchsorted(words, words + 6 * min_words))
    start = np.minimum(at - span, np.searchsorted(words, words - 6 * min_words, side="right") - 1)
    runs = np.unique(np.concatenate([(at * (n + 1) + stop)[stop <= n], (start * (n + 1) + at)[start >= 0]]))
    first, last = runs // (n + 1), runs % (n + 1)
    with np.errstate(over="ignore"):
        out = mix64((chain[last] - chain[first]) * back[first] + (last - first).astype(np.uint64))
    return pieces, first.astype(np.int32), (last - first).astype(np.int32), out.view(np.int64)


def _asked(parts: int):
    """Each chunk's distinct hashes to their partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, spans in zip(batch.column("block").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                keys = np.unique(np.frombuffer(spans, "<u8"))
                cuts = np.searchsorted(partition_of(keys, parts), np.arange(parts + 1)).tolist()
                out = [(p, block, encode_keys(keys[a:b], p, parts, KEY_BYTES)) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), [pa.int64(), pa.int64(), pa.binary()], strict=True)], names=["part", "block", "codes"])

    return run


def _answer(frame: pd.DataFrame) -> pd.DataFrame:
    """One bit for each hash asked for: whether another of this partition's chunks, or a neighbour that looks like it, has it."""
    codes = [decode_keys(x, KEY_BYTES) for x in frame["codes"]]
    flat = np.concatenate(codes)
    order = np.argsort(flat, kind="stable")
    same = flat[order][1:] == flat[order][:-1]
    many = np.empty(len(flat), bool)
    many[order] = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    ends = np.cumsum([len(c) for c in codes]).tolist()
    replies = [np.packbits(many[e - len(c) : e]).tobytes() + len(c).to_bytes(4, "little") for c, e in zip(codes, ends, strict=True)]
    return pd.DataFrame({"block": frame["block"], "part": frame["part"], "answer": replies})


def _recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs whose hash another chunk has, or the chunk has twice."""
    for batch in batches:
        for k in range(batch.num_rows):
            spans = np.frombuffer(batch.column("spans")[k].as_py(), "<u8")
            keys, index, counts = np.unique(spans, return_inverse=True, return_counts=True)
            given = sorted((r["part"], r["answer"]) for r in batch.column("replies")[k].as_py() or [])
            many = np.concatenate([np.unpackbits(np.frombuffer(a[:-4], np.uint8), count=int.from_bytes(a[-4:], "little")) for _, a in given] or [np.empty(0, np.uint8)])
            at = np.flatnonzero((many.astype(bool) | (counts > 1))[index])
            docs = batch.column("doc_id")[k].values
            runs = np.frombuffer(unpack(batch.column("runs")[k].as_py()), "<i4")
            of = pa.array(np.repeat(np.arange(len(docs)), runs[: len(docs)])[at])
            place, size = runs[len(docs) :].reshape(2, -1)
            place = (np.cumsum(place, dtype=np.int64)[at]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([docs.take(of), batch.column("text_key")[k].values.take(of), pa.array(place), pa.array(size[at]), pa.array(spans[at].view(np.int64))], names=["doc_id", "text_key", "place", "size", "span"])


def find_runs(docs: DataFrame, span: int = 3, min_words: int = 12) -> tuple[DataFrame, DataFrame]:
    """Two tables: (doc_id, text_key, place, size) of every run that is not the first of its words, and (doc_id, text_key, pieces) of every text.

    ``place`` counts pieces from 0.  Null texts are in neither.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    keyed = rows.withColumn("text_key", text_key())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokens()
        block = TaskContext.get().partitionId() << 32
        for batch, texts in chunks(batches, "text", 1 << 22):
            pieces, places, many, spans = zip(*(span_hashes(t, span, min_words, known) for t in texts), strict=True)
            sizes = np.array([len(x) for x in places], np.int32)
            steps = np.diff(np.concatenate(places), prepend=np.int32(0))  # small, so they take little
            runs = pack(np.concatenate([sizes, steps, *many]).astype("<i4").tobytes())
            own = np.array([0, len(texts)], np.int32)
            columns = [pa.ListArray.from_arrays(own, c) for c in (batch.column("doc_id"), batch.column("text_key"), pa.array(pieces, pa.int32()))]
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([int(sizes.sum())]), *columns, pa.array([runs]), pa.array([np.concatenate(spans).astype("<i8").tobytes()])], names=["block", "n", "doc_id", "text_key", "pieces", "runs", "spans"])
            block += 1
        known.clear()  # Python workers live on
        release()

    held = written(keyed.mapInArrow(run, CHUNKS), "runs", codec="uncompressed")
    parts = max(1, -(-(held.agg(F.sum("n")).first()[0] or 0) // PART_RUNS))
    asked = held.select("block", "spans").mapInArrow(_asked(parts), "part long, block long, codes binary")
    replies = gathered(asked.groupBy("part").applyInPandas(_answer, "block long, part long, answer binary"))
    spans = written(held.drop("pieces").join(replies, "block", "left").mapInArrow(_recurring, SPANS), "spans")
    each = held.select(F.explode(F.arrays_zip("doc_id", "text_key", "pieces")).alias("d"))
    pieces = written(each.groupBy("d.doc_id", "d.text_key").agg(F.max("d.pieces").alias("pieces")), "pieces")
    forget(held)
    at = F.struct("doc_id", "text_key", "place")
    first = spans.groupBy("span").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first")).where("n > 1").select("span", "first")
    return spans.join(first, "span").where(at != F.col("first")).select("doc_id", "text_key", "place", "size"), pieces


def find_repeats(docs: DataFrame, span: int = 3, min_words: int = 12) -> DataFrame:
    """(doc_id, text_key, place, size) of every run that is not the first of its words."""
    return find_runs(docs, span, min_words)[0]


def remove_repeats(docs: DataFrame, span: int = 3, min_words: int = 12) -> DataFrame:
    """``docs`` with three columns more: its text is what is left, beside ``n_sentences``, ``n_removed`` and ``removed`` (places).

    A document that had sentences and loses all keeps its row with an empty
    text.  Rows with equal id and text are one document and get one result;
    null ids come before others; null text stays null and has no sentences.
    Texts of fewer than ``min_words`` words have no run: copies of them stay.
    Ties cannot stand: a place is one document's own.  Extra columns are
    kept, whatever their names; those with the three names are replaced.

    A text is cut a second time only if something of it goes.
    """
    repeats, pieces = find_runs(docs, span, min_words)
    places = repeats.select("doc_id", "text_key", F.explode(F.sequence("place", F.col("place") + F.col("size") - 1)).alias("place"))
    gone = places.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("place")).alias("removed"))
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"), "removed")
    told = pieces.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_key") == F.col("gone_key")), "left")
    own = [c for c in docs.columns if c not in ("n_sentences", "n_removed", "removed")]
    id_name, key_name, told_id, told_key = fresh([*own, "n_sentences", "removed"], "id", "key", "told_id", "told_key")
    told = told.select(F.col("doc_id").alias(told_id), F.col("text_key").alias(told_key), F.col("pieces").cast("long").alias("n_sentences"), "removed")
    left = docs.select(*[F.col(f"`{c}`") for c in own], F.col("doc_id").cast("long").alias(id_name), text_key().alias(key_name))
    both = left.join(told, F.col(id_name).eqNullSafe(F.col(told_id)) & (F.col(key_name) == F.col(told_key)) & F.col("text").isNotNull(), "left")
    both = both.select(*[F.col(f"`{c}`") for c in own], F.coalesce("n_sentences", F.lit(0)).alias("n_sentences"), "removed")
    schema = docs.select(*[F.col(f"`{c}`") for c in own]).schema.add("n_sentences", "long").add("n_removed", "long").add("removed", ArrayType(IntegerType()))
    names = schema.fieldNames()
    text_at = own.index("text")
    # by number, as a function over Arrow takes no names with dots
    both = both.toDF(*[f"c{k}" for k in range(len(own))], "n_sentences", "removed")
    for k, field in enumerate(schema.fields[: len(own)]):
        field.name = f"c{k}"
    schema.names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Tokens()
        for batch in slices(batches, f"c{text_at}", 1 << 22):
            lost = [r or [] for r in batch.column("removed").to_pylist()]
            texts = batch.column(text_at)
            touched = [k for k, drop in enumerate(lost) if drop]
            if touched:
                out = utf8(batch, f"c{text_at}")
                for k in touched:
                    drop = set(lost[k])
                    tokens, _, ends = cut(out[k], known)
                    at = [0, *ends.tolist()]
                    out[k] = b"".join(t for i in range(len(ends)) if i not in drop for t in tokens[at[i] : at[i + 1]])
                texts = pa.array(out, pa.binary()).cast(pa.string())
            columns = [batch.column(k) for k in range(len(own))]
            columns[text_at] = texts
            sizes = batch.column("n_sentences")
            yield pa.RecordBatch.from_arrays([*columns, sizes, pa.array([len(x) for x in lost], pa.int64()), pa.array(lost, pa.list_(pa.int32()))], names=schema.names)
        known.clear()
        release()

    return both.mapInArrow(run, schema).toDF(*names)
