import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from servicelake.llm import packing, token_files
from servicelake.llm.tokens import DEFAULT_TOKENIZER, Encoder, encoder, tokenizer_path

from .helpers import clashing, corpus, frame


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(DEFAULT_TOKENIZER))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_encoder_equals_the_library(library):
    rng = random.Random(4)
    texts = ["", " ", "  ", "a  b", " a", "a ", "\n", "a\n b", "a \nb", "x<|endoftext|>y", "it's 'll", "é ñ  z", "a　b c", "a\x1f b", "a\x1cb c", "a\x85 b", "a  b"]
    texts += ["".join(rng.choice(" \n\ta'sl1!é .,\x85") for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    for _ in range(2):
        ids, ends = encoder(DEFAULT_TOKENIZER).encode(pa.array(texts), 7)
        parts = np.split(ids, ends[:-1])
        assert [p.tolist() for p in parts] == [[*ids_of(library, t), 7] for t in texts]


def test_forgetting_keeps_results(library):
    from servicelake.llm.tokens import Encoder

    small = Encoder(DEFAULT_TOKENIZER, most=50)
    rows = [r[1] or "" for r in corpus(3)]
    for _ in range(60):
        ids, ends = small.encode(pa.array(rows[:20]))
        assert ends[-1] == sum(len(ids_of(library, t)) for t in rows[:20])
    assert len(small.known) <= 2000


@pytest.mark.parametrize("block", [(1 << 21, 1 << 15), (5000, 7)])
def test_pieces_hold_every_id_once(spark, library, block):
    rows = corpus(1)
    pieces = packing.pack(clashing(frame(spark, rows), "ids", "length"), block_tokens=block[0], block_docs=block[1])
    found = packing.digest(pieces).collect()
    want = defaultdict(list)
    for doc_id, text, *_ in rows:
        want[doc_id].append([*ids_of(library, text), 1])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(want)
    for doc_id, own in by_doc.items():
        copies = want[doc_id]
        assert sum(r["length"] for r in own) == sum(map(len, copies))
        for r in own:
            assert any(r["doc_tokens"] == len(c) and r["ids_crc32"] == crc(c[r["start"] : r["start"] + r["length"]]) for c in copies)
        if len(copies) == 1:
            starts = sorted((r["start"], r["length"]) for r in own)
            assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and sum(n for _, n in starts) == len(copies[0])
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        at = 0
        for r in own:
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at == own[0]["capacity"] <= 2048 and at & (at - 1) == 0


def test_descending_documents_go_to_the_cheapest_sequence():
    lengths = np.array([6, 5, 3, 2, 8, 20])
    d, start, length, sequence, offset, size, cost = packing.pack_block(lengths, 8)
    placed = list(zip(d.tolist(), start.tolist(), length.tolist(), sequence.tolist()))
    assert placed[:3] == [(4, 0, 8, 0), (5, 0, 8, 1), (5, 8, 8, 2)]
    assert placed[3][:3] == (0, 0, 6) and placed[4][:3] == (1, 0, 5)
    assert length.sum() == lengths.sum() and set(size.tolist()) <= {8, 4}
    # the documents that share sequences spread their attention cost
    rng = np.random.default_rng(1)
    *_, sequence, _, size, cost = packing.pack_block(rng.integers(1, 900, 4000), 2048)
    whole = {s: c for s, c, n in zip(sequence.tolist(), cost.tolist(), size.tolist()) if n == 2048}
    assert np.std(list(whole.values())) < 0.15 * np.mean(list(whole.values()))


def test_packing_nothing(spark):
    assert packing.pack(frame(spark, [])).count() == 0
    assert [tuple(r)[:3] for r in packing.pack(frame(spark, [(None, None, None, None, None)])).collect()] == [(None, 0, 1)]
    with pytest.raises(ValueError):
        packing.pack(frame(spark, []), capacity=1000)


@pytest.mark.parametrize("parts", [None, 5])
def test_files_round_trip(spark, library, tmp_dir, parts):
    rows = corpus(2)
    token_files.write_tokens(clashing(frame(spark, rows), "part", "ids"), f"{tmp_dir}/t", parts=parts, row_group_bytes=1 << 20, page_rows=10)
    found = sorted(token_files.catalogue(spark, f"{tmp_dir}/t").collect(), key=lambda r: r["start"])
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    want = sorted((str(d), len(x := [*ids_of(library, t), 2]), crc(x)) for d, t, *_ in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in found) == want


def test_ranges_follow_the_text_and_a_hot_id_is_spread(spark, library, tmp_dir, monkeypatch):
    rows = [(k if k % 2 else 7, f"text {k} " + "word " * (k % 11), None, None, None) for k in range(600)]
    monkeypatch.setattr(token_files, "RANGE_BYTES", 1500)
    token_files.write_tokens(frame(spark, rows), f"{tmp_dir}/t")
    stored = token_files.read_tokens(spark, f"{tmp_dir}/t", ["part", "doc_id"]).collect()
    size = sum(len(r[1]) for r in rows)
    assert size // 1500 // 2 < len({r["part"] for r in stored}) <= size // 1500 + 1
    assert len({r["part"] for r in stored if r["doc_id"] == 7}) > 3
    found = sorted(token_files.catalogue(spark, f"{tmp_dir}/t").collect(), key=lambda r: r["start"])
    assert [r["start"] for r in found] == np.cumsum([0, *(r["n_tokens"] for r in found[:-1])]).tolist()
    assert [r["doc_id"] for r in found] == sorted(r[0] for r in rows)
    assert sorted(r["ids_crc32"] for r in found) == sorted(crc([*ids_of(library, r[1]), 2]) for r in rows)


def test_a_full_memory_changes_no_ids(library):
    rng = np.random.default_rng(1)
    own = Encoder(DEFAULT_TOKENIZER, most=50)
    for _ in range(60):
        texts = [" ".join(rng.choice(["word", "word.", "Word,", "x1.", "..", "a,b", "é.", "日本", "long" * 9], 30)) + f" w{rng.integers(99)}" for _ in range(4)]
        ids, ends = own.encode(pa.array(texts), 2)
        assert [x.tolist() for x in np.split(ids, ends)[:-1]] == [[*ids_of(library, t), 2] for t in texts]
        assert len(own.known) <= 50


def test_selective_reads(spark, library, tmp_dir):
    rows = [(k, f"text {k} " + "word " * k, None, None, None) for k in range(300)]
    token_files.write_tokens(frame(spark, rows), f"{tmp_dir}/t", parts=2)
    some = token_files.read_tokens(spark, f"{tmp_dir}/t", ["doc_id", "ids"], "doc_id between 7 and 9")
    assert sorted((r["doc_id"], list(r["ids"])) for r in some.collect()) == [(k, [*ids_of(library, rows[k][1]), 2]) for k in (7, 8, 9)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,7), LessThanOrEqual(doc_id,9)]" in plan
    assert "n_tokens" not in token_files.read_tokens(spark, f"{tmp_dir}/t", ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    import glob

    import pyarrow.parquet as pq

    for path in glob.glob(f"{tmp_dir}/t/part-*.parquet"):
        meta = pq.ParquetFile(path).metadata
        for g in range(meta.num_row_groups):
            column = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for c in range(meta.num_columns)}
            assert all(c.has_column_index and c.has_offset_index for c in column.values())
            assert any("DICTIONARY" in e for e in column["ids.list.element"].encodings)


def test_no_rows_in_files(spark, tmp_dir):
    token_files.write_tokens(frame(spark, []), f"{tmp_dir}/t")
    assert token_files.catalogue(spark, f"{tmp_dir}/t").count() == 0


def test_packing_encodes_in_small_slices(spark):
    """What a worker holds besides its block follows the slice; the pieces do not depend on it."""
    import inspect

    from servicelake.llm import packing

    assert inspect.signature(packing.pack).parameters["slice_bytes"].default <= 1 << 22
    docs = spark.createDataFrame([(k, " ".join(f"word{k * j}" for j in range(60))) for k in range(40)], "doc_id long, text string").coalesce(1)
    one, many = (sorted(map(tuple, packing.digest(packing.pack(docs, 64, slice_bytes=n)).collect())) for n in (1 << 22, 100))
    assert one == many and len({r[0] for r in one}) == 40
