"""Operator 8: n-gram Jaccard join with token-combination prefixes.

A document's tokens are the 64-bit hashes of its word n-grams.  Tokens fall
into two classes by how many documents index them: a rare one is a signature
by itself, frequent ones only in pairs.  Tokens are ordered rare before
frequent, then by hash.  If two sets reach the threshold, at most d of a set's
n tokens are missing from the other (d = n - ceil(t n)), so a prefix that
counts more than d -- one for a rare token, and for the frequent tokens of one
hash bucket one less than their number -- shares with the other's prefix a
rare token, or two frequent ones of a bucket.  Only such pairs are indexed;
buckets grow with the set's size class, so signatures stay in proportion to
the prefix.  Which class a token is put in (a bitmap of fixed size, by counts
of a first pass) cannot change the result, only the work.

Equal sets are one node from the start.  First each signature that several
nodes share pairs one of them, its centre (the node that shares most), with the
others; pairs are held against a bound from parity bitmaps and then verified on
whole sets.  What is linked needs no further pairs.  The nodes of signatures
that still span several components are then compared with each other, in blocks
of the nodes that have one centre: each block works through its pairs, by the
bitmaps and then on whole sets, and gives a spanning set of the links it finds.
So no link between two components is lost, and no group's pairs are written out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servicelake.llm.common import bitmap, chunks, documents, forget, fresh, in_bitmap, lists, mix64, ngram_hashes, text_key, WordHashes, written
from servicelake.llm.graph import components

_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rule:
    """Sets of ``shingle``-word runs link when ``den`` * intersection >= ``num`` * union (at least one half)."""

    shingle: int = 3
    num: int = 90
    den: int = 100
    frequent_from: int = 16
    block: int = 256

    def needed(self, n: int) -> int:
        """ceil(t n): the fewest of a set's n tokens that a linked set holds."""
        return -(-self.num * n // self.den)

    def classes(self, n: int) -> range:
        """Size classes (powers of two) of the sets that a set of n can link with; linked sets have one in common."""
        return range(self.needed(n).bit_length() - 1, (self.den * n // self.num).bit_length())

    def buckets(self, j: int) -> int:
        """Hash buckets of frequent tokens in size class j; 0: rare and frequent alike index single tokens."""
        return max(1, (self.den - self.num) * (1 << j) // (3 * self.den)) if j > 2 else 0

    def links(self, shared, n_a, n_b):
        return self.den * shared >= self.num * (n_a + n_b - shared)

    def most_apart(self, n_a, n_b):
        """The largest symmetric difference of linked sets of these sizes."""
        both = n_a + n_b
        return both - 2 * (-(-self.num * both // (self.num + self.den)))


def shingle_set(text: bytes, k: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of k words (ASCII lower case, split at ASCII white space); fewer words: of the whole."""
    words = known.of(text.lower().split())
    return np.unique(ngram_hashes(words, min(k, len(words)))) if len(words) else np.empty(0, np.uint64)


def node_of(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def signatures(tokens: np.ndarray, rare: np.ndarray, rule: Rule) -> np.ndarray:
    """The signatures of a set in every size class it can link in."""
    n = len(tokens)
    d = n - rule.needed(n)
    out = []
    for j in rule.classes(n):
        salt = mix64(np.array([j + 1], np.uint64))[0]
        b = rule.buckets(j)
        if not b:
            out.append(mix64(tokens[: d + 1] ^ salt))
            continue
        single = tokens[rare][: d + 1]
        out.append(mix64(single ^ salt))
        if len(single) > d:
            continue
        # frequent tokens, in order, until buckets beyond their first token make up the rest
        common = tokens[~rare]
        bucket = (mix64(common) % np.uint64(b)).astype(np.int64)
        first = np.zeros(len(common), bool)
        first[np.unique(bucket, return_index=True)[1]] = True
        counted = np.cumsum(~first)
        last = int(np.searchsorted(counted, d + 1 - len(single))) + 1
        common, bucket = common[:last], bucket[:last]
        order = np.argsort(bucket, kind="stable")
        common, bucket = common[order], bucket[order]
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=b))
        for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own = common[x:y]
            left, right = np.triu_indices(len(own), 1)
            out.append(mix64((own[left] * _ODD + own[right]) ^ salt))
    return np.concatenate(out)


def parity(tokens: np.ndarray) -> bytes:
    """Bits that each token flips, as many as half the set's size, rounded up to a power of two (64 at least)."""
    bits = 1 << max(6, (len(tokens) // 2 - 1).bit_length())
    return np.packbits((np.bincount((mix64(tokens ^ _ODD) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def apart(a: bytes, b: bytes) -> int:
    """A lower bound of the symmetric difference: differing bits, the longer bitmap folded to the shorter's size."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


# --- passes over the texts -----------------------------------------------------


def _sets(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, text_key, n, node, tokens): each document's set size, node and its d + 1 least tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch, texts in chunks(batches, "text", 1 << 22):
            sets = [shingle_set(t, rule.shingle, known) for t in texts]
            prefixes = [s[: len(s) - rule.needed(len(s)) + 1].view(np.int64) for s in sets]
            columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) for s in sets], pa.int64()), lists(prefixes, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), *columns], names=["doc_id", "text_key", "n", "node", "tokens"])

    return docs.mapInArrow(run, "doc_id long, text_key long, n long, node long, tokens array<long>")


def _signed(docs: DataFrame, rule: Rule, frequent) -> DataFrame:
    """(node, n, bits, signatures) of each document with words; ``frequent``: a broadcast bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for _, texts in chunks(batches, "text", 1 << 22):
            sets = [s for s in (shingle_set(t, rule.shingle, known) for t in texts) if len(s)]
            if sets:
                signed = [signatures(s, ~in_bitmap(frequent.value, s), rule).view(np.int64) for s in sets]
                columns = [pa.array([node_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([parity(s) for s in sets], pa.binary()), lists(signed, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "bits", "signatures"])

    return docs.mapInArrow(run, "node long, n long, bits binary, signatures array<long>")


def _whole_sets(docs: DataFrame, rule: Rule, wanted) -> DataFrame:
    """(node, tokens) of the documents whose text's key is in the broadcast bitmap ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch, texts in chunks(batches, "text", 1 << 22):
            keys = batch.column("text_key").to_numpy(zero_copy_only=False)
            sets = [shingle_set(texts[k], rule.shingle, known) for k in np.flatnonzero(in_bitmap(wanted.value, keys))]
            if sets:
                yield pa.RecordBatch.from_arrays([pa.array([node_of(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "tokens"])

    return docs.mapInArrow(run, "node long, tokens binary").dropDuplicates(["node"])


# --- candidate pairs -------------------------------------------------------------


def _within_bound(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) whose sizes and parity bitmaps allow a link."""
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [batch.column(c).to_pylist() for c in ("n_a", "n_b", "bits_a", "bits_b")]
            keep = [apart(p, q) <= rule.most_apart(m, n) for m, n, p, q in zip(*x, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(a, "a").join(b, "b").mapInArrow(run, "a long, b long")


def _sets_of(nodes: DataFrame, members: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """(node, tokens) of some nodes, written; texts are read again, but worked on only where a node's copy stands."""
    texts = members.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("text_key").alias("text_key"))
    wanted = docs.sparkSession.sparkContext.broadcast(bitmap(texts, "text_key"))
    return written(_whole_sets(docs, rule, wanted).join(nodes, "node", "left_semi"), "sets")


def _verified(pairs: DataFrame, members: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """The pairs that link, on whole sets."""
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _sets_of(nodes, members, docs, rule)
    a = sets.select(F.col("node").alias("a"), F.col("tokens").alias("tokens_a"))
    b = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tokens_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for p, q in zip(batch.column("tokens_a").to_pylist(), batch.column("tokens_b").to_pylist(), strict=True):
                x, y = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                keep.append(bool(rule.links(_shared(x, y), len(x), len(y))))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(a, "a").join(b, "b").mapInArrow(run, "a long, b long")


def _star_pairs(postings: DataFrame, rule: Rule) -> DataFrame:
    """Distinct pairs (a, b) of each signature's centre with its other nodes of fitting sizes."""
    pairs = postings.where("node <> centre.node")
    fit = F.least("n", "centre.n") * rule.den >= F.greatest("n", "centre.n") * rule.num
    return pairs.where(fit).select(F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b")).distinct()


def _open_groups(postings: DataFrame, found: DataFrame | None) -> DataFrame:
    """(centre, node, n, component): the nodes of signatures of three nodes or more that span several components, by centre."""
    if found is None:
        known = postings.withColumn("component", F.col("node"))
    else:
        known = postings.join(found.withColumnRenamed("component", "known"), "node", "left").withColumn("component", F.coalesce("known", "node"))
    several = known.groupBy("signature").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("size")).where("least <> most and size > 2")
    return known.join(several, "signature").select(F.col("centre.node").alias("centre"), "node", "n", "component").distinct()


def _dealt(groups: DataFrame, rule: Rule) -> DataFrame:
    """Rows (centre, low, high, unit, node, n, component) of every pair of units of a group that can hold an open pair.

    A group's nodes are dealt into units of about ``block``, those of its
    largest component apart from the others, so no pair of units grows with the group.
    """
    sizes = groups.groupBy("centre", "component").agg(F.count(F.lit(1)).alias("k"))
    top = sizes.groupBy("centre").agg(F.max(F.struct("k", "component")).alias("t"), F.sum("k").alias("size"))
    units = lambda k: F.greatest(F.ceil(k / rule.block), F.lit(1)).cast("int")
    rows = groups.join(top, "centre").withColumns({"n_top": units(F.col("t.k")), "n_rest": units(F.col("size") - F.col("t.k")), "in_top": F.col("component") == F.col("t.component")})
    spread = F.xxhash64("node")
    rows = rows.withColumn("unit", F.when(F.col("in_top"), F.pmod(spread, F.col("n_top"))).otherwise(F.col("n_top") + F.pmod(spread, F.col("n_rest"))).cast("int"))
    others = F.when(F.col("in_top"), F.sequence("n_top", F.col("n_top") + F.col("n_rest") - 1)).otherwise(F.sequence(F.lit(0), F.col("n_top") + F.col("n_rest") - 1))
    dealt = rows.where("size > t.k").select("centre", "node", "n", "component", "unit", F.explode(others).alias("other"))
    return dealt.withColumns({"low": F.least("unit", "other"), "high": F.greatest("unit", "other")}).drop("other")


def close_pairs(n: np.ndarray, component: np.ndarray, unit: np.ndarray, bits: list[bytes], rule: Rule) -> np.ndarray:
    """Index pairs (i, k, least distance) of two units (or one) in different components that sizes and bitmaps let link."""
    low, high = unit.min(), unit.max()
    found = [np.empty((0, 3), np.int64)]
    length = np.array([len(b) for b in bits])
    for size in np.unique(length):
        # bitmaps at least this long, folded to its length; each pair is met where the shorter of its two stands
        own = np.flatnonzero(length >= size)
        folded = np.zeros((len(own), size), np.uint8)
        for row, k in enumerate(own.tolist()):
            b = np.frombuffer(bits[k], np.uint8)
            folded[row] = np.bitwise_xor.reduce(b.reshape(-1, size), 0)
        for row, i in enumerate(own.tolist()):
            if length[i] != size:
                continue
            fit = (component[own] != component[i]) & (np.minimum(n[own], n[i]) * rule.den >= np.maximum(n[own], n[i]) * rule.num)
            if low != high:
                fit &= unit[own] != unit[i]
            fit &= (length[own] > size) | (own > i)
            rows = np.flatnonzero(fit)
            if len(rows):
                differ = np.bitwise_count(folded[rows] ^ folded[row]).sum(1).astype(np.int64)
                both = n[own[rows]] + n[i]
                keep = differ <= both - 2 * (-(-rule.num * both // (rule.num + rule.den)))
                if keep.any():
                    found.append(np.stack([np.full(keep.sum(), i), own[rows[keep]], differ[keep]], 1))
    return np.concatenate(found)


def spanning_links(component: np.ndarray, pairs: np.ndarray, sets: list[np.ndarray], rule: Rule) -> list[tuple[int, int]]:
    """Links among the pairs that join what is not joined yet, nearest pairs first."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    links = []
    for i, k, _ in pairs[np.argsort(pairs[:, 2], kind="stable")].tolist():
        a, b = top(int(component[i])), top(int(component[k]))
        if a != b and rule.links(_shared(sets[i], sets[k]), len(sets[i]), len(sets[k])):
            parent[a] = b
            links.append((i, k))
    return links


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    both = np.sort(np.concatenate([x, y]), kind="stable")
    return int((both[1:] == both[:-1]).sum())


def _remaining_links(groups: DataFrame, nodes: DataFrame, members: DataFrame, docs: DataFrame, rule: Rule, bucket_rows: int = 40_000) -> DataFrame:
    """Links (a, b) between components among the nodes of each group, enough to join all that links join."""
    dealt = written(_dealt(groups, rule).join(nodes.select("node", "bits"), "node"), "dealt")
    buckets = max(1, -(-dealt.count() // bucket_rows))
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("centre", "low", "high"), F.lit(buckets)))
    key = ["centre", "low", "high"]

    def near(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, own in frame.groupby(key, sort=False):
            columns = [own[c].to_numpy() for c in ("n", "component", "unit")]
            pairs = close_pairs(*columns, own["bits"].tolist(), rule)
            if len(pairs):
                out.append(own.iloc[np.unique(pairs[:, :2])])
        return pd.concat(out) if out else frame.iloc[:0]

    schema = "node long, centre long, n long, component long, unit int, low int, high int, bits binary"
    near_rows = written(dealt.groupBy("bucket").applyInPandas(lambda frame: near(frame)[schema_names(schema)], schema), "near")
    sets = _sets_of(near_rows.select("node").distinct(), members, docs, rule)

    def verify(frame: pd.DataFrame) -> pd.DataFrame:
        n, component, unit, node = (frame[c].to_numpy() for c in ("n", "component", "unit", "node"))
        pairs = close_pairs(n, component, unit, frame["bits"].tolist(), rule)
        links = spanning_links(component, pairs, [np.frombuffer(t, np.uint64) for t in frame["tokens"]], rule)
        return pd.DataFrame([(node[i], node[k]) for i, k in links], columns=["a", "b"], dtype="int64")

    return near_rows.join(sets, "node").groupBy(*key).applyInPandas(verify, "a long, b long")


def schema_names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def link_sets(docs: DataFrame, rule: Rule = Rule()) -> tuple[DataFrame, DataFrame]:
    """(members, components): (doc_id, text_key, n, node) of every document, and (node, component) of every linked node."""
    rows = documents(docs).withColumn("text_key", text_key())
    prefixes = written(_sets(rows, rule), "prefixes")
    members = written(prefixes.drop("tokens"), "members")
    counts = prefixes.where("n > 0").groupBy("node").agg(F.first("tokens").alias("tokens")).select(F.explode("tokens").alias("token")).groupBy("token").count()
    frequent = rows.sparkSession.sparkContext.broadcast(bitmap(counts.where(F.col("count") > rule.frequent_from), "token"))
    forget(prefixes)
    signed = written(_signed(rows, rule, frequent), "signed")
    nodes = written(signed.select("node", "n", "bits").dropDuplicates(["node"]), "nodes")
    postings = signed.select(F.explode("signatures").alias("signature"), "node", "n")
    shared = postings.groupBy("signature").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most").select("signature")
    postings = written(postings.join(shared, "signature").distinct(), "postings")
    forget(signed)
    weights = postings.groupBy("node").agg(F.count(F.lit(1)).alias("weight"))
    weighted = postings.join(weights, "node")
    centres = weighted.groupBy("signature").agg(F.max(F.struct("weight", "node", "n")).alias("centre"))
    plain, postings = postings, written(weighted.drop("weight").join(centres, "signature"), "centred")
    forget(plain)

    links = found = None
    close = written(_within_bound(_star_pairs(postings, rule), nodes, rule), "close")
    if not close.isEmpty():
        links = written(_verified(close, members, rows, rule), "links")
        found = written(components(links), "components")
    groups = written(_open_groups(postings, found), "groups")
    if not groups.isEmpty():
        more = written(_remaining_links(groups, nodes, members, rows, rule), "links")
        if not more.isEmpty():
            links = more if links is None else links.unionByName(more)
            found = written(components(links), "components")
    if found is None:
        found = rows.sparkSession.createDataFrame([], "node long, component long")
    return members, found


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document: the smallest doc_id that links lead to, its own included.

    Null or wordless texts have no shingles and link with nothing.  Repeated
    rows are copies and linked; documents without an id link like others, and
    a group of such alone has a null component_id.  Other columns are ignored.
    """
    members, found = link_sets(docs, rule)
    known = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = known.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    linked = known.where("n > 0").join(least, "component").select("doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))
    return linked.unionByName(known.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The rows of ``docs``, all columns, of one document of each group: the smallest id (null after all), then text hash.

    Rows without words are no group's and stay; of rows with equal id and text one stays.
    """
    own = docs.columns
    members, found = link_sets(docs, rule)
    known = members.join(found, "node", "left").withColumn("group", F.coalesce("component", "node"))
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("text_key").alias("key"))
    first = known.where("n > 0").groupBy("group").agg(F.min(rank).alias("first")).select("first.*")
    kept = first.unionByName(known.where("n = 0").select(rank.alias("first")).select("first.*").distinct())
    keys = ["no_id", "id", "key"]
    names = fresh(own, *keys)
    doc_id = F.col("doc_id").cast("long")
    keyed = docs.withColumns(dict(zip(names, [doc_id.isNull(), F.coalesce(doc_id, F.lit(0)), text_key()], strict=True)))
    return keyed.join(kept.toDF(*names), names, "left_semi").dropDuplicates(names).select(*[F.col(f"`{c}`") for c in own])
