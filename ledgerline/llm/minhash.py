"""Near-duplicate documents by SuperMinHash signatures, banding, verification on full sets and union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerline.llm.common import (
    LOWER, components, cut, groups, mix64, prefix_hashes, row_key, shingles, span_hashes, text_of, text_slices, words,
)
from ledgerline.operators.joins import join_per_key

#: Words of a shingle, and the similarity in percent from which documents are linked.
WIDTH = 5
PERCENT = 80

#: Ranks of a signature, in bands of so many. At similarity 0.8 a pair shares no band with probability 5e-8.
RANKS = 128
BAND = 4

#: Pairs whose signatures agree in fewer ranks are not verified: five standard deviations below 0.8.
LEAST_AGREEING = 80

#: Members of a family that are compared with each other at a time.
BLOCK = 1024

_CHUNK = 1 << 16
_UNSET = np.uint32(0xFFFFFFFF)


def distinct_shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document of a slice, one after another, and where each one's begin.

    A-Z count as a-z. A document of fewer words than a shingle has all of them as its one shingle.
    """
    low = LOWER[data]
    starts, ends, first = words(low, offsets)
    hashed = span_hashes(prefix_hashes(low), starts, ends)
    values, doc = shingles(hashed, first, width)
    n_docs = len(offsets) - 1
    n_words = np.diff(first)
    short = np.flatnonzero((n_words > 0) & (n_words < width))
    single = np.zeros(len(short), np.uint64)
    for k in range(width - 1):
        has = n_words[short] > k
        single[has] = mix64(single[has] * np.uint64(31) + hashed[first[short[has]] + k] + np.uint64(k + 1))
    doc, values = np.concatenate([doc, short]), np.concatenate([values, single])
    order = np.argsort(doc, kind="stable")
    doc, values = doc[order], values[order]
    bounds = np.searchsorted(doc, np.arange(n_docs + 1))
    for a, b in zip(bounds[:-1], bounds[1:]):
        values[a:b].sort()
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    return values[new], np.searchsorted(doc[new], np.arange(n_docs + 1))


def super_min_hash(values: np.ndarray, bounds: np.ndarray, n: int = RANKS) -> np.ndarray:
    """Signatures (documents x n) of sets of 64-bit values.

    Each element walks its own random permutation of the ranks; at step j it offers j + r, with r in [0, 1), to the
    rank it meets. As step j offers nothing below j, a document stops as soon as all its ranks are below j + 1: after a
    few steps for sets larger than n. Entries are fixed-point numbers, j in the high 8 bits.
    """
    n_docs = len(bounds) - 1
    out = np.full((n_docs, n), _UNSET, np.uint32)
    start = 0
    while start < n_docs:
        end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + _CHUNK, "right")) - 1)
        _sign(values[bounds[start] : bounds[end]], np.repeat(np.arange(end - start), np.diff(bounds[start : end + 1])), out[start:end])
        start = end
    return out


def _sign(values: np.ndarray, doc: np.ndarray, out: np.ndarray) -> None:
    n = out.shape[1]
    flat = out.reshape(-1)
    order = np.tile(np.arange(n, dtype=np.uint8), (len(values), 1))
    active = np.arange(len(values))
    for j in range(n):
        random = mix64(values[active] + np.uint64((j + 1) * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
        other = j + ((random & np.uint64(0xFFFFFFFF)) * np.uint64(n - j) >> np.uint64(32)).astype(np.int64)
        met = order[active, other]
        order[active, other] = order[active, j]
        offer = np.uint32(j << 24) | (random >> np.uint64(40)).astype(np.uint32)
        np.minimum.at(flat, doc[active] * n + met, offer)
        unfinished = (out >> np.uint32(24)).max(axis=1) > j
        active = active[unfinished[doc[active]]]
        if not len(active):
            break


def profiles(docs: DataFrame, width: int, with_set: bool = False) -> DataFrame:
    """Columns of ``docs`` but text, with n_shingles, the set's digest (s1, s2) and signature[, shingles as binary]."""
    kept = [c for c in docs.columns if c != "text"]

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in text_slices(batch):
                values, bounds = distinct_shingles(data, offsets, width)
                signed = super_min_hash(values, bounds)
                sums = []
                for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
                    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(values ^ np.uint64(salt)), dtype=np.uint64)])
                    sums.append((running[bounds[1:]] - running[bounds[:-1]]).view(np.int64))
                arrays = [batch.column(batch.schema.get_field_index(c)).slice(begin, end - begin) for c in kept]
                arrays += [pa.array(np.diff(bounds)), *map(pa.array, sums), pa.array([s.tobytes() for s in signed], pa.binary())]
                if with_set:
                    arrays.append(pa.array([values[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names)

    names = [*kept, "n_shingles", "s1", "s2", "signature", *["shingles"] * with_set]
    types = dict(docs.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in kept) + ", n_shingles long, s1 long, s2 long, signature binary" + ", shingles binary" * with_set
    return docs.select(*kept, "text").mapInArrow(profile, schema)


def bands(signed: DataFrame) -> DataFrame:
    """(band, node): one row for each band of each signature of (node, signature)."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(batch.num_rows, -1, BAND).astype(np.uint64)
            key = np.broadcast_to(np.arange(1, matrix.shape[1] + 1, dtype=np.uint64), matrix.shape[:2])
            for k in range(BAND):
                key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + matrix[:, :, k])
            nodes = np.repeat(batch.column(0).to_numpy(), matrix.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(nodes)], ["band", "node"])

    return signed.select("node", "signature").mapInArrow(split, "band long, node long")


def families(signed: DataFrame) -> DataFrame:
    """(node, family, size) of nodes that share a band with another, directly or through others.

    Each bucket is a star around its smallest node, so a bucket of n nodes gives n - 1 edges.
    """
    placed = bands(signed)
    centres = placed.groupBy("band").agg(F.min("node").alias("centre"), F.count("*").alias("n")).where("n > 1").drop("n")
    edges = join_per_key(placed, centres, ["band"]).where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    found = cut(components(edges).withColumnRenamed("id", "node").withColumnRenamed("component", "family"))
    sizes = found.groupBy("family").agg(F.count("*").alias("size"))
    return found.join(sizes, "family")


class Union:
    """Union-find over the members of one group."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, a: int) -> int:
        while self.parent[a] != a:
            self.parent[a] = self.parent[self.parent[a]]
            a = self.parent[a]
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def linked(sets: list[np.ndarray], signed: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Verified links that connect the members of a group as all its links do.

    Pairs are taken by falling agreement of their signatures; a pair that is already connected is passed over. Where
    the group holds two blocks, only pairs across them are looked at. Agreements are a byte a pair, and only the open pairs of
    one agreement are listed: a family of close copies has nearly all its pairs among the candidates.
    """
    cross = side.any() and not side.all()
    ranks = signed.shape[1]
    agree = np.zeros((len(sets), len(sets)), np.min_scalar_type(ranks))
    for a in range(len(sets) - 1):
        agree[a, a + 1 :] = (signed[a + 1 :] == signed[a]).sum(axis=1) * ((side[a + 1 :] != side[a]) | (not cross))
    union, out = Union(len(sets)), []
    for level in range(ranks, LEAST_AGREEING - 1, -1):
        root = np.array([union.find(k) for k in range(len(sets))])
        for a in np.flatnonzero((agree == level).any(axis=1)).tolist():
            near = np.flatnonzero(agree[a] == level)
            for b in near[root[near] != root[a]].tolist():
                if union.find(a) == union.find(b):
                    continue
                x, y = sets[a], sets[b]
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    union.join(a, b)
                    out.append((a, b))
    return out


def links(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): verified links between the nodes of each family, enough to connect all that are connected.

    ``members``: node, id, family, size, signature, shingles. A family is dealt over blocks by hash, and each pair of
    blocks is compared in one group of at most about 2 x BLOCK members; no pair is sent anywhere.
    """
    blocks = members.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    dealt = blocks.withColumn("own", F.pmod(F.hash("node", F.lit("block")), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keyed = dealt.select(
        "family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "id",
        (F.col("own") > F.col("other")).alias("side"), "signature", "shingles",
    )
    keys = ["family", "i", "j"]

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in groups(frames, keys):
            group = group.drop_duplicates("node")
            if len(group) < 2:
                continue
            signed = np.frombuffer(b"".join(group["signature"]), np.uint32).reshape(len(group), -1)
            found = linked([np.frombuffer(s, np.uint64) for s in group["shingles"]], signed, group["side"].to_numpy(bool), percent)
            ids = group["id"].to_numpy()
            if found:
                yield pd.DataFrame({"a": [ids[a] for a, _ in found], "b": [ids[b] for _, b in found]})

    return keyed.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, row_key, n_shingles, component_id), one row per input row.

    Documents are linked whose sets of distinct word shingles have 100 x intersection >= percent x union; component_id
    is the smallest doc_id reached by links, itself included. Equal sets are first merged into one node. Documents
    without words, null texts among them, and rows without a doc_id are linked with nothing (their component is
    their own doc_id). Rows of one doc_id belong together. An empty table gives an empty table. Other columns are
    not read.
    """
    base = docs.select(docs["doc_id"].cast("long").alias("doc_id"), row_key(docs).alias("row_key"), text_of(docs).alias("text"))
    known = cut(profiles(base, width))
    full = known.where("n_shingles > 0 AND doc_id IS NOT NULL").withColumn("node", F.xxhash64("s1", "s2", "n_shingles"))
    first = full.groupBy("node").agg(F.min(F.struct("doc_id", "row_key", "signature")).alias("m")).select("node", "m.*")
    first = cut(first)
    grouped = families(first)
    wanted = first.drop("signature").join(grouped, "node")
    texts = base.join(wanted, ["doc_id", "row_key"]).withColumnRenamed("doc_id", "id").drop("row_key")
    edges = links(profiles(texts, width, with_set=True), percent)
    same = full.join(first.select("node", F.col("doc_id").alias("b")), "node").where("doc_id <> b").select(F.col("doc_id").alias("a"), "b")
    found = components(edges.union(same)).select(F.col("id").alias("_id"), "component")
    out = known.join(found, known["doc_id"] == found["_id"], "left")
    return out.select("doc_id", "row_key", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def without_near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The documents, with their columns, that stand for their component; rows without a doc_id stay.

    Rows that repeat a doc_id and its text are copies: the one with the smallest digest of all columns stays. Rows that
    repeat a doc_id with another text are no copies of each other, and all of them stay if their doc_id does.
    """
    lost = near_duplicates(docs, width, percent).where("doc_id <> component_id").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").join(lost, "doc_id", "left_anti").select(*docs.columns)
    keys = {"__h1": row_key(named), "__h2": F.xxhash64(F.lit(7), text_of(named)), "__row": F.xxhash64(*named.columns)}
    first = F.row_number().over(Window.partitionBy("doc_id", "__h1", "__h2").orderBy("__row"))
    once = named.withColumns(keys).withColumn("__place", first).where("__place = 1")
    return once.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))
