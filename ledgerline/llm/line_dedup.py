"""Reversible line de-duplication: exact reference counts per line, with sharded cuckoo filters in front."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import SPACES, cut, mix64, row_key, text_of

#: Keys of at least so many code points count.
MIN_CHARS = 40

#: Keys found in at least so many documents are dropped from all but the last of them.
MIN_DOCS = 5

#: Keys for which a filter shard is laid out; a shard that fills up is laid out anew with twice the buckets.
SHARD_KEYS = 1 << 15

#: Filters are broadcast to the scan up to so many bytes in all. Beyond it the exact join does the work alone.
BROADCAST_BYTES = 64 << 20

SLOTS = 4
MAX_KICKS = 500


class CuckooFilter:
    """A set of 64-bit keys as 16-bit fingerprints in buckets of four, with deletion.

    A fingerprint lies in one of two buckets, each the other's partner by the fingerprint's hash. Lookups have no
    false negatives. ``table`` is the whole state.
    """

    def __init__(self, buckets: int, table: np.ndarray | None = None):
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), np.uint16) if table is None else table

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        need = max(2, int(np.ceil(n / SLOTS / 0.8)))
        return cls(1 << (need - 1).bit_length())

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        spread = mix64(keys.astype(np.uint64))
        prints = (spread >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (spread & np.uint64(self.buckets - 1)).astype(np.int64)
        return prints, first, self._partner(first, prints)

    def _partner(self, bucket, prints):
        step = mix64(np.asarray(prints, np.uint64)) & np.uint64(self.buckets - 1)
        return (np.asarray(bucket, np.uint64) ^ step).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(keys)
        return ((self.table[first] == prints[:, None]) | (self.table[second] == prints[:, None])).any(axis=1)

    def insert(self, keys: np.ndarray) -> bool:
        """False if the filter is full; it must then be laid out anew from the exact table."""
        for mark, one, two in zip(*self._places(keys)):
            if not (self._put(one, mark) or self._put(two, mark) or self._kick(two, mark)):
                return False
        return True

    def _put(self, bucket: int, mark: int) -> bool:
        free = np.flatnonzero(self.table[bucket] == 0)
        if len(free):
            self.table[bucket, free[0]] = mark
        return len(free) > 0

    def _kick(self, bucket: int, mark: int) -> bool:
        for n in range(MAX_KICKS):
            slot = n % SLOTS
            mark, self.table[bucket, slot] = self.table[bucket, slot], mark
            bucket = int(self._partner(bucket, mark))
            if self._put(bucket, mark):
                return True
        return False

    def delete(self, keys: np.ndarray) -> None:
        """Takes out one fingerprint per key. Only keys that were inserted may be deleted."""
        for mark, one, two in zip(*self._places(keys)):
            for bucket in (one, two):
                found = np.flatnonzero(self.table[bucket] == mark)
                if len(found):
                    self.table[bucket, found[0]] = 0
                    break


def line_key(line: Column) -> Column:
    """The line with spaces stripped at both ends and A-Z lower-cased."""
    upper = "".join(map(chr, range(65, 91)))
    return F.trim(F.translate(line, upper, upper.lower()), F.lit(SPACES))


def postings(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, row_key, pos, h1, h2) of every line whose key is long enough; h1, h2 are the key's 128-bit digest.

    Rows without a doc_id are no documents: their lines are not counted.
    """
    lines = docs.where("doc_id IS NOT NULL").select(
        "doc_id", row_key(docs).alias("row_key"), F.posexplode(F.split(text_of(docs), "\n", -1)).alias("pos", "line")
    )
    keyed = lines.select("doc_id", "row_key", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keyed.select("doc_id", "row_key", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


def _counted(lines: DataFrame) -> DataFrame:
    """(h1, h2, n_docs, last_doc). The distinct documents are summed in two steps, so a hot line is no hot task."""
    pairs = lines.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
    return pairs.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))


FILTERS = "shard int, buckets int, n_keys long, bits binary"


@dataclass(frozen=True)
class LineIndex:
    """The lines of the documents inserted so far.

    ``lines``: postings; ``counts``: exact reference counts (h1, h2, n_docs, last_doc); ``filters``: one cuckoo filter
    per shard over the keys that reach ``min_docs``. All three are tables in the shared folder; a change gives a new
    index and leaves the old one as it is.
    """

    lines: DataFrame
    counts: DataFrame
    filters: DataFrame
    shards: int
    min_docs: int = MIN_DOCS
    min_chars: int = MIN_CHARS

    @classmethod
    def build(cls, docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, shard_keys: int = SHARD_KEYS) -> LineIndex:
        """The index of a first batch. The shard count follows the number of repeated keys."""
        lines = cut(postings(docs, min_chars))
        counts = cut(_counted(lines))
        heavy = counts.where(F.col("n_docs") >= min_docs)
        shards = max(1, -(-heavy.count() // shard_keys))
        none = docs.sparkSession.createDataFrame([], FILTERS)
        return cls(lines, counts, cls._updated(none, heavy, heavy.limit(0), heavy, shards), shards, min_docs, min_chars)

    @staticmethod
    def _shard(shards: int) -> Column:
        return F.pmod(F.col("h2"), F.lit(shards)).cast("int").alias("shard")

    @classmethod
    def _updated(cls, filters: DataFrame, up: DataFrame, down: DataFrame, heavy: DataFrame, shards: int) -> DataFrame:
        """Filters after inserting the keys of ``up`` and deleting those of ``down``; full shards are laid out anew."""

        def change(key: tuple, old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
            added = keys.loc[keys["up"], "h1"].to_numpy(np.int64).view(np.uint64)
            removed = keys.loc[~keys["up"], "h1"].to_numpy(np.int64).view(np.uint64)
            n = (int(old["n_keys"].iloc[0]) if len(old) else 0) + len(added) - len(removed)
            if len(old):
                size = int(old["buckets"].iloc[0])
                table = CuckooFilter(size, np.frombuffer(old["bits"].iloc[0], np.uint16).reshape(size, SLOTS).copy())
            else:
                table = CuckooFilter.for_keys(n)
            table.delete(removed)
            whole = table.insert(added)
            return pd.DataFrame({"shard": [key[0]], "buckets": [table.buckets if whole else -table.buckets], "n_keys": [n], "bits": [table.table.tobytes()]})

        def relay(key: tuple, keys: pd.DataFrame) -> pd.DataFrame:
            own = keys["h1"].to_numpy(np.int64).view(np.uint64)
            size = int(keys["buckets"].iloc[0]) * 2
            table = CuckooFilter(size)
            while not table.insert(own):
                size *= 2
                table = CuckooFilter(size)
            return pd.DataFrame({"shard": [key[0]], "buckets": [size], "n_keys": [len(own)], "bits": [table.table.tobytes()]})

        changes = up.select("h1", cls._shard(shards), F.lit(True).alias("up")).union(
            down.select("h1", cls._shard(shards), F.lit(False).alias("up"))
        )
        tried = cut(filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(change, FILTERS))
        full = tried.where("buckets < 0").select("shard", (-F.col("buckets")).alias("buckets"))
        anew = heavy.select("h1", cls._shard(shards)).join(full, "shard").groupBy("shard").applyInPandas(relay, FILTERS)
        return cut(tried.where("buckets > 0").union(anew))

    def _crossed(self, before: DataFrame, after: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Keys that reach ``min_docs`` by a change of their counts, and keys that no longer do."""
        old, new = (f.select("h1", "h2", (F.col("n_docs") >= self.min_docs).alias(n)) for f, n in ((before, "was"), (after, "is")))
        both = cut(old.join(new, ["h1", "h2"], "full").fillna(False, ["was", "is"]))
        return both.where("is AND NOT was"), both.where("was AND NOT is")

    def _with(self, lines: DataFrame, counts: DataFrame, before: DataFrame, after: DataFrame) -> LineIndex:
        up, down = self._crossed(before, after)
        heavy = counts.where(F.col("n_docs") >= self.min_docs)
        filters = self._updated(self.filters, up, down, heavy, self.shards)
        return LineIndex(lines, counts, filters, self.shards, self.min_docs, self.min_chars)

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with more documents. Their ids must be new to it."""
        fresh = cut(postings(docs, self.min_chars))
        delta = cut(_counted(fresh))
        touched = self.counts.join(delta.select("h1", "h2"), ["h1", "h2"], "left_semi")
        counts = cut(
            self.counts.unionByName(delta).groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))
        )
        after = counts.join(delta.select("h1", "h2"), ["h1", "h2"], "left_semi")
        return self._with(cut(self.lines.unionByName(fresh)), counts, touched, after)

    def delete(self, ids: DataFrame) -> LineIndex:
        """The index without the documents of ``ids`` (doc_id), as if they had never been inserted."""
        gone = ids.select("doc_id").distinct()
        lines = cut(self.lines.join(gone, "doc_id", "left_anti"))
        keys = cut(self.lines.join(gone, "doc_id", "left_semi").select("h1", "h2").distinct())
        touched = self.counts.join(keys, ["h1", "h2"], "left_semi")
        after = cut(_counted(lines.join(keys, ["h1", "h2"], "left_semi")))
        counts = cut(self.counts.join(keys, ["h1", "h2"], "left_anti").unionByName(after))
        return self._with(lines, counts, touched, after)

    def _probable(self) -> DataFrame:
        """Postings that pass the filters: all repeated lines, and few others."""
        spark, shards = self.lines.sparkSession, self.shards
        size = self.filters.agg(F.sum(F.length("bits"))).first()[0] or 0
        if size > BROADCAST_BYTES:
            return self.lines
        tables = spark.sparkContext.broadcast({r["shard"]: (r["buckets"], bytes(r["bits"])) for r in self.filters.collect()})

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = {k: CuckooFilter(n, np.frombuffer(b, np.uint16).reshape(n, SLOTS)) for k, (n, b) in tables.value.items()}
            for batch in batches:
                h1, h2 = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("h1", "h2"))
                shard, hit = h2 % shards, np.zeros(len(h1), bool)
                for k, table in filters.items():
                    own = np.flatnonzero(shard == k)
                    hit[own] = table.contains(h1[own].view(np.uint64))
                yield batch.filter(pa.array(hit))

        return self.lines.mapInArrow(probe, self.lines.schema)

    def dropped(self) -> DataFrame:
        """(doc_id, row_key, dropped): places of the lines that other documents hold."""
        heavy = self.counts.where(F.col("n_docs") >= self.min_docs).select("h1", "h2", "last_doc")
        lost = self._probable().join(heavy, ["h1", "h2"]).where("doc_id <> last_doc")
        return lost.groupBy("doc_id", "row_key").agg(F.collect_set("pos").alias("dropped"))


def without_lines(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The documents with their columns, ``text`` without the dropped lines, and _n_lines, _n_dropped."""
    lost = dropped.select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"), "dropped")
    keyed = docs.withColumn("_key_here", row_key(docs))
    joined = keyed.join(lost, (keyed["doc_id"] == lost["_id"]) & (keyed["_key_here"] == lost["_key"]), "left")
    lines = F.split(text_of(keyed), "\n", -1)
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped"))
    split = joined.withColumn("_lines", lines).withColumn("_places", F.when(F.col("dropped").isNotNull(), places))
    kept = F.when(F.col("_places").isNull(), F.coalesce(F.col("text").cast("string"), F.lit(""))).otherwise(
        F.array_join(F.transform("_places", lambda i: F.get("_lines", i)), "\n")
    )
    return split.select(
        *[kept.alias("text") if c == "text" else keyed[c] for c in docs.columns],
        F.size("_lines").cast("long").alias("_n_lines"),
        F.coalesce(F.size("_lines") - F.size("_places"), F.lit(0)).cast("long").alias("_n_dropped"),
    )


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents without lines that at least ``min_docs`` of them hold, except in the largest doc_id.

    Null texts are one empty line. Rows that share a doc_id are one document in the counts and each lose the same
    lines; rows without a doc_id are not counted and lose nothing. An empty table gives an empty table. Other
    columns are carried along; ``_n_lines`` and ``_n_dropped`` are added.
    """
    index = LineIndex.build(docs, min_docs, min_chars)
    return without_lines(docs, index.dropped())


