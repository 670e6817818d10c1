"""What several operators share: lineage cuts, views of text batches as byte arrays, word hashes, components."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerline.operators.joins import join_per_key

#: Characters that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"

#: Text bytes that a task turns into arrays at a time. A longer document makes a slice of its own.
SLICE_BYTES = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: what the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one gets a folder of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="ledgerline-llm-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the shared folder until it is no longer used."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written as a Parquet table of its own to the shared folder and read again."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def ship(spark: SparkSession) -> None:
    """Makes this package importable for the executors' Python workers, wherever the driver found it.

    Spark serves the archive to the executors itself. A job that was submitted with the package needs no call.
    """
    context, package = spark.sparkContext, Path(__file__).parents[1]
    if getattr(context, "_ledgerline_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="ledgerline-ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._ledgerline_shipped = True


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{directory}/{name}.parquet")


def text_of(docs: DataFrame) -> Column:
    """The text column, null as empty."""
    return F.coalesce(docs["text"].cast("string"), F.lit(""))


def row_key(docs: DataFrame) -> Column:
    """Tells rows of the same doc_id with different texts apart."""
    return F.xxhash64(text_of(docs))


# Text batches as byte arrays


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows in bytes) of slices of a batch. Nulls are empty."""
    texts = batch.column(batch.schema.get_field_index(column))
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1)
        yield first, end, raw[bounds[first] : bounds[end]], bounds[first : end + 1] - bounds[first]
        first = end


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[ord(c) for c in SPACES]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = np.random.Generator(np.random.PCG64(20240229)).integers(1, _MASK, 256, dtype=np.uint64, endpoint=True)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, from exponent 0 to n at least."""
    if len(_POWERS[0]) <= n:
        size = 1 << int(n).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            out = np.ones(size, np.uint64)
            done = 1
            while done < size:
                out[done : 2 * done] = out[:done] * np.uint64(pow(base, done, 1 << 64))
                done *= 2
            _POWERS[k] = out
    return _POWERS[0], _POWERS[1]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running polynomial hashes; ``span_hashes`` takes the hash of any span from them."""
    powers, _ = _powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * powers[: len(data)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans: equal for equal contents, wherever they start."""
    _, inverse = _powers(len(prefix))
    return mix64((prefix[ends] - prefix[starts]) * inverse[starts])


def same_spans(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each pair of spans of equal length above 0, whether their bytes are equal: hashes may agree by chance."""
    if not len(lengths):
        return np.zeros(0, bool)
    first = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    return np.logical_and.reduceat(a[inside + np.repeat(a_starts, lengths)] == b[inside + np.repeat(b_starts, lengths)], first)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each document the index of its first word (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_IS_SPACE[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | border[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | border[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingles(word_hashes: np.ndarray, first_word: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside documents, and for each the document's index in the slice."""
    n = len(word_hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(first_word) - 1), np.diff(first_word))
    out = word_hashes[:n].copy()
    for k in range(1, width):
        out = mix64(out * np.uint64(_BASE) + word_hashes[k : n + k])
    whole = doc[:n] == doc[width - 1 :]
    return out[whole], doc[:n][whole]


# Sorted groups inside a partition


def groups(frames: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of one key each, from a partition that is sorted by the keys. Holds one group at a time."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if not len(frame):
            continue
        changed = (frame[keys] != frame[keys].shift()).any(axis=1).to_numpy()
        cuts = np.flatnonzero(changed)
        if held and (frame[keys].iloc[0] == held[-1][keys].iloc[-1]).all():
            cuts = cuts[1:]
        start = 0
        for at in cuts:
            if at > start:
                held.append(frame.iloc[start:at])
            if held:
                yield pd.concat(held) if len(held) > 1 else held[0]
            held, start = [], at
        held.append(frame.iloc[start:])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


# Connected components


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(id, component): the smallest id each id of ``edges`` (a, b) is connected to, by alternating stars.

    A round links every node's larger neighbours and then its smaller ones to the smallest neighbour. Both steps
    are group-bys with map-side minima and joins; no group of edges is gathered.
    """
    pairs = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    digest = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    before = None
    for _ in range(rounds):
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = join_per_key(both.where("b > a"), least, ["a"]).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        ends = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        linked = join_per_key(large, small, ["a"]).select(F.explode(ends).alias("e")).select("e.*")
        pairs = cut(linked.where("a <> b").distinct())
        after = pairs.agg(*digest).first()
        if after == before:
            break
        before = after
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        pairs.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    )


def ranks(df: DataFrame, key: str, tie: list[str], bucket_rows: int, across_keys: bool = False) -> DataFrame:
    """Adds ``rank``, dense from 0 per key or, with ``across_keys``, over all keys in their order.

    For keys of few distinct values: their counts are broadcast. A key of many rows is cut by a hash of the tie
    columns into as many buckets as it needs, and rows are ordered inside buckets only. A row per bucket, that is per
    key and per ``bucket_rows`` rows, meets in one window.
    """
    counted = df.groupBy(key).agg(F.ceil(F.count("*") / bucket_rows).cast("int").alias("__parts"))
    split = df.join(F.broadcast(counted), key).withColumn("__part", F.pmod(F.hash(*tie), F.col("__parts")))
    counts = split.groupBy(key, "__part").agg(F.count("*").alias("__n"))
    scope = Window.partitionBy(F.lit(0)).orderBy(key, "__part") if across_keys else Window.partitionBy(key).orderBy("__part")
    before = F.coalesce(F.sum("__n").over(scope.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select(key, "__part", before.alias("__before"))
    numbered = split.withColumn("__inside", F.row_number().over(Window.partitionBy(key, "__part").orderBy(*tie)) - 1)
    placed = numbered.join(offsets, [key, "__part"]).withColumn("rank", (F.col("__before") + F.col("__inside")).cast("long"))
    return placed.drop("__parts", "__part", "__inside", "__before")


def sorted_runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole groups, with the groups' bounds, from a partition sorted by a numeric key without nulls.

    Holds one batch and the group that it leaves open.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        changes = np.flatnonzero(values[1:] != values[:-1]) + 1
        if held:
            before = held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py()
            if before != values[0]:
                changes = np.concatenate([[0], changes])
        if not len(changes):
            held.append(batch)
            continue
        whole = pa.Table.from_batches([*held, batch.slice(0, int(changes[-1]))]).combine_chunks().to_batches()
        held = [batch.slice(int(changes[-1]))]
        for part in whole:
            yield part, _bounds(part, key)
    if held:
        for part in pa.Table.from_batches(held).combine_chunks().to_batches():
            yield part, _bounds(part, key)


def _bounds(batch: pa.RecordBatch, key: str) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])
