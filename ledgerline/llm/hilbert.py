"""Sharding along a Hilbert curve over quantised metadata."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import cut, ranks, row_key, text_of

#: Bits of each dimension; 2^(bits x dimensions) cells are the proven bound of the broadcast cell tables.
BITS = 4

#: Rows of a cell that are ordered together; larger cells are split by a hash.
BUCKET_ROWS = 100_000


def curve_index(point: tuple[int, ...], bits: int) -> int:
    """Place of a grid point on the Hilbert curve (Skilling's transform)."""
    x, n = list(point), len(point)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    out = 0
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = out << 1 | ((x[i] ^ t) >> b & 1)
    return out


def text_code(column: Column) -> Column:
    """A number in the order of the strings' first seven bytes; null below all."""
    hexed = F.rpad(F.hex(F.substring(F.encode(column.cast("string"), "UTF-8"), 1, 7)), 14, "0")
    return F.coalesce(F.conv(hexed, 16, 10).cast("long"), F.lit(-1).cast("long"))


def on_curve(df: DataFrame, dimensions: list[str], bits: int = BITS) -> DataFrame:
    """Adds ``curve``: each numeric dimension is cut at its own quantiles, and the cell's place on the curve is looked up.

    Quantiles come from one aggregation of sketches; only 2^bits - 1 numbers per dimension reach the driver.
    """
    steps = [k / (1 << bits) for k in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(d, F.array(*map(F.lit, steps)), F.lit(10_000)).alias(d) for d in dimensions]).first()
    cell = F.lit(0)
    for d in dimensions:
        place = sum((F.when(F.col(d) > b, 1).otherwise(0) for b in sorted(set(found[d] or []))), F.lit(0))
        cell = cell * (1 << bits) + place
    points = itertools.product(range(1 << bits), repeat=len(dimensions))
    table = df.sparkSession.createDataFrame([(k, curve_index(p, bits)) for k, p in enumerate(points)], "cell int, curve int")
    return df.withColumn("cell", cell).join(F.broadcast(table), "cell").drop("cell")


def cut_runs(ranked: DataFrame, shards: int, total: int) -> DataFrame:
    """Adds ``shard`` and ``slot``: the curve is cut into runs whose row counts differ by one at most."""
    shard = F.expr(f"(rank * {shards}) div {max(total, 1)}")
    start = F.expr(f"(shard * {total} + {shards} - 1) div {shards}")
    return ranked.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("rank") - start).cast("long"))


def hilbert_shards(docs: DataFrame, shards: int = 16, bits: int = BITS) -> DataFrame:
    """(doc_id, size, text_crc32, curve, shard, slot), one row per input row.

    Language, source and text size are the dimensions. Null languages and sources come first on their axis, a null
    text has size 1 and the checksum of no bytes. Equal rows share a cell and get neighbouring slots in either
    order. An empty table gives an empty table. Other columns are not read.
    """
    text = text_of(docs)
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        text_code(docs["lang"]).alias("lang_code"),
        text_code(docs["source"]).alias("source_code"),
        F.xxhash64("doc_id", row_key(docs)).alias("tie"),
    )
    narrow = cut(narrow)
    total = narrow.count()
    placed = on_curve(narrow, ["lang_code", "source_code", "size"], bits)
    return cut_runs(ranks(placed, "curve", ["tie", "doc_id"], BUCKET_ROWS, across_keys=True), shards, total).drop("rank", "tie", "lang_code", "source_code")


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Writes each shard's documents in curve order, so that file statistics of all dimensions are narrow."""
    joined = docs.join(placed.select("doc_id", "shard", "slot"), "doc_id")
    joined.repartition("shard").sortWithinPartitions("shard", "slot").drop("slot").write.partitionBy("shard").parquet(path)
