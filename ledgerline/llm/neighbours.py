"""Near-duplicate embeddings by NN-descent: a neighbour graph refined through neighbours of neighbours."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ledgerline.llm.common import components, cut, groups, sorted_runs
from ledgerline.operators.joins import join_per_key

#: Cosine from which vectors are linked.
THRESHOLD = 0.95

#: Neighbours outside its family kept per vector, and neighbours of either direction that meet in a local join.
NEIGHBOURS = 8
MEETING = 2 * NEIGHBOURS

#: The first lists come from at least this many random orders, in which each vector meets the next ones. Bits and orders
#: grow with the table: a bucket holds about NEXT vectors, and a pair at the threshold shares none with probability MISS.
ORDERS = 4
ORDER_BITS = 8
NEXT = 6
MISS = 0.01

#: Refining ends when a round changes at most this share of all list entries.
CHANGE = 0.001

#: Vectors of the first audit, which are compared with all others, and the most of one pass. More are drawn until so many
#: links are seen or every vector is compared. Recall that it must find; audits after which exact blocks do the work.
AUDIT = 256
AUDIT_PASS = 4096
AUDIT_LINKS = 1000
RECALL = 0.97
AUDITS = 3

#: Graph distances use vectors of 8-bit numbers; a pair counts as close this far below the threshold.
SLACK = 0.02

#: Members of a component that are compared at a time.
BLOCK = 1024


def units(embeddings: DataFrame) -> DataFrame:
    """(vec_id, dim, unit, code): unit vectors in double precision and as 8-bit numbers.

    Vectors that are null, empty or zero or hold null or non-finite components are left out.
    """

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, whole, codes = [], [], [], []
            for vec_id, vector in zip(batch.column(0), batch.column(1)):
                if not vector.is_valid or vector.values.null_count or not len(vector.values):
                    continue
                v = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                top = np.abs(v).max()
                if not np.isfinite(top) or top == 0:
                    continue
                v = v / top
                v /= np.sqrt(v @ v)
                ids.append(vec_id)
                dims.append(len(v))
                whole.append(v.tobytes())
                codes.append(np.rint(v * (127 / np.abs(v).max())).astype(np.int8).tobytes())
            arrays = [pa.array([i.as_py() for i in ids], pa.int64()), pa.array(dims, pa.int32()), pa.array(whole, pa.binary()), pa.array(codes, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "dim", "unit", "code"])

    return embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(
        scale, "vec_id long, dim int, unit binary, code binary"
    )


def _matrix(column: pa.Array, start: int = 0, end: int | None = None) -> np.ndarray:
    """Rows of 8-bit codes as unit vectors. All have the same dimension."""
    part = column.slice(start, None if end is None else end - start)
    codes = np.frombuffer(b"".join(part.to_pylist()), np.int8).reshape(len(part), -1).astype(np.float32)
    return codes / np.sqrt((codes * codes).sum(axis=1, keepdims=True))


def order_sizes(total: int, threshold: float) -> tuple[int, int]:
    """(orders, bits) for so many vectors. Two at the threshold agree in a sign with probability 1 - angle / pi."""
    bits = max(ORDER_BITS, math.ceil(math.log2(max(total, 1) / NEXT)))
    share = (1 - math.acos(min(1.0, threshold)) / math.pi) ** bits
    return (ORDERS if share >= 1 else max(ORDERS, math.ceil(math.log(MISS) / math.log1p(-share)))), bits


def ordered(nodes: DataFrame, seed: int, orders: int, bits: int) -> DataFrame:
    """(order, dim, side, place, node, code): every node in each of the random orders.

    ``side`` holds the signs of random projections, ``place`` is one more projection.
    """

    def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, own in frame.groupby("dim"):
                vectors = np.frombuffer(b"".join(own["code"]), np.int8).reshape(len(own), dim).astype(np.float32)
                for order in range(orders):
                    random = np.random.Generator(np.random.PCG64([seed, order, dim])).standard_normal((dim, bits + 1), np.float32)
                    found = vectors @ random
                    side = (found[:, :-1] > 0) @ (1 << np.arange(bits))
                    yield pd.DataFrame({"order": order, "dim": dim, "side": side, "place": found[:, -1] / np.linalg.norm(vectors, axis=1), "node": own["node"], "code": own["code"]})

    return nodes.select("node", "dim", "code").mapInPandas(project, "order int, dim int, side long, place double, node long, code binary")


def first_edges(nodes: DataFrame, seed: int, orders: int, bits: int) -> DataFrame:
    """(u, v, sim), both ways, of vectors that stand close in one of the random orders."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail: pa.RecordBatch | None = None
        for batch in batches:
            parts = [batch] if tail is None else [tail, batch]
            whole = pa.Table.from_batches(parts).combine_chunks().to_batches()
            if not whole:
                continue
            whole = whole[0]
            old = 0 if tail is None else tail.num_rows
            tail = whole.slice(max(0, whole.num_rows - NEXT))
            order, dim = (whole.column(k).to_numpy() for k in (0, 1))
            node = whole.column(2).to_numpy()
            for a, b in _stretches(order, dim):
                vectors = _matrix(whole.column(3), a, b)
                for step in range(1, min(NEXT, b - a - 1) + 1):
                    sims = (vectors[:-step] * vectors[step:]).sum(axis=1)
                    fresh = np.arange(a + step, b) >= old
                    u, v, s = node[a : b - step][fresh], node[a + step : b][fresh], sims[fresh]
                    yield pa.RecordBatch.from_arrays([pa.array(np.r_[u, v]), pa.array(np.r_[v, u]), pa.array(np.r_[s, s])], ["u", "v", "sim"])

    dealt = ordered(nodes, seed, orders, bits).repartitionByRange("order", "dim", "side", "place").sortWithinPartitions("order", "dim", "side", "place")
    return dealt.select("order", "dim", "node", "code").mapInArrow(meet, "u long, v long, sim float").where("u <> v")


def _stretches(order: np.ndarray, dim: np.ndarray) -> list[tuple[int, int]]:
    at = np.flatnonzero((order[1:] != order[:-1]) | (dim[1:] != dim[:-1])) + 1
    bounds = [0, *at.tolist(), len(order)]
    return list(zip(bounds[:-1], bounds[1:]))


def nearest(edges: DataFrame, n: int) -> DataFrame:
    """The n most similar distinct neighbours of each vector; ``old`` if any of the edges is."""
    best = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.max("old").alias("old"))
    by_sim = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    return best.withColumn("place", F.row_number().over(by_sim)).where(F.col("place") <= n).drop("place")


def outside(edges: DataFrame, families: DataFrame) -> DataFrame:
    """The edges that lead from one family to another."""
    a = families.select(F.col("node").alias("u"), F.col("family").alias("fu"))
    b = families.select(F.col("node").alias("v"), F.col("family").alias("fv"))
    return edges.join(a, "u").join(b, "v").where("fu <> fv").select("u", "v", "sim", "old", "fu", "fv")


def refined(graph: DataFrame, inside: DataFrame | None, nodes: DataFrame) -> DataFrame:
    """The lists after every vector has let its neighbours of both directions meet each other. Entries that were there are ``old``.

    ``graph`` lists neighbours of other families, and only pairs of two families are new entries; those of a vector's
    own family (``inside``) meet the others. Two that were old neighbours have met before and do not meet again, and of those that
    a vector meets in one place only the nearest can enter its list.
    """
    both = nearest(graph.union(graph.select("v", "u", "sim", "old")), MEETING)
    if inside is not None:
        both = both.union(nearest(inside.union(inside.select("v", "u", "sim", "old")), MEETING))
    least = graph.groupBy("u").agg(F.when(F.count("*") >= NEIGHBOURS, F.min("sim")).otherwise(F.lit(-2.0)).cast("float").alias("least"))
    carried = nodes.select(F.col("node").alias("v"), "code", "family").join(least.withColumnRenamed("u", "v"), "v", "left")
    carried = carried.withColumn("least", F.coalesce("least", F.lit(-2.0).cast("float")))
    met = both.join(carried, "v").select("u", "v", "code", "least", "family", "old").repartition("u").sortWithinPartitions("u")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bounds in sorted_runs(batches, "u"):
            node, least, family = (batch.column(k).to_numpy() for k in (1, 3, 4))
            old = batch.column(5).to_numpy(zero_copy_only=False)
            vectors = _matrix_by_run(batch.column(2), bounds)
            found = []
            for (a, b), own in zip(zip(bounds[:-1], bounds[1:]), vectors):
                if b - a < 2 or old[a:b].all():
                    continue
                sims = own @ own.T
                fresh = ~(old[a:b, None] & old[a:b])
                np.fill_diagonal(fresh, False)
                sims[~(fresh & (sims > least[a:b, None]) & (family[a:b, None] != family[a:b]))] = -3.0
                last = np.partition(sims, -NEIGHBOURS, axis=1)[:, -NEIGHBOURS] if b - a > NEIGHBOURS else np.full(b - a, -3.0, sims.dtype)
                i, j = np.nonzero((sims > -3.0) & (sims >= last[:, None]))
                found.append((node[a + i], node[a + j], sims[i, j]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], ["u", "v", "sim"])

    known = graph.withColumn("old", F.lit(True))
    return nearest(known.union(met.mapInArrow(meet, "u long, v long, sim float").withColumn("old", F.lit(False))), NEIGHBOURS)


def _matrix_by_run(column: pa.Array, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """Unit vectors of each run; dimensions may differ between runs, never inside one."""
    codes = column.to_pylist()
    for a, b in zip(bounds[:-1], bounds[1:]):
        own = np.frombuffer(b"".join(codes[a:b]), np.int8).reshape(b - a, -1).astype(np.float32)
        yield own / np.sqrt((own * own).sum(axis=1, keepdims=True))


def audited(nodes: DataFrame, families: DataFrame, threshold: float) -> tuple[int, int]:
    """Links of drawn vectors to all others by brute force, and those of them whose ends share a family.

    Vectors are drawn until AUDIT_LINKS links are seen or every vector is compared.
    """
    buckets = max(1, -(-nodes.count() // AUDIT))
    bucket = F.pmod(F.xxhash64("node", F.lit("audit")), F.lit(buckets))
    links = caught = done = 0
    while done < buckets and links < AUDIT_LINKS:
        size = min(max(1, 3 * done), max(1, AUDIT_PASS // AUDIT), buckets - done)
        more = _audited(nodes, nodes.where((bucket >= done) & (bucket < done + size)), families, threshold)
        links, caught, done = links + more[0], caught + more[1], done + size
    return links, caught


def _audited(nodes: DataFrame, drawn: DataFrame, families: DataFrame, threshold: float) -> tuple[int, int]:
    sample = drawn.select("node", "dim", "unit").collect()
    by_dim: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in {r["dim"] for r in sample}:
        own = [r for r in sample if r["dim"] == dim]
        by_dim[dim] = (np.array([r["node"] for r in own], np.int64), np.frombuffer(b"".join(bytes(r["unit"]) for r in own), np.float64).reshape(-1, dim))
    sent = nodes.sparkSession.sparkContext.broadcast(by_dim)

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, own in frame.groupby("dim"):
                if dim not in sent.value:
                    continue
                ids, vectors = sent.value[dim]
                units = np.frombuffer(b"".join(own["unit"]), np.float64).reshape(len(own), dim)
                for k in range(0, len(ids), AUDIT):
                    i, j = np.nonzero(units @ vectors[k : k + AUDIT].T >= threshold)
                    yield pd.DataFrame({"x": own["node"].to_numpy()[i], "q": ids[k + j]})

    pairs = nodes.select("node", "dim", "unit").mapInPandas(compare, "x long, q long").where("x <> q")
    a = families.select(F.col("node").alias("x"), F.col("family").alias("fx"))
    b = families.select(F.col("node").alias("q"), F.col("family").alias("fq"))
    found = pairs.join(a, "x", "left").join(b, "q", "left").agg(F.count("*"), F.count(F.when(F.col("fx") == F.col("fq"), 1))).first()
    return found[0], found[1]


def merged_families(families: DataFrame, close: DataFrame) -> DataFrame:
    """(node, family) after the edges' families are one."""
    low = components(close.select(F.col("fu").alias("a"), F.col("fv").alias("b")))
    joined = families.join(low, families["family"] == low["id"], "left")
    return cut(joined.select("node", F.coalesce("component", "family").alias("family")))


def cut_counted(df: DataFrame, what: Column | None = None) -> tuple[DataFrame, int]:
    """The frame, stored, and how many of its rows meet a condition, counted by the job that stores it."""
    seen = Observation()
    kept = cut(df.observe(seen, F.count_if(F.lit(True) if what is None else what).alias("n")))
    return kept, seen.get.get("n") or 0


def close_families(nodes: DataFrame, threshold: float) -> DataFrame:
    """(node, family): components of the close edges of a neighbour graph that passes the audit.

    A list may be saturated, all its entries close. When the lists have settled, the families of their close edges are formed,
    and the vectors of saturated lists, and no others, begin new lists that hold neighbours outside the family only: a
    list that is not saturated has room for every close vector, so a link that is still missing lies between two
    saturated ones. That goes on until no list finds a close neighbour or none is saturated.
    If none of AUDITS graphs passes, all vectors of a dimension are one family, so that every pair is compared.
    """
    near = F.col("sim") >= threshold - SLACK
    families = nodes.select("node", F.col("node").alias("family"))
    inside = None
    seed = 0
    for _ in range(AUDITS):
        active = nodes.select("node", "dim", "code")
        while True:
            placed, total = cut_counted(active.join(families, "node").select("node", "dim", "code", "family"))
            fresh = first_edges(placed, seed, *order_sizes(total, threshold)).withColumn("old", F.lit(False))
            seed += 1
            graph = cut(nearest(outside(fresh, families), NEIGHBOURS))
            changed = total * NEIGHBOURS
            while changed > CHANGE * NEIGHBOURS * total:
                graph, changed = cut_counted(refined(graph, inside, placed), ~F.col("old"))
            close, found = cut_counted(outside(graph.where(near), families))
            if not found:
                break
            links = close.select("u", "v", "sim", F.lit(True).alias("old"))
            inside = cut(nearest(links if inside is None else links.union(inside), NEIGHBOURS))
            families = merged_families(families, close)
            saturated = close.groupBy("u").agg(F.count("*").alias("n")).where(F.col("n") >= NEIGHBOURS).select(F.col("u").alias("node"))
            active, left = cut_counted(placed.drop("family").join(saturated, "node", "left_semi"))
            if not left:
                break
        links, caught = audited(nodes, families, threshold)
        if caught >= RECALL * links:
            return families
    return nodes.select("node", F.col("dim").cast("long").alias("family"))


def compared(members: DataFrame, threshold: float) -> DataFrame:
    """(a, b, n): rows with b null give vector a n links; the others are links that connect what all links connect.

    ``members``: node, family, size, unit, copies. Every list of a family is enlarged to the whole family, block by block in
    double precision; links are counted where they are found and no pair is sent anywhere.
    """
    blocks = members.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    dealt = blocks.withColumn("own", F.pmod(F.hash("node", F.lit("block")), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keyed = dealt.select(
        "family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node",
        (F.col("own") > F.col("other")).alias("side"), "unit", "copies",
    )
    keys = ["family", "i", "j"]

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in groups(frames, keys):
            side = group["side"].to_numpy(bool)
            node, copies = group["node"].to_numpy(), group["copies"].to_numpy()
            vectors = np.frombuffer(b"".join(group["unit"]), np.float64).reshape(len(group), -1)
            if group["i"].iloc[0] == group["j"].iloc[0]:
                left = right = np.arange(len(group))
            else:
                left, right = np.flatnonzero(~side), np.flatnonzero(side)
            hit = vectors[left] @ vectors[right].T >= threshold
            if left is right:
                np.fill_diagonal(hit, False)
            counts = [(node[left], hit @ copies[right])] + [(node[right], hit.T @ copies[left])] * (left is not right)
            label = np.arange(len(group))
            while True:
                before = label.copy()
                np.minimum.at(label, left, np.where(hit, label[right][None, :], len(label)).min(axis=1, initial=len(label)))
                np.minimum.at(label, right, np.where(hit, label[left][:, None], len(label)).min(axis=0, initial=len(label)))
                if (label == before).all():
                    break
            yield pd.DataFrame({"a": np.concatenate([c[0] for c in counts]), "b": None, "n": np.concatenate([c[1] for c in counts])}).astype({"b": "Int64"})
            moved = np.flatnonzero(label != np.arange(len(group)))
            yield pd.DataFrame({"a": node[moved], "b": node[label[moved]], "n": 0}).astype({"b": "Int64"})

    return keyed.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(compare, "a long, b long, n long")


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id), one row per input row, whatever the other columns hold.

    Vectors are linked at a cosine of at least the threshold, in double precision. Equal unit vectors are one node of the
    graph and count as so many links. Vectors that are null, empty, zero or hold null or non-finite components, and
    rows without a vec_id, are linked with nothing; vectors of different dimensions neither. Rows that repeat a
    vec_id are one vector, of different ones that with the smallest digest, and get the same result. An empty table gives an empty table.
    """
    every = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"))
    hashed = units(embeddings.where("vec_id IS NOT NULL")).withColumns({"h1": F.xxhash64("unit"), "h2": F.xxhash64(F.lit(7), "unit")})
    known = cut(hashed.groupBy("vec_id").agg(F.min(F.struct("h1", "h2", "dim", "unit", "code")).alias("v")).select("vec_id", "v.*"))
    classes = known.groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    placed = cut(known.select("vec_id", "h1", "h2").join(classes, ["h1", "h2"]).select("vec_id", "node", "copies"))
    nodes = cut(
        known.join(classes.select(F.col("node").alias("vec_id"), "copies"), "vec_id")
        .select(F.col("vec_id").alias("node"), "dim", "unit", "code", "copies")
    )
    families = close_families(nodes, threshold)
    sizes = families.groupBy("family").agg(F.count("*").alias("size")).where("size > 1")
    members = join_per_key(families, sizes, ["family"]).join(nodes.drop("dim", "code"), "node")
    found = cut(compared(members, threshold))
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    low = components(found.where("b IS NOT NULL").select("a", "b")).select(F.col("id").alias("node"), F.col("component").alias("low"))
    judged = placed.join(counts, "node", "left").join(low, "node", "left").select(
        F.col("vec_id").alias("_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("low", "node").alias("component_id"),
    )
    out = every.join(judged, every["vec_id"] == judged["_id"], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
