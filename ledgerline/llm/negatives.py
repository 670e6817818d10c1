"""Hard negatives by best-first search in R-trees that are packed by sorting and tiling."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import cut, groups
from ledgerline.operators.joins import join_per_key

#: Components become whole numbers floor(SCALE * x).
SCALE = 256

#: Rows of a tree and bytes of its vectors, whichever is less; rows of a leaf; nodes below a node.
TREE_ROWS = 4096
TREE_BYTES = 1 << 20
LEAF = 256
FAN = 16

#: Anchors that a task holds and searches for together while the trees pass by.
ANCHORS = 512

#: Positives of an anchor, negatives of a positive, and the window of a negative's score in percent of the positive's.
POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)

#: Beyond every score.
FAR = 1 << 62


def points(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, dim, v): rows that take part, one per vec_id, with whole-number components.

    Components whose products could leave 64 bits count as not finite.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, dims, blobs = [], [], []
            for k, vector in enumerate(batch.column(2)):
                if not vector.is_valid or vector.values.null_count or not len(vector.values):
                    continue
                value = np.floor(SCALE * vector.values.to_numpy(zero_copy_only=False))
                if np.isfinite(value).all() and np.abs(value).max() <= min(1 << 30, math.isqrt((FAR - 1) // len(value))):
                    at.append(k)
                    dims.append(len(value))
                    blobs.append(value.astype("<i4").tobytes())
            columns = [batch.column(k).take(pa.array(at, pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(dims, pa.int32()), pa.array(blobs, pa.binary())], ["vec_id", "label", "dim", "v"])

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    known = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    whole = known.where("vec_id IS NOT NULL AND label IS NOT NULL").mapInArrow(work, "vec_id long, label long, dim int, v binary")
    first = F.min(F.struct(F.xxhash64("label", "v").alias("digest"), "label", "dim", "v")).alias("p")
    one = whole.groupBy("vec_id").agg(first).select("vec_id", "p.label", "p.dim", "p.v")
    return one.select("vec_id", label.alias("label"), "dim", "v")


# Packing


def wide_coordinates(rows: DataFrame, count: int) -> dict[int, list[int]]:
    """For each dimension the coordinates of the largest variance. The driver gets two sums per coordinate."""

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, own in frame.groupby("dim"):
                x = np.frombuffer(b"".join(own["v"]), "<i4").reshape(len(own), dim).astype(np.float64)
                yield pd.DataFrame({"dim": dim, "at": np.arange(dim), "n": len(x), "s": x.sum(axis=0), "q": (x * x).sum(axis=0)})

    sums = rows.select("dim", "v").mapInPandas(work, "dim int, at int, n long, s double, q double").groupBy("dim", "at")
    found = sums.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).toPandas()
    found["variance"] = found["q"] / found["n"] - (found["s"] / found["n"]) ** 2
    found = found.sort_values(["dim", "variance", "at"], ascending=[True, False, True])
    return {int(dim): own["at"].tolist()[:count] for dim, own in found.groupby("dim")}


def tiles(rows: DataFrame, tree_rows: int = TREE_ROWS, tree_bytes: int = TREE_BYTES) -> DataFrame:
    """The rows with their tile: columns dim, s0, s1, s2, part.

    Sort-tile-recursive: the label and then the widest two coordinates cut the rows into slabs of near equal counts. Rows that
    quantiles cannot part, such as equal vectors, are parted by their id, so every tile fits a tree.
    """
    axes = wide_coordinates(rows, 2)
    sent = rows.sparkSession.sparkContext.broadcast(axes)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dim, own in frame.groupby("dim"):
                x = np.frombuffer(b"".join(own["v"]), "<i4").reshape(len(own), dim)
                k1, k2 = (x[:, a].astype(np.int64) for a in (sent.value[dim] * 2)[:2])
                yield pd.DataFrame({"vec_id": own["vec_id"], "dim": dim, "k0": own["label"], "k1": k1, "k2": k2})

    light = rows.mapInPandas(work, "vec_id long, dim int, k0 long, k1 long, k2 long")
    size = max(LEAF, min(tree_rows, tree_bytes // (4 * max(axes, default=1))))
    slabs = math.ceil((max(rows.count(), 1) / size) ** (1 / 3))
    keys = ["dim"]
    for k in range(3):
        if slabs > 1:
            borders = light.groupBy(*keys).agg(F.percentile_approx(f"k{k}", [j / slabs for j in range(1, slabs)], 1000).alias("borders"))
            low = F.size(F.filter("borders", lambda b: b < F.col(f"k{k}")))
            light = cut(join_per_key(light, borders, keys).withColumn(f"s{k}", low).drop("borders"))
        else:
            light = light.withColumn(f"s{k}", F.lit(0))
        keys.append(f"s{k}")
    counts = light.groupBy(*keys).agg(F.ceil(F.count("*") / size).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("vec_id", F.lit("part")), F.col("parts")).cast("int")
    placed = join_per_key(light, counts, keys).withColumn("part", part).select("vec_id", *keys[1:], "part")
    return rows.join(placed, "vec_id")


def packed(vectors: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """An order of the rows in which every LEAF rows in a row lie close: by label, then tiled by the three widest coordinates."""
    order = np.argsort(labels, kind="stable")
    variance = vectors.var(axis=0)
    widest = np.argsort(-variance, kind="stable")[:3]
    parts = [order]
    for level, axis in enumerate(widest):
        next_parts = []
        for part in parts:
            leaves = -(-len(part) // LEAF)
            cuts = max(1, math.ceil(leaves ** (1 / (len(widest) - level))))
            step = -(-leaves // cuts) * LEAF
            inside = part[np.argsort(vectors[part, axis], kind="stable")] if level else _sorted_in_labels(part, labels, vectors[:, axis])
            next_parts += [inside[k : k + step] for k in range(0, len(inside), step)]
        parts = next_parts
    return np.concatenate(parts) if parts else order


def _sorted_in_labels(part: np.ndarray, labels: np.ndarray, key: np.ndarray) -> np.ndarray:
    return part[np.lexsort((key[part], labels[part]))]


def trees(rows: DataFrame, tree_rows: int = TREE_ROWS) -> DataFrame:
    """(dim, ids, labels, vectors): a row for each tile, its points in packed order as little-endian numbers."""
    keys = ["dim", "s0", "s1", "s2", "part"]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for own in groups(frames, keys):
            dim = int(own["dim"].iloc[0])
            vectors = np.frombuffer(b"".join(own["v"]), "<i4").reshape(len(own), dim)
            ids, labels = own["vec_id"].to_numpy(np.int64), own["label"].to_numpy(np.int64)
            order = np.argsort(ids)
            order = order[packed(vectors[order], labels[order])]
            yield pd.DataFrame({"dim": [dim], "ids": [ids[order].tobytes()], "labels": [labels[order].tobytes()], "vectors": [vectors[order].tobytes()]})

    dealt = tiles(rows, tree_rows).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.select(*keys, "vec_id", "label", "v").mapInPandas(work, "dim int, ids binary, labels binary, vectors binary")


# Searching


class Tree:
    """Bounding boxes over packed points: leaves of LEAF rows, in the order of their ids, then nodes of FAN nodes, up to one root.

    A box also knows the least and the largest label and the least id below it.
    """

    def __init__(self, dim: int, ids: bytes, labels: bytes, vectors: bytes):
        own, names = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        order = np.lexsort((own, np.arange(len(own)) // LEAF))
        self.ids, self.labels = own[order], names[order]
        whole = np.frombuffer(vectors, "<i4").reshape(len(own), dim)[order]
        self.largest = int(np.abs(whole).max(initial=0))
        self.vectors = whole.astype(np.float64)
        cuts = np.arange(0, len(own), LEAF)
        level = [
            np.minimum.reduceat(self.vectors, cuts), np.maximum.reduceat(self.vectors, cuts),
            np.minimum.reduceat(self.labels, cuts), np.maximum.reduceat(self.labels, cuts), np.minimum.reduceat(self.ids, cuts),
        ]
        self.levels = [level]
        while len(level[0]) > 1:
            cuts = np.arange(0, len(level[0]), FAN)
            level = [f.reduceat(x, cuts) for f, x in zip((np.minimum, np.maximum, np.minimum, np.maximum, np.minimum), level)]
            self.levels.append(level)


def products(a: np.ndarray, b: np.ndarray, top: int) -> np.ndarray:
    """Exact inner products of all rows of whole numbers: as doubles where sums stay below 2^53, else as 64-bit numbers."""
    if top < 1 << 53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Searches:
    """The best rows of a block of anchors so far, for each of their score windows.

    ``same`` asks for rows of the anchor's label, else for rows of all others. A window keeps at most ``count`` rows, higher scores
    first, ties by id; places without a row have the score -FAR. A box matters to an anchor if its interval of inner products
    meets one of the anchor's windows and its best score there beats the worst row kept, or ties with it while the box
    holds a smaller id. Anchors have as many windows as the one with most; the others' last windows are empty.
    """

    def __init__(self, own: np.ndarray, label: np.ndarray, vectors: np.ndarray, same: bool, low: np.ndarray, high: np.ndarray, count: int):
        self.own, self.label, self.same, self.low, self.high, self.count = own, label, same, low, high, count
        self.vectors = vectors.astype(np.float64)
        self.up, self.down = np.maximum(self.vectors, 0), np.minimum(self.vectors, 0)
        self.most = int(np.abs(vectors).max(initial=0)) * vectors.shape[1]
        self.score = np.full((*low.shape, count), -FAR)
        self.found = np.full((*low.shape, count), FAR)
        self.offered = 0

    def wanting(self, tree: Tree, level: int, a: int, b: int, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For anchors ``who`` and boxes a to b of a level: which matter, and the best score that each may hold."""
        low, high, least, most, ids = (x[a:b] for x in tree.levels[level])
        top = self.most * tree.largest
        up, down = self.up[who], self.down[who]
        upper = products(up, high, top) + products(down, low, top)
        lower = products(up, low, top) + products(down, high, top)
        label = self.label[who, None]
        fits = (least <= label) & (label <= most) if self.same else (least != label) | (most != label)
        best = np.minimum(upper[:, :, None], self.high[who, None, :])
        wanted = (upper[:, :, None] >= self.low[who, None, :]) & (lower[:, :, None] <= self.high[who, None, :])
        worst, last = self.score[who, None, :, -1], self.found[who, None, :, -1]
        wanted &= (best > worst) | ((best == worst) & (ids[:, None] < last))
        return fits & wanted.any(axis=2), upper

    def run(self, tree: Tree) -> None:
        """Takes the box with the highest bound of any anchor first, for the anchors to which it matters when it is taken."""
        queue: list[tuple[int, int, int]] = []
        self._push(tree, queue, len(tree.levels) - 1, 0, 1, np.arange(len(self.own)))
        while queue:
            _, level, node = heapq.heappop(queue)
            wanted, _ = self.wanting(tree, level, node, node + 1, np.arange(len(self.own)))
            who = np.flatnonzero(wanted[:, 0])
            if len(who) and level:
                self._push(tree, queue, level - 1, node * FAN, (node + 1) * FAN, who)
            elif len(who):
                self._take(tree, slice(node * LEAF, (node + 1) * LEAF), who)

    def _push(self, tree: Tree, queue: list, level: int, a: int, b: int, who: np.ndarray) -> None:
        wanted, upper = self.wanting(tree, level, a, b, who)
        bound = np.where(wanted, upper, -FAR).max(axis=0)
        for k in np.flatnonzero(wanted.any(axis=0)).tolist():
            heapq.heappush(queue, (-int(bound[k]), level, a + k))

    def _take(self, tree: Tree, part: slice, who: np.ndarray) -> None:
        """Offers all rows of a leaf. They lie in the order of their ids, so the first of the largest scores has the smallest id."""
        ids, labels = tree.ids[part], tree.labels[part]
        scores = products(self.vectors[who], tree.vectors[part], self.most * tree.largest)
        self.offered += scores.size
        same = labels == self.label[who, None]
        scores[~(same & (ids != self.own[who, None])) if self.same else same] = -FAR
        rows = np.arange(len(who))
        for w in range(self.low.shape[1]):
            left = np.where((scores >= self.low[who, w, None]) & (scores <= self.high[who, w, None]), scores, -FAR)
            best, at = [self.score[who, w]], [self.found[who, w]]
            for _ in range(min(self.count, len(ids))):
                place = left.argmax(axis=1)
                top = left[rows, place]
                if ((top < best[0][:, -1]) | (top == -FAR)).all():
                    break
                best.append(top[:, None])
                at.append(np.where(top > -FAR, ids[place], FAR)[:, None])
                left[rows, place] = -FAR
            if len(best) > 1:
                score, found = np.concatenate(best, axis=1), np.concatenate(at, axis=1)
                order = np.lexsort((found, -score), axis=1)[:, : self.count]
                self.score[who, w], self.found[who, w] = (np.take_along_axis(x, order, axis=1) for x in (score, found))

    def frame(self) -> pd.DataFrame:
        a, w, k = np.nonzero(self.score > -FAR)
        return pd.DataFrame({"anchor_id": self.own[a], "window": w, "place": k + 1, "found_id": self.found[a, w, k], "score": self.score[a, w, k]})


def searched(anchors: DataFrame, forest: DataFrame, same: bool, count: int) -> DataFrame:
    """(anchor_id, window, place, found_id, score): for each anchor and window the first ``count`` rows of all trees.

    ``anchors``: vec_id, label, dim, v, low, high. A task holds one block of anchors, about ANCHORS, and lets every tree
    of their dimension pass by, one at a time; the bounds that an earlier tree has set prune the later ones.
    """
    blocks = max(1, -(-anchors.count() // ANCHORS))
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int")
    empty = F.lit(None)
    held = anchors.select(
        "dim", block.alias("block"), F.lit(0).alias("kind"), "vec_id", "label", "v", "low", "high",
        empty.cast("binary").alias("ids"), empty.cast("binary").alias("labels"), empty.cast("binary").alias("vectors"),
    )
    passing = forest.select(
        "dim", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), empty.cast("long").alias("vec_id"),
        empty.cast("long").alias("label"), empty.cast("binary").alias("v"), empty.cast("array<long>").alias("low"), empty.cast("array<long>").alias("high"),
        "ids", "labels", "vectors",
    )

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, waiting, searches = None, [], None
        for frame in frames:
            for r in frame.itertuples(index=False):
                if (r.dim, r.block) != key:
                    if searches is not None:
                        yield searches.frame()
                    key, waiting, searches = (r.dim, r.block), [], None
                if r.kind == 0:
                    waiting.append(r)
                    continue
                if searches is None and waiting:
                    searches = _block(waiting, same, count)
                if searches is not None:
                    searches.run(Tree(r.dim, r.ids, r.labels, r.vectors))
        if searches is not None:
            yield searches.frame()

    dealt = held.union(passing).repartition("dim", "block").sortWithinPartitions("dim", "block", "kind")
    return dealt.mapInPandas(work, "anchor_id long, window int, place int, found_id long, score long")


def _block(rows: list, same: bool, count: int) -> Searches:
    """Anchors in the order of their ids, so that a rerun compares in the same order. Missing windows are empty ones."""
    rows = sorted(rows, key=lambda r: r.vec_id)
    width = max(len(r.low) for r in rows)
    low, high = np.full((len(rows), width), FAR), np.full((len(rows), width), -FAR)
    for k, r in enumerate(rows):
        low[k, : len(r.low)], high[k, : len(r.high)] = r.low, r.high
    vectors = np.frombuffer(b"".join(r.v for r in rows), "<i4").reshape(len(rows), rows[0].dim)
    return Searches(np.array([r.vec_id for r in rows]), np.array([r.label for r in rows]), vectors, same, low, high, count)


def hard_negatives(
    embeddings: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW,
    tree_rows: int = TREE_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose vec_id ``every`` divides; their positives the best ``positives`` other rows of their label; a
    positive's negatives the best ``negatives`` rows of other labels with a score inside the window, bounds included.
    Higher scores come first, ties by smaller vec_id. Scores are exact whole numbers.

    Rows without a vec_id or label, with a null or empty vector or one that holds a null, a non-finite or an immense component take
    no part. Rows that repeat a vec_id are one vector, of different ones that with the smallest digest. Vectors of
    different dimensions do not meet. Equal vectors in any number are parted into trees of bounded size. An anchor without
    positives, or a positive without negatives, has no rows; nor has an empty table. Other columns are not read.
    """
    rows = cut(points(embeddings))
    forest = cut(trees(rows, tree_rows))
    anchors = rows.where(F.col("vec_id") % every == 0)
    bound = lambda x: F.array(F.lit(x).cast("long"))
    best = cut(searched(anchors.withColumns({"low": bound(-FAR), "high": bound(FAR)}), forest, True, positives))
    least, most = window
    hundreds, rest = "((positive_score - pmod(positive_score, 100)) div 100)", "pmod(positive_score, 100)"
    exact = best.select("anchor_id", "place", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")).withColumns(
        {"low": F.expr(f"{least} * {hundreds} + ({least} * {rest} + 99) div 100"), "high": F.expr(f"{most} * {hundreds} + ({most} * {rest}) div 100")}
    )
    listed = exact.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "low", "high"))).alias("w"))
    asked = anchors.join(listed.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    asked = asked.select("vec_id", "label", "dim", "v", F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    found = searched(asked, forest, False, negatives).select(
        "anchor_id", (F.col("window") + 1).alias("place"), F.col("place").alias("rank"), F.col("found_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return found.join(exact, ["anchor_id", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
