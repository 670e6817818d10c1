"""Lloyd's iterations of many k-means fits over the same points: one pass over all points serves every fit that still moves."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame

#: Points that a task compares with the centres of all fits at a time: their scores stay in a core's cache.
CHUNK = 1_024


@dataclass
class Refined:
    centres: np.ndarray
    cost: float
    iterations: int


def point_blocks(points: DataFrame) -> RDD:
    """The points as cached arrays of one row per column, in the frame's partitions and order."""
    width = len(points.columns)

    def arrays(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns], np.float64)
            yield pa.RecordBatch.from_pydict({"block": pa.array([columns.tobytes()], pa.binary())})

    blocks = points.mapInArrow(arrays, "block binary").rdd
    return blocks.map(lambda row: np.frombuffer(row[0], np.float64).reshape(width, -1)).persist(StorageLevel.MEMORY_AND_DISK)


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre, the first of equally near ones, and the squared distance to it."""
    own, best = np.zeros(points.shape[1], np.intp), np.full(points.shape[1], np.inf)
    for number, centre in enumerate(centres):
        distance = sum((axis - place) ** 2 for axis, place in zip(points, centre))
        own[distance < best] = number
        best = np.minimum(best, distance)
    return own, best


def _chunks(blocks: Iterable[np.ndarray], size: int) -> Iterator[np.ndarray]:
    for block in blocks:
        yield from (block[:, low : low + size] for low in range(0, block.shape[1], size))


def _sums(blocks: Iterable[np.ndarray], fits: Sequence[np.ndarray]) -> Iterator[np.ndarray]:
    """Sums and count of each centre's points in a partition, one row per centre, the fits one after the other."""
    ends = np.cumsum([0, *map(len, fits)])
    sums = np.zeros((ends[-1], fits[0].shape[1] + 1))
    groups = []  # fits with the same number of centres are compared as one product of matrices
    for count in sorted({len(f) for f in fits}):
        which = [n for n, f in enumerate(fits) if len(f) == count]
        centres = np.concatenate([fits[n] for n in which])
        groups.append((which, count, np.hstack([-2 * centres, (centres**2).sum(axis=1, keepdims=True)]), np.zeros((len(centres), sums.shape[1]))))
    for points in _chunks(blocks, CHUNK):
        ones = np.vstack([points, np.ones(points.shape[1])])
        for which, count, weights, held in groups:
            # A squared distance without the point's own square: what is left decides which centre is nearest.
            scores = (weights @ ones).reshape(len(which), count, -1)
            nearest = (scores == scores.min(axis=1, keepdims=True)).astype(np.float64)
            part = nearest.reshape(len(weights), -1) @ ones.T
            for n in np.flatnonzero(part[:, -1].reshape(-1, count).sum(axis=1) != points.shape[1]):  # equally near centres: the first one has the point
                own, _ = _nearest(points, fits[which[n]])
                part[n * count : (n + 1) * count] = (own == np.arange(count)[:, None]).astype(np.float64) @ ones.T
            held += part
    for which, count, _, held in groups:
        for n, part in zip(which, held.reshape(len(which), count, -1)):
            sums[ends[n] : ends[n + 1]] = part
    yield sums


def _costs(blocks: Iterable[np.ndarray], fits: Sequence[np.ndarray]) -> Iterator[np.ndarray]:
    costs = np.zeros(len(fits))
    for points in _chunks(blocks, 8 * CHUNK):
        costs += [_nearest(points, centres)[1].sum() for centres in fits]
    yield costs


def refine(blocks: RDD, starts: Sequence[np.ndarray], iterations: int, tolerance: float) -> list[Refined]:
    """Every start moved to the means of its points until no centre moves by more than ``tolerance``, as MLlib's k-means does.

    A centre without points stays. The cost is that of the centres before the last move. Tasks return one row of sums per
    centre, which are added up in a tree; the points never leave their partitions.
    """
    fits = [np.array(c, np.float64) for c in starts]
    before, steps = list(fits), [0] * len(fits)
    moving = list(range(len(fits))) if iterations else []
    while moving:
        total = blocks.mapPartitions(partial(_sums, fits=[fits[n] for n in moving])).treeReduce(np.add)
        still, at = [], 0
        for n in moving:
            own, at = total[at : at + len(fits[n])], at + len(fits[n])
            some = own[:, -1:] > 0
            means = np.where(some, own[:, :-1] * (1.0 / np.where(some, own[:, -1:], 1.0)), fits[n])
            before[n], fits[n], steps[n] = fits[n], means, steps[n] + 1
            if ((means - before[n]) ** 2).sum(axis=1).max() > tolerance**2 and steps[n] < iterations:
                still.append(n)
        moving = still
    costs = blocks.mapPartitions(partial(_costs, fits=before)).treeReduce(np.add)
    return [Refined(c, float(cost), n) for c, cost, n in zip(fits, costs, steps)]
