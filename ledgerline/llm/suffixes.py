"""Removal of repeated byte strings by a distributed merge sort of suffixes that is aware of common prefixes.

Of every 200-byte window one position, the window's anchor, is chosen by content, so that equal windows have equal
anchors. Only anchors that occur with more than one context need a closer look; their suffixes are sorted in runs,
exchanged front-coded, and merged by loser trees that carry common-prefix lengths along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import cut, groups, mix64, prefix_hashes, row_key, span_hashes, text_of, text_slices
from ledgerline.operators.joins import join_per_key

#: Bytes of a string whose repetition counts.
LENGTH = 200

#: Bytes that an anchor is chosen by. A window holds SPAN candidates.
GRAM = 32
SPAN = LENGTH - GRAM + 1

#: Suffixes that are sorted together in a run and that a merge gets on average. The windows of a gram with more contexts
#: than HOT are counted by their hashes instead of being merged.
RUN = 40_000
RANGE = 20_000
HOT = 20_000

_LOW = np.uint64((1 << 24) - 1)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, position, least and greatest distance back to its windows' starts, gram hash, context hash) of each anchor.

    A window's anchor is its gram of the smallest hash, the first of equal ones. The context is all that the anchor's
    windows hold.
    """
    n = len(data)
    ends = np.repeat(offsets[1:], np.diff(offsets))
    window = np.flatnonzero(np.arange(n) + LENGTH <= ends)
    if not len(window):
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),) * 2
    prefix = prefix_hashes(data)
    at = np.arange(n - GRAM + 1)
    grams = span_hashes(prefix, at, at + GRAM)
    ranked = (grams & ~_LOW) | (at.astype(np.uint64) & _LOW)
    padded = np.full(-(-len(ranked) // SPAN) * SPAN, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(ranked)] = ranked
    blocks = padded.reshape(-1, SPAN)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(behind[window], ahead[window + SPAN - 1])
    place = window + ((least.astype(np.int64) - window) & int(_LOW))
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    last = np.r_[first[1:], len(place)] - 1
    a, b, p = window[first], window[last], place[first]
    doc = np.searchsorted(offsets, a, "right") - 1
    context = mix64(span_hashes(prefix, a, b + LENGTH) + (p - a).astype(np.uint64))
    return doc, p - offsets[doc], p - b, p - a, grams[p], context


def anchor_rows(base: DataFrame) -> DataFrame:
    """(h, ctx, row, packed): every anchor; ``packed`` holds position, least and greatest distance."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            for begin, end, data, offsets in text_slices(batch):
                doc, p, low, high, gram, context = anchors(data, offsets)
                arrays = [gram.view(np.int64), context.view(np.int64), rows[begin:end][doc], p << 16 | low << 8 | high]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["h", "ctx", "row", "packed"])

    return base.select("row", "text").mapInArrow(find, "h long, ctx long, row long, packed long")


# Runs


def common_prefixes(strings: list[bytes]) -> np.ndarray:
    """Length of the common prefix of each string with the one before; 0 for the first."""
    size = np.array([len(s) for s in strings], np.int64)
    table = np.frombuffer(b"".join(s.ljust(LENGTH, b"\0") for s in strings), np.uint8).reshape(len(strings), LENGTH)
    differ = np.c_[table[1:] != table[:-1], np.ones((len(strings) - 1, 1), bool)]
    return np.r_[0, np.minimum(differ.argmax(axis=1), np.minimum(size[1:], size[:-1]))]


RUN_SCHEMA = "part int, prefixes binary, sizes binary, tails binary, lefts binary, low binary, high binary, row binary, place binary, single binary"


def _run_frames(items: list[tuple]) -> Iterator[pd.DataFrame]:
    """One sorted run per part, front-coded: a row each."""
    items.sort(key=lambda x: (x[7], x[0]))
    strings = [x[0] for x in items]
    part = np.array([x[7] for x in items], np.int64)
    prefixes = common_prefixes(strings)
    bounds = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
    for a, b in zip(bounds[:-1], bounds[1:]):
        own = prefixes[a:b].copy()
        own[0] = 0
        tails = [s[k:] for s, k in zip(strings[a:b], own)]
        column = lambda k, kind: np.array([x[k] for x in items[a:b]], kind).tobytes()  # noqa: E731, B023
        yield pd.DataFrame([{
            "part": int(part[a]), "prefixes": own.astype(np.uint8).tobytes(), "sizes": np.array([len(t) for t in tails], np.uint8).tobytes(),
            "tails": b"".join(tails), "lefts": b"".join(x[1] for x in items[a:b]), "low": column(2, np.uint8), "high": column(3, np.uint8),
            "row": column(4, np.int64), "place": column(5, np.int64), "single": column(6, np.uint8),
        }])


def suffix_runs(texts: DataFrame) -> DataFrame:
    """Front-coded sorted runs of the suffixes at the ``wanted`` anchors (packed, single, part) of (row, text, wanted)."""

    def sort(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items: list[tuple] = []
        for frame in frames:
            for row, text, wanted in zip(frame["row"], frame["text"], frame["wanted"]):
                data = text.encode()
                for w in wanted:
                    p, low, high = w["packed"] >> 16, w["packed"] >> 8 & 255, w["packed"] & 255
                    items.append((data[p : p + LENGTH - low], data[p - high : p], low, high, row, p, w["single"], w["part"]))
                if len(items) >= RUN:
                    yield from _run_frames(items)
                    items = []
        if items:
            yield from _run_frames(items)

    return texts.select("row", "text", "wanted").mapInPandas(sort, RUN_SCHEMA)


# Merging


class LoserTree:
    """Merges sorted runs of strings with known common prefixes.

    Every run's head carries the length of its common prefix with the string given out last. Of two heads the one with
    the longer such prefix is smaller, without looking at either; only equal lengths are compared, from there on.
    The loser then keeps what it shares with the winner, and that is what it shares with the string given out when
    its turn to play comes again.
    """

    def __init__(self, runs: list[tuple[list[bytes], list[int]]]):
        self.strings = [r[0] for r in runs]
        self.prefixes = [r[1] for r in runs]
        self.at = [0] * len(runs)
        self.shared = [0 if r[0] else -1 for r in runs]
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.loser = [-1] * self.size
        self.winner = self._build(1)

    def _build(self, node: int) -> int:
        if node >= self.size:
            run = node - self.size
            return run if run < len(self.strings) and self.strings[run] else -1
        return self._play(node, self._build(2 * node), self._build(2 * node + 1))

    def _play(self, node: int, a: int, b: int) -> int:
        """The winner of two runs; the loser stays at the node. -1 stands for a run that has ended."""
        if a < 0 or b < 0:
            self.loser[node] = min(a, b)
            return max(a, b)
        x, y = self.shared[a], self.shared[b]
        if x == y:
            s, t = self.strings[a][self.at[a]], self.strings[b][self.at[b]]
            k = _extend(s, t, x)
            if s[k:] > t[k:]:
                a, b = b, a
            self.shared[b] = k
        elif x < y:
            a, b = b, a
        self.loser[node] = b
        return a

    def __iter__(self) -> Iterator[tuple[int, int, int]]:
        """(run, index in it, common prefix with the string before), in order."""
        while (run := self.winner) >= 0:
            k = self.at[run]
            yield run, k, self.shared[run]
            self.at[run] = k + 1
            champion = run
            if k + 1 < len(self.strings[run]):
                self.shared[run] = self.prefixes[run][k + 1]
            else:
                champion = -1
            node = (self.size + run) // 2
            while node:
                champion = self._play(node, champion, self.loser[node])
                node //= 2
            self.winner = champion


def _extend(s: bytes, t: bytes, k: int) -> int:
    """Length of the common prefix of two strings that share k bytes at least."""
    end = min(len(s), len(t))
    step = 16
    while k < end and s[k : k + step] == t[k : k + step]:
        k = min(end, k + step)
    while k < end and s[k] == t[k]:
        k += 1
    return k


def _decoded(run) -> tuple[list[bytes], list[int]]:
    prefixes = list(run.prefixes)
    strings, start, before = [], 0, b""
    for k, size in zip(prefixes, run.sizes):
        before = before[:k] + run.tails[start : start + size]
        start += size
        strings.append(before)
    return strings, prefixes


def repeated_windows(runs: pd.DataFrame) -> pd.DataFrame:
    """(row, low, high): what the windows of single contexts cover that another context of the merged runs holds as well.

    Two windows at distance d before their anchors are equal if their suffixes share LENGTH - d bytes, which the
    prefixes of the merged order tell for whole stretches of it, and the d bytes to the left are equal.
    """
    runs = list(runs.itertuples())
    fields = [
        [np.frombuffer(r.low, np.uint8), np.frombuffer(r.high, np.uint8), np.frombuffer(r.row, np.int64), np.frombuffer(r.place, np.int64), np.frombuffer(r.single, np.uint8)]
        for r in runs
    ]
    left_ends = [np.cumsum(f[1], dtype=np.int64) for f in fields]
    order, prefixes, seen, shared = [], [], set(), LENGTH
    for run, k, prefix in LoserTree([_decoded(r) for r in runs]):
        shared = min(shared, prefix)
        key = (fields[run][2][k], fields[run][3][k])
        if key not in seen:
            seen.add(key)
            order.append((run, k))
            prefixes.append(shared)
            shared = LENGTH
    low, high, row, place, single = (np.array([fields[r][c][k] for r, k in order], np.int64) for c in range(5))
    lefts = np.zeros((len(order), SPAN), np.uint8)
    for i, (r, k) in enumerate(order):
        end, size = left_ends[r][k], high[i]
        lefts[i, :size] = np.frombuffer(runs[r].lefts, np.uint8, size, end - size)[::-1]
    common = np.array(prefixes, np.int64)
    common[:1] = 0
    found = np.zeros((len(order), SPAN + 1), bool)
    hashed = np.zeros(len(order), np.uint64)
    for d in range(SPAN):
        own = np.flatnonzero((low <= d) & (d <= high))
        if len(own) > 1:
            stretch = np.cumsum(common < LENGTH - d).astype(np.uint64)
            _, inverse, count = np.unique(mix64(hashed[own] + stretch[own] * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
            found[own, d] = count[inverse] > 1
        hashed = mix64(hashed + lefts[:, d].astype(np.uint64) + np.uint64(1))
    found &= single[:, None] > 0
    edges = np.diff(np.c_[np.zeros(len(order), np.int8), found.astype(np.int8)], axis=1)
    i, start = np.nonzero(edges == 1)
    _, stop = np.nonzero(edges == -1)
    return pd.DataFrame({"row": row[i], "low": place[i] - (stop - 1), "high": place[i] + LENGTH - start})


def merged(runs: DataFrame) -> DataFrame:
    """(row, low, high): the parts' runs, merged and searched one part at a time."""

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in groups(frames, ["part"]):
            yield repeated_windows(part)

    return runs.repartition("part").sortWithinPartitions("part").mapInPandas(merge, "row long, low long, high long")


def hashed_windows(texts: DataFrame) -> DataFrame:
    """(row, low, high): as ``repeated_windows``, of the ``wanted`` anchors (packed, single, h) of (row, text, wanted).

    Every window is a row of its gram, distance and hash, counted with map-side sums, so that a gram of any number of
    contexts is spread over all tasks. An anchor's windows all overlap, so the outermost repeated ones tell what is covered.
    """

    names = ["h", "d", "window", "row", "place", "single"]

    def whole(held: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame({name: np.concatenate(x) for name, x in zip(names, zip(*held))})

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for frame in frames:
            for row, text, wanted in zip(frame["row"], frame["text"], frame["wanted"]):
                data = np.frombuffer(text.encode(), np.uint8)
                prefix = prefix_hashes(data)
                for w in wanted:
                    p, low, high = w["packed"] >> 16, w["packed"] >> 8 & 255, w["packed"] & 255
                    d = np.arange(low, high + 1)
                    window = span_hashes(prefix, p - d, p - d + LENGTH).view(np.int64)
                    same = [np.full(len(d), x, np.int64) for x in (w["h"], row, p, w["single"])]
                    held.append((same[0], d, window, *same[1:]))
                    if len(held) >= 1000:
                        yield whole(held)
                        held = []
        if held:
            yield whole(held)

    keys = ["h", "d", "window"]
    windows = cut(texts.select("row", "text", "wanted").mapInPandas(find, "h long, d int, window long, row long, place long, single int"))
    at = F.struct("row", "place")
    several = windows.groupBy(*keys).agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first <> last").select(*keys)
    found = join_per_key(windows.where("single = 1"), several, keys).groupBy("row", "place").agg(F.min("d").alias("least"), F.max("d").alias("most"))
    return found.select("row", (F.col("place") - F.col("most")).alias("low"), (F.col("place") - F.col("least") + LENGTH).alias("high"))


def covered(base: DataFrame, dealt: DataFrame) -> DataFrame:
    """(row, spans): for each row with repeated strings, the byte intervals they cover.

    Equal windows have equal grams at their anchors, so parts are dealt by the gram. ``dealt`` is ``base`` shuffled by row.
    """
    known = anchor_rows(base)
    repeated = known.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    members = cut(join_per_key(known, repeated, ["h"]))
    classes = cut(members.groupBy("h", "ctx").agg(F.count("*").alias("n"), F.min(F.struct("row", "packed")).alias("first")))
    several = classes.groupBy("h").agg(F.count("*").alias("contexts")).where("contexts > 1")
    mixed = join_per_key(classes, several, ["h"]).select("h", "contexts", "first.row", "first.packed", (F.col("n") == 1).cast("int").alias("single"))
    hot = F.col("contexts") > HOT
    n, n_hot = mixed.agg(F.count("*"), F.count(F.when(hot, 1))).first()
    parts = max(1, -(-(n - n_hot) // RANGE))
    part = F.pmod(F.xxhash64("h"), F.lit(parts)).cast("int").alias("part")
    wanted = mixed.where(~hot).groupBy("row").agg(F.collect_list(F.struct("packed", "single", part)).alias("wanted"))
    looked = merged(suffix_runs(dealt.join(wanted, "row")))
    if n_hot:
        wanted = mixed.where(hot).groupBy("row").agg(F.collect_list(F.struct("packed", "single", "h")).alias("wanted"))
        looked = looked.union(hashed_windows(dealt.join(wanted, "row")))
    copies = join_per_key(members, classes.where("n > 1").select("h", "ctx"), ["h", "ctx"])
    place, low, high = F.shiftright("packed", 16), F.shiftright("packed", 8).bitwiseAND(255), F.col("packed").bitwiseAND(255)
    whole = copies.select("row", (place - high).alias("low"), (place - low + LENGTH).alias("high"))
    return whole.union(looked).groupBy("row").agg(F.collect_list(F.struct("low", "high")).alias("spans"))


def cut_spans(data: np.ndarray, offsets: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Remaining bytes of each document of a slice without the intervals, and how many maximal ones were cut out of it."""
    n_docs = len(offsets) - 1
    depth = np.zeros(len(data) + 1, np.int32)
    np.add.at(depth, offsets[doc] + low, 1)
    np.add.at(depth, np.minimum(offsets[doc] + high, offsets[doc + 1]), -1)
    gone = np.cumsum(depth[:-1]) > 0
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    at = offsets[:-1][np.diff(offsets) > 0]
    begins[at] = gone[at]
    spans = np.diff(np.concatenate([[0], np.cumsum(begins)])[offsets])
    touched = np.diff(np.concatenate([[0], np.cumsum(gone)])[offsets]) > 0
    kept = []
    for k in range(n_docs):
        own = data[offsets[k] : offsets[k + 1]]
        kept.append((own[~gone[offsets[k] : offsets[k + 1]]] if touched[k] else own).tobytes())
    return kept, spans


def without_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept), one row per input row; ``kept`` are the remaining bytes.

    A byte goes if a 200-byte string that covers it also starts anywhere else, in the same row or another; strings never
    cross rows and are judged on the input. Null texts have no bytes, shorter texts lose none, equal rows all lose
    their bytes, rows without a doc_id count like others, and an empty table gives an empty table. Other columns
    are not read.
    """
    keyed = docs.select("doc_id", F.xxhash64("doc_id", row_key(docs)).alias("row"), text_of(docs).alias("text"))
    dealt = keyed.repartition("row")
    joined = dealt.join(covered(keyed.select("row", "text"), dealt), "row", "left")

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in text_slices(batch):
                spans = batch.column(2).slice(begin, end - begin)
                doc = np.repeat(np.arange(end - begin), spans.value_lengths().fill_null(0).to_numpy())
                bounds = spans.flatten()
                low, high = (bounds.field(c).to_numpy() for c in ("low", "high"))
                kept, runs = cut_spans(data, offsets, doc, low, high)
                size, left = np.diff(offsets), np.array([len(k) for k in kept], np.int64)
                arrays = [batch.column(0).slice(begin, end - begin), *map(pa.array, (size, size - left, runs)), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    kind = dict(docs.dtypes)["doc_id"]
    return joined.select("doc_id", "text", "spans").mapInArrow(cut_out, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
