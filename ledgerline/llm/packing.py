"""Packing tokenised documents into sequences: shortest pack first over the length histogram."""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import cut, prefix_hashes, ranks, same_spans, span_hashes, text_of, text_slices, words

#: Tokens of a sequence.
SEQUENCE = 4096

#: Closes every document.
END_ID = 2

#: Pieces of one length that are ordered together.
BUCKET_ROWS = 100_000

#: Words that a Python worker remembers with their ids, about 70 bytes each; beyond it those that were met once go.
CACHE_WORDS = 400_000

#: Words of these characters only can skip the normaliser and the splitter: lower-casing is all they do to them.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?|]*)")

_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Bytes as the characters byte-level vocabularies write them with: printable ones as they are, the rest from 256 on.
_BYTE_CHARS = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + n) for n, b in enumerate(sorted({*range(256)} - {*_PRINTABLE}))}


def _taken(pool: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans of a pool one after another, and where each begins then."""
    begin = np.cumsum(size) - size
    return pool[np.arange(size.sum()) + np.repeat(at - begin, size)], begin


class WordTokens:
    """Token ids of whole texts, each distinct word tokenised once.

    The vocabulary drops white space before it merges, so a text's ids are its words' ids in a row.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.model = self.tokenizer.model
        self._forget()

    def _forget(self) -> None:
        self.keys, self.at, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)
        self.text, self.text_at, self.text_size = np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.again = np.zeros(0, bool)

    def _forget_rare(self) -> None:
        """Keeps the words that were met again since the last time, or none if these alone would soon fill it."""
        held = np.flatnonzero(self.again)
        if 2 * len(held) > CACHE_WORDS:
            return self._forget()
        self.keys, self.count, self.text_size = self.keys[held], self.count[held], self.text_size[held]
        self.pool, self.at = _taken(self.pool, self.at[held], self.count)
        self.text, self.text_at = _taken(self.text, self.text_at[held], self.text_size)
        self.again = np.zeros(len(held), bool)

    def word_ids(self, word: str) -> list[int]:
        if plain := _PLAIN.fullmatch(word):
            parts = (plain[1].lower(), plain[2])
            return [t.id for p in parts if p for t in self.model.tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(_BYTE_CHARS))]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _learn(self, keys: np.ndarray, new: list[bytes]) -> None:
        ids = [self.word_ids(word.decode()) for word in new]
        count, size = np.array([len(x) for x in ids], np.int64), np.array([len(w) for w in new], np.int64)
        at = len(self.pool) + np.cumsum(count) - count
        text_at = len(self.text) + np.cumsum(size) - size
        self.pool = np.concatenate([self.pool, np.array([i for x in ids for i in x], np.uint32)])
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(new), np.uint8)])
        place = np.searchsorted(self.keys, keys)
        held = ((self.keys, keys), (self.at, at), (self.count, count), (self.text_at, text_at), (self.text_size, size), (self.again, False))
        self.keys, self.at, self.count, self.text_at, self.text_size, self.again = (np.insert(a, place, b) for a, b in held)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all documents of a slice, each closed by ``END_ID``, and the offsets of the documents in them.

        Hashes find the words that are known; every word is then compared byte by byte with the one its ids were made of.
        """
        starts, ends, first = words(data, offsets)
        size = ends - starts
        keys, sample, inverse = np.unique(span_hashes(prefix_hashes(data), starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > CACHE_WORDS:
            self._forget_rare()
        place = np.searchsorted(self.keys, keys)
        known = self.keys[np.minimum(place, len(self.keys) - 1)] == keys if len(self.keys) else np.zeros(len(keys), bool)
        self.again[place[known]] = True
        raw = data.tobytes()
        if not known.all():
            fresh = np.flatnonzero(~known)
            self._learn(keys[fresh], [raw[starts[k] : ends[k]] for k in sample[fresh]])
            place = np.searchsorted(self.keys, keys)
        same = self.text_size[place][inverse] == size
        same[same] = same_spans(data, starts[same], self.text, self.text_at[place][inverse][same], size[same])
        at, count, pool = self.at[place][inverse], self.count[place][inverse], self.pool
        if not same.all():  # words of another word's hash
            odd = np.flatnonzero(~same)
            own = [self.word_ids(raw[starts[k] : ends[k]].decode()) for k in odd]
            count[odd] = [len(x) for x in own]
            at[odd] = len(pool) + np.cumsum(count[odd]) - count[odd]
            pool = np.concatenate([pool, np.array([i for x in own for i in x], np.uint32)])
        before = np.concatenate([[0], np.cumsum(count)])
        n_docs = len(offsets) - 1
        bounds = before[first] + np.arange(n_docs + 1)
        ids = np.full(int(bounds[-1]), END_ID, np.uint32)
        doc = np.repeat(np.arange(n_docs), np.diff(first))
        place_of = np.arange(before[-1])
        ids[place_of + np.repeat(doc, count)] = pool[place_of + np.repeat(at - before[:-1], count)]
        return ids, bounds


_TOKENS: dict[int, WordTokens] = {}


def _tokens(vocabulary: str) -> WordTokens:
    """One per Python worker, kept between its tasks."""
    key = zlib.crc32(vocabulary.encode())
    if key not in _TOKENS:
        _TOKENS.clear()
        _TOKENS[key] = WordTokens(vocabulary)
    return _TOKENS[key]


def pieces(docs: DataFrame, vocabulary_path: str, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]): every document cut at multiples of the sequence length.

    The vocabulary file is read by the driver and travels with the tasks. ``ids`` are little-endian 32-bit numbers.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(vocabulary.value)
        for batch in batches:
            for begin, end, data, offsets in text_slices(batch):
                ids, bounds = tokens.encode(data, offsets)
                total = np.diff(bounds)
                parts = -(-total // sequence)
                doc = np.repeat(np.arange(end - begin), parts)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)) * sequence
                length = np.minimum(sequence, total[doc] - start)
                low = bounds[doc] + start
                blobs = [ids[a : a + n].astype("<u4").tobytes() for a, n in zip(low, length)]
                columns = [
                    batch.column(0).slice(begin, end - begin).take(pa.array(doc)), pa.array(start), pa.array(length),
                    pa.array(np.array([zlib.crc32(b) for b in blobs], np.int64)), pa.array(total[doc]),
                ]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(blobs, pa.binary())] * with_ids, names + ["ids"] * with_ids)

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return docs.select("doc_id", text_of(docs).alias("text")).mapInArrow(cut_up, schema)


def shortest_pack_first(counts: dict[int, int], sequence: int = SEQUENCE) -> dict[str, np.ndarray]:
    """Slots for the pieces of each length: arrays length, first_rank, count, sequence_id, offset.

    Lengths are placed longest first. All packs of one pattern form a group; a length goes to the groups of the
    shortest packs, one piece to a pack, and splits a group that is larger than what is left of it. Where no pack has
    room, the rest opens packs. A slot says: ranks first_rank .. first_rank + count - 1 of that length lie at
    ``offset`` in the sequences from ``sequence_id`` on. Work and output depend on the number of lengths, not on the
    number of pieces.
    """
    heap: list[tuple[int, int, int, list]] = []  # fill, order of making, packs, [(length, offset, first rank)]
    made = 0
    for length in sorted((k for k, n in counts.items() if n), reverse=True):
        left, rank, moved = counts[length], 0, []
        while left and heap and heap[0][0] + length <= sequence:
            fill, order, packs, slots = heapq.heappop(heap)
            used = min(left, packs)
            if used < packs:
                heapq.heappush(heap, (fill, order, packs - used, [(a, b, r + used) for a, b, r in slots]))
            made += 1
            heapq.heappush(heap, (fill + length, made, used, [*slots, (length, fill, rank)]))
            left, rank = left - used, rank + used
        if left:
            made += 1
            heapq.heappush(heap, (length, made, left, [(length, 0, rank)]))
    rows, base = [], 0
    for _, _, packs, slots in sorted(heap, key=lambda g: g[1]):
        rows += [(a, r, packs, base, b) for a, b, r in slots]
        base += packs
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "first_rank", "count", "sequence_id", "offset"), table.T.copy()))


def pack(docs: DataFrame, vocabulary_path: str, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence_id and offset; every sequence is filled from 0 without gaps.

    Only the histogram of piece lengths (``sequence`` numbers at most) reaches the driver, and only the slots made of
    it are broadcast. Pieces find their slot by their rank among the pieces of their length. Null and empty texts
    are one closing id; a text of any length is cut; equal rows give equal pieces in different slots; an empty table
    gives an empty table. Other columns are not read.
    """
    cut_pieces = cut(pieces(docs, vocabulary_path, sequence, with_ids))
    histogram = {r["length"]: r["count"] for r in cut_pieces.groupBy("length").count().collect()}
    table = docs.sparkSession.sparkContext.broadcast(shortest_pack_first(histogram, sequence))
    ranked = ranks(cut_pieces, "length", ["doc_id", "start", "ids_crc32"], BUCKET_ROWS)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = table.value
        wide = np.int64(1) << np.int64(40)
        keys = slots["length"] * wide + slots["first_rank"]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length * wide + rank, "right") - 1
            where = [slots["sequence_id"][at] + rank - slots["first_rank"][at], slots["offset"][at]]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(x) for x in where], [*names, "sequence_id", "offset"])

    names = cut_pieces.columns
    schema = ", ".join(f"{c} {t}" for c, t in cut_pieces.dtypes) + ", sequence_id long, offset long"
    return ranked.select(*names, "rank").mapInArrow(place, schema)
