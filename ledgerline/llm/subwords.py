"""Encoding texts into pieces of a byte-fallback merge vocabulary and back, by vectorised merge rounds."""

from __future__ import annotations

import codecs
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import mix64, text_of, text_slices

#: Stands for a space inside pieces.
SPACE = "▁"

#: Kinds of pieces in a vocabulary file.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

#: Pairs that never merge.
NEVER = np.int32(2**31 - 1)

#: Text bytes turned into arrays at a time.
SLICE = 1 << 20


class Vocabulary:
    """Tables of a vocabulary file: first symbols by character, merges by pair, bytes by piece.

    Symbols are piece ids; characters that only occur inside pieces get ids of their own above them. Pairs rank by the score of the
    piece they make, the best first. ``risky`` pieces can make, with a neighbour, a piece of no worse rank than their own.
    """

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto.FromString(model)
        rules, trained = proto.normalizer_spec, proto.trainer_spec
        kinds = np.array([p.type for p in proto.pieces], np.int8)
        plain = not rules.precompiled_charsmap and not rules.remove_extra_whitespaces and rules.escape_whitespaces
        if trained.model_type != trained.BPE or not trained.byte_fallback or not plain or trained.treat_whitespace_as_suffix:
            raise ValueError("not a merge vocabulary with byte fallback and without normalisation")
        if set(kinds.tolist()) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined or unused pieces are not supported")
        self.prefix = bool(rules.add_dummy_prefix)
        texts = [p.piece for p in proto.pieces]
        at = {t: k for k, t in enumerate(texts) if kinds[k] == NORMAL}
        self.size = len(texts)
        self._first_symbols(at)
        self._merges(at, {k: proto.pieces[k].score for k in at.values()})
        self._surfaces(texts, kinds, trained.unk_surface)

    def _first_symbols(self, at: dict[str, int]) -> None:
        self.chars = sorted({c for t in at for c in t})
        self.symbols = {c: at.get(c, self.size + k) for k, c in enumerate(self.chars)}
        place = np.zeros(0x110000, np.int16)
        place[[ord(c) for c in self.chars]] = np.arange(1, len(self.chars) + 1)
        self.place = place
        self.first = np.array([-1, *(self.symbols[c] for c in self.chars)], np.int32)
        self.meets = np.zeros((len(self.first), len(self.first)), bool)
        for t in at:
            own = place[[ord(c) for c in t]]
            self.meets[own[:-1], own[1:]] = True

    def _merges(self, at: dict[str, int], score: dict[int, float]) -> None:
        places = {s: k for k, s in enumerate(sorted(set(score.values()), reverse=True))}
        rank = {k: places[s] for k, s in score.items()}
        known = {**self.symbols, **at}
        keys, made, risky = [], [], set()
        self.width = self.size + len(self.chars)
        for text, piece in at.items():
            for cut in range(1, len(text)):
                left, right = known.get(text[:cut]), known.get(text[cut:])
                if left is None or right is None:
                    continue
                keys.append(left * self.width + right)
                made.append(piece)
                risky |= {k for k in (left, right) if k in rank and rank[piece] <= rank[k]}
        self._table(np.array(keys, np.int64), np.array(made, np.int32), np.array([rank[k] for k in made], np.int32))
        self.risky = np.zeros(self.width, bool)
        self.risky[list(risky)] = True

    def _table(self, keys: np.ndarray, made: np.ndarray, rank: np.ndarray) -> None:
        """Pairs by the hash of their key, at most a quarter full; a pair lies at the first free place from its own on."""
        self.bits = max(8, int(4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.made, self.ranks = np.zeros(1 << self.bits, np.int32), np.full(1 << self.bits, NEVER)
        left, place = np.arange(len(keys)), self._places(keys)
        while len(left):
            free = self.keys[place] < 0
            self.keys[place[free]] = keys[left[free]]
            lost = self.keys[place] != keys[left]
            won = ~lost
            self.made[place[won]], self.ranks[place[won]] = made[left[won]], rank[left[won]]
            left, place = left[lost], (place[lost] + 1) & (len(self.keys) - 1)

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _surfaces(self, texts: list[str], kinds: np.ndarray, unknown: str) -> None:
        blobs = []
        self.bytes = np.zeros(256, np.int32)
        for k, (text, kind) in enumerate(zip(texts, kinds)):
            if kind == BYTE:
                self.bytes[int(text[1:-1], 16)] = k
                blobs.append(bytes([int(text[1:-1], 16)]))
            else:
                blobs.append({NORMAL: text.replace(SPACE, " "), UNKNOWN: unknown, CONTROL: ""}[int(kind)].encode())
        self.lengths = np.array([len(b) for b in blobs], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.pool = np.frombuffer(b"".join(blobs), np.uint8)
        self.is_byte = kinds == BYTE
        self.silent = kinds == CONTROL
        self.opens = np.array([kind == NORMAL and t.startswith(SPACE) for t, kind in zip(texts, kinds)])

    # Merging

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the pairs and the pieces that they make."""
        keys = np.where((left >= 0) & (right >= 0), left.astype(np.int64) * self.width + right, np.int64(-1))
        place = self._places(keys)
        held = self.keys[place]
        on = np.flatnonzero((held != keys) & (held >= 0))
        while len(on):
            place[on] = (place[on] + 1) & (len(self.keys) - 1)
            held = self.keys[place[on]]
            on = on[(held != keys[on]) & (held >= 0)]
        return np.where(self.keys[place] == keys, self.ranks[place], NEVER), self.made[place]

    def merged(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their words after all merges, ordered by word. Words are numbered from 0 and lie in a row.

        Every round finds the best rank of each word and merges its pairs of that rank from the left without overlap; a word
        stops in front of the next pair when a merge has made a neighbouring pair of no worse rank, which then comes first. Words
        without a pair leave the arrays.
        """
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank, made = self._ranks(symbol, word)
        while len(symbol):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            count = np.diff(np.r_[first, len(word)])
            best = np.repeat(np.minimum.reduceat(rank, first), count)
            if (over := best == NEVER).any():
                done.append((symbol[over], word[over]))
                symbol, word, rank, made, best = (a[~over] for a in (symbol, word, rank, made, best))
                continue
            at = self._chosen(symbol, word, made, np.flatnonzero(rank == best), best)
            symbol[at] = made[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            moved = np.zeros(len(symbol), bool)
            moved[at] = True
            moved[at[at > 0] - 1] = True
            moved[at[at > 1] - 2] = True  # the symbol before may itself be gone
            symbol, word, rank, made, moved = (a[keep] for a in (symbol, word, rank, made, moved))
            again = np.flatnonzero(moved)
            rank[again], made[again] = self._ranks(symbol, word, again)
        if not done:
            return symbol, word
        symbol, word = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return symbol[order], word[order]

    def _ranks(self, symbol: np.ndarray, word: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of the pair that begins at each place; none at the end of a word."""
        at = np.arange(len(symbol)) if at is None else at
        after = np.minimum(at + 1, max(len(symbol) - 1, 0))
        rank, made = self.pair(symbol[at], symbol[after])
        return np.where((after > at) & (word[at] == word[after]), rank, NEVER), made

    def _chosen(self, symbol: np.ndarray, word: np.ndarray, made: np.ndarray, found: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Of the pairs of the best ranks, those that merge in this round."""
        run = np.r_[True, found[1:] != found[:-1] + 1]
        start = np.maximum.accumulate(np.where(run, np.arange(len(found)), 0))
        found = found[(np.arange(len(found)) - start) % 2 == 0]
        risky = np.flatnonzero(self.risky[made[found]])
        if not len(risky):
            return found
        own = found[risky]
        piece = made[own]
        adjoins = (risky > 0) & (found[risky - 1] + 2 == own)
        before = np.maximum(own - 1, 0)
        left = np.where(adjoins, made[found[risky - 1]], symbol[before])
        left[(own == 0) | (word[before] != word[own])] = -1
        after = np.minimum(own + 2, len(symbol) - 1)
        right = np.where((own + 2 < len(symbol)) & (word[after] == word[own]), symbol[after], -1)
        unsafe = np.zeros(len(found), np.int64)
        unsafe[risky] = np.minimum(self.pair(left, piece)[0], self.pair(piece, right)[0]) <= best[own]
        earlier = np.cumsum(unsafe) - unsafe
        opened = np.r_[True, word[found[1:]] != word[found[:-1]]]
        base = np.maximum.accumulate(np.where(opened, earlier, 0))
        return found[earlier == base]

    # Whole slices

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a slice and the documents' offsets in them.

        A document is cut where no piece holds both characters, so no merge is lost, and each distinct part is merged once.
        """
        codes = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        bounds = heads[offsets]
        codes = np.where(codes == 32, np.uint32(ord(SPACE)), codes)
        if self.prefix:
            filled = bounds[:-1] < bounds[1:]
            codes = np.insert(codes, bounds[:-1][filled], np.uint32(ord(SPACE)))
            bounds = bounds + np.concatenate([[0], np.cumsum(filled)])
        if not len(codes):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        place = self.place[codes]
        opens = np.ones(len(codes), bool)
        opens[1:] = ~self.meets[place[:-1], place[1:]]
        opens[bounds[:-1][bounds[:-1] < len(codes)]] = True
        starts = np.flatnonzero(opens)
        sample, inverse = distinct(codes, starts)
        ids, at, count = self._encode_parts(codes, place, starts, sample)
        size = count[inverse]
        before = np.concatenate([[0], np.cumsum(size)])
        flat = ids[np.arange(before[-1]) + np.repeat(at[inverse] - before[:-1], size)]
        return flat, before[np.searchsorted(starts, bounds)]

    def _encode_parts(self, codes: np.ndarray, place: np.ndarray, starts: np.ndarray, sample: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the parts one after the other, where each begins, and how many it has."""
        size = np.diff(np.r_[starts, len(codes)])[sample]
        word = np.repeat(np.arange(len(sample)), size)
        own = np.arange(len(word)) + np.repeat(starts[sample] - (np.cumsum(size) - size), size)
        symbol = self.first[place[own]]
        single = size[word] == 1
        whole, part = symbol[single], word[single]
        bare = (whole < 0) | (whole >= self.size)
        merged, of = self.merged(symbol[~single], word[~single])
        loose = merged >= self.size  # characters without a piece of their own that no merge took
        inside = np.array([ord(c) for c in self.chars], np.uint32)
        points = np.concatenate([codes[own[single]][bare], inside[merged[loose] - self.size]])
        letters, letter_of = _utf8(points, np.concatenate([part[bare], of[loose]]))
        position = np.concatenate([np.zeros((~bare).sum(), np.int64), np.flatnonzero(~loose), np.repeat(np.r_[np.zeros(bare.sum(), np.int64), np.flatnonzero(loose)], _widths(points))])
        ids = np.concatenate([whole[~bare], merged[~loose], self.bytes[letters]])
        owner = np.concatenate([part[~bare], of[~loose], letter_of])
        order = np.lexsort((position, owner))
        count = np.bincount(owner, minlength=len(sample))
        return ids[order], np.cumsum(count) - count, count

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The text of each run of ids. Bytes that form no character become U+FFFD one by one."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("an id lies outside the vocabulary")
        size = self.lengths[ids]
        before = np.concatenate([[0], np.cumsum(size)])
        out = self.pool[np.arange(before[-1]) + np.repeat(self.starts[ids] - before[:-1], size)]
        first = before[bounds[:-1]].copy()
        if self.prefix and len(ids):
            said = np.flatnonzero(~self.silent[ids])
            at = np.searchsorted(said, bounds[:-1])
            has = at < len(said)
            lead = said[np.minimum(at, len(said) - 1)] if len(said) else np.zeros(len(at), np.int64)
            has &= lead < bounds[1:]
            first[has & self.opens[ids[lead]]] += 1
        raw = out.tobytes()
        texts = [raw[a:b].decode(errors="ledgerline-bytewise") for a, b in zip(first.tolist(), before[bounds[1:]].tolist())]
        for row in np.unique(np.searchsorted(bounds, np.flatnonzero(self.silent[ids]), "right") - 1).tolist():
            # a piece without text ends a run of bytes
            cuts = before[bounds[row] + np.flatnonzero(self.silent[ids[bounds[row] : bounds[row + 1]]])]
            ends = [int(first[row]), *np.maximum(cuts, first[row]).tolist(), int(before[bounds[row + 1]])]
            texts[row] = "".join(raw[a:b].decode(errors="ledgerline-bytewise") for a, b in zip(ends[:-1], ends[1:]))
        return texts


def _bytewise(error: UnicodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("ledgerline-bytewise", _bytewise)


def _widths(points: np.ndarray) -> np.ndarray:
    return 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)


def _utf8(points: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the characters, and the owner of each byte."""
    data = np.frombuffer(points.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
    return data, np.repeat(owner, _widths(points))


def distinct(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs that begin at ``starts``: one index for each distinct run, and each run's place among these.

    Hashes find equal runs; every run is then compared with its representative, and one that differs stands for itself.
    """
    size = np.diff(np.r_[starts, len(codes)])
    inside = np.arange(len(codes)) - np.repeat(starts, size)
    hashes = np.add.reduceat(mix64(codes.astype(np.uint64) | inside.astype(np.uint64) << np.uint64(21)), starts)
    _, sample, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    same = size[sample][inverse] == size
    twin = np.minimum(inside + np.repeat(starts[sample][inverse], size), len(codes) - 1)
    same &= np.logical_and.reduceat(codes[twin] == codes, starts)
    odd = np.flatnonzero(~same)
    inverse[odd] = len(sample) + np.arange(len(odd))
    return np.concatenate([sample, odd]), inverse


_VOCABULARY: dict[int, Vocabulary] = {}


def _vocabulary(model: bytes) -> Vocabulary:
    """One per Python worker, kept between its tasks."""
    key = zlib.crc32(model)
    if key not in _VOCABULARY:
        _VOCABULARY.clear()
        _VOCABULARY[key] = Vocabulary(model)
    return _VOCABULARY[key]


def _sent(df: DataFrame, path: str):
    with open(path, "rb") as f:
        model = f.read()
    Vocabulary(model)  # a file that cannot be used ends here, not in a task
    return df.sparkSession.sparkContext.broadcast(model)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): the piece ids of every whole text, without begin or end ids.

    The vocabulary file is read by the driver and travels with the tasks. Null and empty texts have no ids; a text of any length is a
    slice of its own; repeated rows give repeated rows; an empty table gives an empty table. Other columns are not
    read. Two spaces or more in a row merge one after the other, so the rounds grow with the longest such run.
    """
    model = _sent(docs, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model.value)
        for batch in batches:
            for begin, end, data, offsets in text_slices(batch, limit=SLICE):
                ids, bounds = vocabulary.encode(data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, end - begin), lists], ["doc_id", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", text_of(docs).alias("text")).mapInArrow(work, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text): the text that each row's ids stand for; null or no ids give an empty text."""
    model = _sent(encoded, path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model.value)
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, _rows_of_a_slice(batch, start))
                lists = part.column(1)
                bounds = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()) * lists.is_valid().to_numpy(zero_copy_only=False))])
                texts = vocabulary.decode(lists.flatten().to_numpy(zero_copy_only=False), bounds)
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])
                start += part.num_rows

    kind = dict(encoded.dtypes)["doc_id"]
    filled = F.coalesce("ids", F.array().cast("array<int>")).alias("ids")
    return encoded.select("doc_id", filled).mapInArrow(work, f"doc_id {kind}, ids array<int>, text string")


def _rows_of_a_slice(batch: pa.RecordBatch, start: int) -> int:
    offsets = batch.column(1).offsets.to_numpy()
    end = int(np.searchsorted(offsets, offsets[start] + SLICE // 4, "right")) - 1
    return max(end - start, 1)


def listed(ids: Column) -> Column:
    """Ids in decimal, joined by commas."""
    return F.concat_ws(",", ids.cast("array<string>"))
