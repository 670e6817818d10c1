"""Language identification with error-correcting output codes over byte trigrams."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerline.llm.common import cut, text_slices

#: Trigrams are hashed to so many features.
FEATURES = 1 << 13

#: Languages with fewer training documents are not learned.
MIN_DOCS = 3

#: Every FOLDS-th document by checksum is held out from training.
FOLDS = 5

#: Up to so many languages all dichotomies are used as code bits; beyond, random ones.
EXHAUSTIVE = 7

#: A prediction below this score is flagged as ambiguous.
AMBIGUOUS = 0.6

UNDETERMINED = "und"

#: Letters as themselves, in lower case; bytes of other scripts and accents as they are; the rest as 0.
_CLASS = np.zeros(256, np.uint32)
_CLASS[97:123] = np.arange(97, 123)
_CLASS[65:91] = np.arange(97, 123)
_CLASS[128:] = np.arange(128, 256)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature of the trigram around each letter of a slice, and where each document's begin. Documents have blank edges."""
    classes = _CLASS[data]
    padded = np.insert(classes, offsets, np.uint32(0))
    at = np.arange(len(data)) + np.repeat(np.arange(1, len(offsets)), np.diff(offsets))
    letter = classes != 0
    at = at[letter]
    code = padded[at - 1] * np.uint32(0x9E3779B1) + padded[at] * np.uint32(0x85EBCA77) + padded[at + 1] * np.uint32(0xC2B2AE3D)
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x2C1B3C6D)
    return (code >> np.uint32(32 - FEATURES.bit_length() + 1)).astype(np.int64), np.concatenate([[0], np.cumsum(letter)])[offsets]


def codewords(classes: int, seed: int = 11) -> np.ndarray:
    """One row of +1/-1 bits per class. No bit is the same for all classes and no two bits split them alike."""
    if classes < 2:
        return np.ones((classes, 1), np.int8)
    if classes <= EXHAUSTIVE:
        bits = [(1, *b) for b in itertools.product((1, -1), repeat=classes - 1) if -1 in b]
        return np.array(bits, np.int8).T.copy()
    random = np.random.Generator(np.random.PCG64(seed))
    best, distance = None, -1
    for _ in range(200):
        code = random.choice(np.array([1, -1], np.int8), (classes, int(np.ceil(10 * np.log2(classes)))))
        code = np.unique(code * code[0], axis=1)
        code = code[:, (code != code[0]).any(axis=0)]
        least = min(int((code[a] != code[b]).sum()) for a, b in itertools.combinations(range(classes), 2))
        if least > distance:
            best, distance = code, least
    return best


@dataclass(frozen=True)
class Model:
    """Languages in code-point order, their codewords, and the binary classifiers' weights.

    ``weights``: features x bits, log odds of a trigram under the languages of either side; ``scale``: usual size of a
    bit's mean log odds; ``trust``: languages x bits, how well a bit tells its language, each row summing to the
    number of bits.
    """

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    trust: np.ndarray

    def margins(self, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Mean log odds of each bit for each document; 0 without letters."""
        out = np.zeros((len(bounds) - 1, self.code.shape[1]))
        some = np.flatnonzero(np.diff(bounds))
        if len(some):
            sums = np.add.reduceat(self.weights[features], bounds[some], axis=0)
            out[some] = sums / np.diff(bounds)[some, None]
        return out

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language whose codeword has the least trust-weighted logistic loss, and its share in [0, 1]."""
        z = 4 * margins / self.scale
        loss = np.stack([(t * np.logaddexp(0, -z * c)).sum(axis=1) for c, t in zip(self.code, self.trust)], axis=1)
        share = np.exp(loss.min(axis=1, keepdims=True) - loss)
        share /= share.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        return best, share[np.arange(len(best)), best]


def _letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which documents have a letter of any script."""
    ascii_letter = np.zeros(256, bool)
    ascii_letter[65:91] = ascii_letter[97:123] = True
    out = np.diff(np.concatenate([[0], np.cumsum(ascii_letter[data])])[offsets]) > 0
    raw = data.tobytes()
    for k in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        out[k] = any(map(str.isalpha, raw[offsets[k] : offsets[k + 1]].decode()))
    return out


def fit(labelled: DataFrame) -> Model:
    """The model from all rows of (text, lang). Trigram counts per language, a number for each feature, reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for begin, end, data, offsets in text_slices(batch):
                features, bounds = trigrams(data, offsets)
                names, code = np.unique(langs[begin:end], return_inverse=True)
                held = np.bincount(np.repeat(code, np.diff(bounds)) * FEATURES + features, minlength=len(names) * FEATURES)
                for k, name in enumerate(names):
                    own = sums.setdefault(name, np.zeros(FEATURES + 1, np.int64))
                    own[:FEATURES] += held[k * FEATURES : (k + 1) * FEATURES]
                    own[FEATURES] += (code == k).sum()
        for name, own in sums.items():
            found = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(found)), pa.array(found), pa.array(own[found])], ["lang", "feature", "n"])

    counted = labelled.mapInArrow(count, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    counted = cut(counted)
    known = [r["lang"] for r in counted.where((F.col("feature") == FEATURES) & (F.col("n") >= MIN_DOCS)).select("lang").collect()]
    languages = sorted(known)
    table = np.zeros((len(languages), FEATURES))
    if languages:
        for r in counted.where(F.col("lang").isin(languages) & (F.col("feature") < FEATURES)).collect():
            table[languages.index(r["lang"]), r["feature"]] = r["n"]
    code = codewords(len(languages))
    smooth = (table + 0.5) / (table.sum(axis=1, keepdims=True) + 0.5 * FEATURES)
    bits = code.shape[1]
    weights = np.zeros((FEATURES, bits))
    if len(languages) > 1:
        for b in range(bits):
            weights[:, b] = np.log(smooth[code[:, b] > 0].mean(axis=0)) - np.log(smooth[code[:, b] < 0].mean(axis=0))
    draft = Model(languages, code, weights.astype(np.float32), np.ones(bits), np.ones(code.shape))
    return _trusted(draft, labelled) if len(languages) > 1 else draft


def _trusted(draft: Model, labelled: DataFrame) -> Model:
    """The model with its scale and trust, from sums over all training documents of each language."""
    sent = labelled.sparkSession.sparkContext.broadcast(draft)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        place = {name: k for k, name in enumerate(model.languages)}
        n, right, size = np.zeros(len(place), np.int64), np.zeros(model.code.shape, np.int64), np.zeros(model.code.shape)
        for batch in batches:
            langs = np.array([place.get(x, -1) for x in batch.column(1).to_pylist()], np.int64)
            for begin, end, data, offsets in text_slices(batch):
                features, bounds = trigrams(data, offsets)
                margins = model.margins(features, bounds)
                use = (langs[begin:end] >= 0) & (np.diff(bounds) > 0)
                own = langs[begin:end][use]
                np.add.at(n, own, 1)
                np.add.at(right, own, np.sign(margins[use]) == model.code[own])
                np.add.at(size, own, np.abs(margins[use]))
        pairs = list(itertools.product(range(len(place)), range(model.code.shape[1])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in pairs]), pa.array([b for _, b in pairs]), pa.array([int(n[a]) for a, _ in pairs]),
             pa.array([int(right[p]) for p in pairs]), pa.array([float(size[p]) for p in pairs])],
            ["language", "bit", "n", "right", "size"],
        )

    sums = labelled.mapInArrow(judge, "language long, bit long, n long, right long, size double")
    trust, scale, total = np.ones(draft.code.shape), np.zeros(draft.code.shape[1]), 0
    for r in sums.groupBy("language", "bit").agg(*[F.sum(c).alias(c) for c in ("n", "right", "size")]).collect():
        trust[r["language"], r["bit"]] = max(0.05, 2 * (r["right"] + 1) / (r["n"] + 2) - 1)
        scale[r["bit"]] += r["size"]
        total += r["n"] if r["bit"] == 0 else 0
    trust *= draft.code.shape[1] / trust.sum(axis=1, keepdims=True)
    return Model(draft.languages, draft.code, draft.weights, np.maximum(scale / max(total, 1), 1e-6), trust)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Columns of ``docs`` but text, with lang_pred, score and ambiguous."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != "text"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            for begin, end, data, offsets in text_slices(batch):
                best, share = own.decode(own.margins(*trigrams(data, offsets))) if own.languages else (None, np.zeros(end - begin))
                known = _letters(data, offsets) & bool(own.languages)
                name = [own.languages[best[k]] if known[k] else UNDETERMINED for k in range(end - begin)]
                score = np.where(known, np.clip(share, 0.0, 1.0), 0.0)
                arrays = [batch.column(batch.schema.get_field_index(c)).slice(begin, end - begin) for c in kept]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(name), pa.array(score), pa.array(score < AMBIGUOUS)], names)

    names = [*kept, "lang_pred", "score", "ambiguous"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text") + ", lang_pred string, score double, ambiguous boolean"
    return docs.select(*kept, "text").mapInArrow(judge, schema)


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, ambiguous), one row per input row; learned from the rows not held out.

    Training rows have a lang and are not held out; a null doc_id counts as held out. A text without a letter, a null
    or an empty one is ``und`` with score 0, and so is every text where no language was learned, as in an empty
    table. Where one language was learned, all others get it with score 1. Equal texts get equal predictions. Only
    text is read for a prediction, all of it.
    """
    base = docs.select("doc_id", docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang"), held_out(docs["doc_id"]).alias("held_out"))
    model = fit(base.where("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL").select("text", "lang"))
    return predict(base.select("doc_id", "held_out", "text"), model)


def with_language(docs: DataFrame, least: float = 0.0, predicted: bool = False) -> DataFrame:
    """The documents, with their columns, whose language is determined with at least that score; with ``predicted`` their
    lang is the predicted one."""
    base = docs.select(docs["text"].cast("string").alias("text"), docs["lang"].cast("string").alias("lang"), held_out(docs["doc_id"]).alias("held_out"))
    model = fit(base.where("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL").select("text", "lang"))
    judged = predict(docs.select(F.struct(*docs.columns).alias("doc"), docs["text"].cast("string").alias("text")), model)
    told = judged.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    columns = [F.col("lang_pred").alias("lang") if predicted and c == "lang" else F.col("doc")[c].alias(c) for c in docs.columns]
    return told.select(*columns)
