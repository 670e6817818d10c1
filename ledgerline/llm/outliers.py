"""Quality rules: robust multivariate outliers per language and source by minimum covariance determinants."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerline.llm.common import cut, mix64, prefix_hashes, shingles, span_hashes, text_of, text_slices, words

#: Words of the windows whose repetition is counted.
WINDOW = 8

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_SALT = np.uint64(0x9E3779B97F4A7C15)

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeated(hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which hashes occur more than once in their document, and which of them are not the first there."""
    key = mix64(hashes ^ (doc.astype(np.uint64) * _SALT))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    out = np.zeros((2, len(key)), bool)
    out[0, order[1:]] = out[1, order[1:]] = same
    out[0, order[:-1]] |= same
    return out


def slice_statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """STATISTICS of each document of a slice, as columns."""
    n_docs = len(offsets) - 1
    starts, ends, first = words(data, offsets)
    prefix = prefix_hashes(data)

    def per_doc(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(marks)])[bounds])

    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    begins = (data & 0xC0) != 0x80
    chars = per_doc((np.cumsum(inside[:-1]) > 0) & begins if len(data) else begins, offsets)

    line_starts = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 10) + 1]))
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.append(line_starts[1:], len(data))
    closed = (line_ends > line_starts) & (data[line_ends - 1] == 10) if len(line_starts) else np.zeros(0, bool)
    filled = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_doc = np.searchsorted(offsets, line_starts, "right") - 1
    spans = span_hashes(prefix, line_starts, line_ends - closed)[filled]
    dup = np.bincount(line_doc[filled][_repeated(spans, line_doc[filled])[1]], minlength=n_docs)

    hashed = span_hashes(prefix, starts, ends)
    windows, doc = shingles(hashed, first, WINDOW)
    cover = np.zeros(len(hashed) + 1, np.int64)
    if len(windows):
        word_doc = np.repeat(np.arange(n_docs), np.diff(first))
        at = np.flatnonzero(word_doc[: len(hashed) - WINDOW + 1] == word_doc[WINDOW - 1 :])[_repeated(windows, doc)[0]]
        cover[at] += 1
        cover[at + WINDOW] -= 1
    again = per_doc(np.cumsum(cover)[:-1] > 0, first)
    return np.stack([np.diff(first), chars, per_doc(_SYMBOL[data], offsets), dup, again], axis=1).astype(np.int64)


# Statistic vectors and their robust fit

#: Dimensions of the vector and the least standard deviation each is given: word length (log), symbols per word
#: (log), repeated lines (log), share of words in repeated windows. Without the floors, a statistic that is zero for
#: most documents would make every other value of it an outlier.
FLOORS = {"x_word_length": 0.1, "x_symbols": 0.15, "x_dup_lines": 0.5, "x_repeats": 0.1}
AXES = list(FLOORS)
DIM = len(AXES)

#: Share of a group's rows that determines its centre and scatter.
SUBSET = 0.75

#: Groups of fewer rows are pooled: sources of a language, then all; a pool that stays smaller rejects nothing.
MIN_ROWS = 40

#: Concentration steps from each of the two starts.
STEPS = 5

#: Share of normal rows that the cutoff keeps.
COVERAGE = 0.9999

#: Histogram bins per factor e of squared distance, by which the subset is cut.
BINS = 32


def chi_square_quantile(p: float, dim: int = DIM) -> float:
    """For an even dimension, by bisection of the closed form."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        tail = math.exp(-mid / 2) * sum((mid / 2) ** k / math.factorial(k) for k in range(dim // 2))
        low, high = (mid, high) if 1 - tail < p else (low, mid)
    return low


def statistics(docs: DataFrame) -> DataFrame:
    """Columns of ``docs`` but text, with STATISTICS."""
    kept = [c for c in docs.columns if c != "text"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, offsets in text_slices(batch):
                found = slice_statistics(data, offsets)
                arrays = [batch.column(batch.schema.get_field_index(c)).slice(begin, end - begin) for c in kept]
                yield pa.RecordBatch.from_arrays([*arrays, *(pa.array(found[:, k]) for k in range(len(STATISTICS)))], [*kept, *STATISTICS])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    return docs.select(*kept, "text").mapInArrow(count, schema + "".join(f", {c} long" for c in STATISTICS))


def base_rule():
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def vectors(counted: DataFrame) -> DataFrame:
    n = F.col("n_words")
    return counted.withColumns(
        {
            "x_word_length": F.log(F.col("word_chars") / n),
            "x_symbols": F.log1p(F.col("n_symbols") / n),
            "x_dup_lines": F.log1p(F.col("n_dup_lines").cast("double")),
            "x_repeats": F.col("n_repeat_words") / n,
        }
    )


def grouped(rows: DataFrame) -> DataFrame:
    """Adds ``cell``: language and source, or a pool where those are few; null where the pool is small as well."""
    def name(level: int, *columns: str):
        return F.to_json(F.struct(F.lit(level).alias("level"), *columns))

    out = rows.withColumn("cell", name(0, "lang", "source"))
    for pool in (name(1, "lang"), name(2), F.lit(None).cast("string")):
        few = out.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") < MIN_ROWS).select(F.col("cell").alias("few"))
        out = out.join(few, out["cell"] == few["few"], "left").withColumn("cell", F.when(F.col("few").isNotNull(), pool).otherwise(F.col("cell"))).drop("few")
    return out


def _squared(rows: DataFrame) -> DataFrame:
    """Adds ``d2``, the squared Mahalanobis distance by ``centre`` and ``precision`` (row-major)."""
    z = [F.col(a) - F.col("centre")[i] for i, a in enumerate(AXES)]
    terms = [F.col("precision")[i * DIM + j] * z[i] * z[j] * (1 if i == j else 2) for i in range(DIM) for j in range(i, DIM)]
    return rows.withColumn("d2", sum(terms[1:], terms[0]))


_FIT = "cell string, start int, centre array<double>, precision array<double>, logdet double"
_PRODUCTS = [(i, j) for i in range(DIM) for j in range(i, DIM)]


def _moments(rows: DataFrame, keys: list[str], axes: list[str]) -> DataFrame:
    """Count, sums and sums of products of the axes: partial sums in every task, one row per key."""
    sums = [F.sum(a).alias(f"s{i}") for i, a in enumerate(axes)]
    products = [F.sum(F.col(axes[i]) * F.col(axes[j])).alias(f"s{i}{j}") for i, j in _PRODUCTS]
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), *sums, *products)


def _covariance(r) -> tuple[np.ndarray, np.ndarray]:
    mean = np.array([r[f"s{i}"] for i in range(DIM)]) / r["n"]
    scatter = np.zeros((DIM, DIM))
    for i, j in _PRODUCTS:
        scatter[i, j] = scatter[j, i] = r[f"s{i}{j}"] / r["n"] - mean[i] * mean[j]
    return mean, scatter


def _fits(rows: list[tuple]) -> pd.DataFrame:
    """Fits from (cell, start, centre, scatter): floors are added before inverting."""
    ridge = np.diag(np.square(list(FLOORS.values())))
    out = []
    for cell, start, centre, scatter in rows:
        whole = scatter + ridge
        out.append((cell, start, centre.tolist(), np.linalg.inv(whole).reshape(-1).tolist(), float(np.linalg.slogdet(whole)[1])))
    return pd.DataFrame(out, columns=["cell", "start", "centre", "precision", "logdet"])


def first_fits(rows: DataFrame) -> DataFrame:
    """Two starts per cell: medians with median absolute deviations, alone and with correlations of bounded values."""
    middle = rows.groupBy("cell").agg(F.array(*[F.percentile_approx(a, 0.5, 1000) for a in AXES]).alias("m"))
    off = rows.join(middle, "cell").withColumns({f"o{i}": F.abs(F.col(a) - F.col("m")[i]) for i, a in enumerate(AXES)})
    spread = off.groupBy("cell").agg(F.first("m").alias("m"), F.array(*[1.4826 * F.percentile_approx(f"o{i}", 0.5, 1000) for i in range(DIM)]).alias("mad"))
    spread = cut(spread)
    scales = [F.sqrt(F.pow(F.col("mad")[i], 2) + F.lit(f**2)) for i, f in enumerate(FLOORS.values())]
    bounded = rows.join(spread, "cell").withColumns({f"t{i}": F.tanh((F.col(a) - F.col("m")[i]) / scales[i]) for i, a in enumerate(AXES)})
    summed = _moments(bounded, ["cell"], [f"t{i}" for i in range(DIM)]).join(spread, "cell")

    def start(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.to_dict("records"):
                centre, mad = np.array(r["m"], float), np.array(r["mad"], float)
                _, scatter = _covariance(r)
                unit = np.sqrt(np.maximum(np.diag(scatter), 1e-12))
                out += [(r["cell"], 0, centre, np.diag(mad**2)), (r["cell"], 1, centre, scatter / np.outer(unit, unit) * np.outer(mad, mad))]
            yield _fits(out)

    return cut(summed.mapInPandas(start, _FIT))


def concentrated(rows: DataFrame, fits: DataFrame) -> DataFrame:
    """Fits to the nearest rows of each cell and start; the subset is cut at a bin of the squared distances."""
    near = _squared(rows.join(fits, "cell")).select("cell", "start", *AXES, F.floor(F.log(F.col("d2") + 1e-9) * BINS).cast("int").alias("bin"))
    counts = near.groupBy("cell", "start", "bin").agg(F.count("*").alias("n"))
    so_far = F.expr("sum(n) OVER (PARTITION BY cell, start ORDER BY bin)")
    all_rows = F.expr("sum(n) OVER (PARTITION BY cell, start)")
    last = counts.withColumn("so_far", so_far).withColumn("all", all_rows).where(F.col("so_far") >= SUBSET * F.col("all"))
    border = last.groupBy("cell", "start").agg(F.min("bin").alias("border"))
    summed = _moments(near.join(border, ["cell", "start"]).where("bin <= border"), ["cell", "start"], AXES)

    def refit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield _fits([(r["cell"], r["start"], *_covariance(r)) for r in frame.to_dict("records")])

    return cut(summed.mapInPandas(refit, _FIT))


def determinants(rows: DataFrame) -> DataFrame:
    """(cell, centre, precision): of both starts' ends the one of the smaller determinant, scaled to the median distance."""
    fits = first_fits(rows)
    for _ in range(STEPS):
        fits = concentrated(rows, fits)
    best = fits.groupBy("cell").agg(F.min(F.struct("logdet", "start", "centre", "precision")).alias("b")).select("cell", "b.centre", "b.precision")
    half = _squared(rows.join(best, "cell")).groupBy("cell").agg((F.percentile_approx("d2", 0.5, 1000) / chi_square_quantile(0.5)).alias("factor"))
    scaled = F.transform("precision", lambda p: p / F.greatest(F.col("factor"), F.lit(1.0)))
    return cut(best.join(half, "cell").select("cell", "centre", scaled.alias("precision")))


def judge(docs: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, statistics, base_failed, distance, kept), one row per input row.

    ``kept`` is false for rows that fail the base rule and for rows whose vector lies beyond the chi-square cutoff of
    their language and source. Null and empty texts have no words and fail the base rule. Null languages and sources
    are groups of their own. Equal rows are judged alike and each count. Rows in pools of fewer than MIN_ROWS are
    not judged by distance (null) and kept. An empty table gives an empty table. Other columns are not read.
    """
    base = docs.select("doc_id", docs["lang"].cast("string").alias("lang"), docs["source"].cast("string").alias("source"), text_of(docs).alias("text"))
    counted = cut(statistics(base).withColumn("base_failed", base_rule()))
    rows = cut(grouped(vectors(counted.where("NOT base_failed"))))
    judged = _squared(rows.join(determinants(rows.where("cell IS NOT NULL")), "cell", "left"))
    names = ["doc_id", *STATISTICS, "base_failed"]
    kept = F.coalesce(F.col("d2") <= chi_square_quantile(coverage), F.lit(True))
    failed = counted.where("base_failed").select(*names, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return judged.select(*names, F.sqrt("d2").alias("distance"), kept.alias("kept")).union(failed)
