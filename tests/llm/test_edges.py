"""Every operator on odd rows, on an empty table, with clashing extra columns and with null ids, langs and sources."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import hilbert, language, line_dedup, minhash, mixing, neighbours, outliers, packing, pii, queries, suffixes
from llm_data import DOCUMENTS, ODD, rows

PER_ROW = {
    "pii": pii.find,
    "line_dedup": line_dedup.dedup_lines,
    "outliers": outliers.judge,
    "hilbert": hilbert.hilbert_shards,
    "suffixes": suffixes.without_repeats,
    "minhash": minhash.near_duplicates,
    "language": language.identify,
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_each_odd_row(spark, make, name):
    table = [(k, t, "en" if k % 2 else None, None if k % 3 else "s") for k, t in enumerate(ODD)] + [(None, "no id at all", None, None)] * 2
    docs = make(table).withColumns({c: F.lit("clash") for c in ("rank", "row", "shard", "size", "key", "n", "node", "h", "d2", "base", "coin", "curve")})
    out = PER_ROW[name](docs)
    assert out.count() == len(table)
    assert {r[0] for r in out.select("doc_id").collect()} == {r[0] for r in table}


@pytest.mark.parametrize("name", [*PER_ROW, "mix", "pack"])
def test_empty_table(spark, make, name):
    docs = make([])
    fn = {"mix": mixing.mix, "pack": lambda d: packing.pack(d, queries.vocabulary())} | PER_ROW
    assert fn[name](docs).collect() == []


def test_stages_keep_columns_and_survive_odd_rows(spark, make):
    docs = make([(k, t, "en", None if k % 3 else "s") for k, t in enumerate(ODD)] + [(None, "no id at all", None, None)] * 2)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "unused")
        assert docs.columns == [f.split()[0] for f in DOCUMENTS.split(", ")]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "unused").count() >= docs.count() > 0


def test_odd_vectors_are_left_alone(spark):
    vectors = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [1.0, 0.0]), (7, [2.0, 0.0]), (8, [1.0, 0.0, 0.0]), (None, [1.0, 0.0])]
    out = neighbours.near_duplicates(spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("node", F.lit(1)))
    assert rows(out) == sorted([(k, int(k in (6, 7)), 6 if k == 7 else k) if k else (None, 0, None) for k, _ in vectors], key=repr)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.near_duplicates(empty).collect() == []
