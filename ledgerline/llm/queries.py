"""The named queries of the operators and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm import hilbert, language, line_dedup, minhash, mixing, negatives, neighbours, outliers, packing, pii, subwords, suffixes, whitening
from ledgerline.llm.common import cut, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def documents(spark: SparkSession, directory: str) -> DataFrame:
    return read_table(spark, directory, "documents")


@query
def op1_personal_data(spark, directory):
    found = pii.find(documents(spark, directory))
    counts = [pii.count_of("base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    everything = F.sort_array(F.concat("base", "added"))
    return found.select(
        "doc_id", *counts, F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(everything).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


@query
def op2_line_dedup(spark, directory):
    out = line_dedup.dedup_lines(documents(spark, directory).select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2("text", 256).alias("kept_sha256"))


@query
def op3_robust_outliers(spark, directory):
    return outliers.judge(documents(spark, directory))


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op4_pack_sequences(spark, directory):
    return packing.pack(documents(spark, directory), vocabulary())


@query
def op5_hilbert_shards(spark, directory):
    placed = hilbert.hilbert_shards(documents(spark, directory))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve"
    )


@query
def op6_nn_descent(spark, directory):
    found = neighbours.near_duplicates(read_table(spark, directory, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


@query
def op7_suffix_dedup(spark, directory):
    out = suffixes.without_repeats(documents(spark, directory))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_superminhash(spark, directory):
    """Four words to a shingle, as the contract of this query says; the operator's default is five."""
    found = minhash.near_duplicates(documents(spark, directory), width=4)
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


@query
def op9_output_code_language(spark, directory):
    return language.identify(documents(spark, directory))


@query
def op10_source_mix(spark, directory):
    sized = cut(mixing.measured(documents(spark, directory)))
    mixed = mixing.with_copies(sized, mixing.source_targets(sized))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def piece_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op11_rtree_hard_negatives(spark, directory):
    return negatives.hard_negatives(read_table(spark, directory, "embeddings"))


@query
def op12_merge_round_pieces(spark, directory):
    encoded = subwords.encode(documents(spark, directory), piece_vocabulary())
    return subwords.decode(encoded, piece_vocabulary()).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(subwords.listed(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query
def op13_refined_whitening(spark, directory):
    return whitening.whitened(read_table(spark, directory, "embeddings"))


ORACLE_SQL["op2_line_dedup"] = r"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM doc
),
keyed AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM line
),
heavy AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
judged AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id <> h.last_doc, false) AS gone FROM keyed k LEFT JOIN heavy h ON k.key = h.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

ORACLE_SQL["op10_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 13))::BIGINT::DOUBLE
      / 4503599627370496.0 AS coin
  FROM documents
),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sized GROUP BY source
),
weighted AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap FROM ranked
),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted
),
targets AS (SELECT source, source_size, least(cap::DOUBLE, max(level) OVER () * weight) AS target FROM levels),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets),
mixed AS (
  SELECT s.*, r.source_size, r.target,
    floor(r.rate)::BIGINT + CASE WHEN s.coin < r.rate - floor(r.rate) THEN 1 ELSE 0 END AS copies
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target, size * copies AS taken, source, copies FROM mixed
"""

ORACLE_SQL["op8_superminhash"] = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
gram AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS g
  FROM doc
),
grams AS (SELECT DISTINCT doc_id, g FROM gram),
sized AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT c.a, c.b FROM common c JOIN sized x ON c.a = x.doc_id JOIN sized y ON c.b = y.doc_id
  WHERE 100 * c.both >= 80 * (x.n + y.n - c.both)
),
reach AS (
  SELECT doc_id AS node, doc_id AS low FROM doc
  UNION
  SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.node
),
lowest AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, o.component_id, d.doc_id = o.component_id AS kept
FROM doc d LEFT JOIN sized s ON d.doc_id = s.doc_id JOIN lowest o ON o.node = d.doc_id
"""

ORACLE_SQL["op6_nn_descent"] = """
WITH RECURSIVE unit AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95
),
reach AS (
  SELECT vec_id AS node, vec_id AS low FROM embeddings
  UNION
  SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.node
),
lowest AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, o.component_id, e.vec_id = o.component_id AS kept
FROM embeddings e JOIN lowest o ON o.node = e.vec_id LEFT JOIN degree d ON d.a = e.vec_id
"""

ORACLE_SQL["op11_rtree_hard_negatives"] = """
WITH point AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM point a JOIN point b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER w <= 3
"""
