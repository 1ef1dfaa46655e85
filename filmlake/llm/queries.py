"""The registered queries of this subpackage: name -> (Spark query, SQL twin or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlake.session import materialize

from . import (
    bpe,
    collocations,
    exact,
    fingerprints,
    hard_negatives,
    language,
    licences,
    ngram_join,
    packing,
    pii,
    quality,
    suffixes,
    toxicity,
)
from .common import documents

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's votes, posterior, score and whether it is accepted."""
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.fit(docs))


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class and the number of rows it is linked to."""
    return ngram_join.classes(documents(spark, sf_dir)).select("doc_id", "class_id", "n_links")


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, against its edited text's and the next document's."""
    return fingerprints.compare_edited(documents(spark, sf_dir))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of at most 4096 tokens."""
    return pack_documents(documents(spark, sf_dir))


def pack_documents(docs: DataFrame) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of each piece of ``docs``."""
    pieces = packing.token_pieces(docs, WORD_TOKENIZER).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return packing.pack(materialize(pieces, "pieces"))


def byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as counts and digests."""
    coded = bpe.encode(documents(spark, sf_dir), BYTE_RANKS, public_tokenizers.PATTERN)
    counted = coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias(
            "ids_sha256"
        ),
        "ids",
    )
    keep = ("doc_id", "n_tokens", "ids_sha256")
    return bpe.decode(counted, BYTE_RANKS, public_tokenizers.PATTERN, keep).select(
        *keep, F.sha2("bytes", 256).alias("decoded_sha256")
    )


def pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its mentions of personal data replaced."""
    return pii.pseudonymise(documents(spark, sf_dir)).select(
        "doc_id", "lang", "source", F.length("text").cast("long").alias("n_chars"), "n_mentions", "text"
    )


def toxicity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score, from a model fitted to the labels outside fold 1."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score(docs, toxicity.fit(docs, labels))


def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, what is removed of its repeated passages, and the digest of the rest."""
    return suffixes.repeated_spans(documents(spark, sf_dir)).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )


def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the number and the families of its licence notices."""
    docs = documents(spark, sf_dir)
    return licences.scan(docs, licences.fit(docs)).select(
        "doc_id",
        F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct("notices.family")), ",").alias("families"),
        F.array_max("notices.probability").alias("probability"),
    )


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, the one that stays for it and the size of its group."""
    return exact.deduplicate(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of two or three words by their score."""
    return collocations.collocations(documents(spark, sf_dir))


def mined_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hard negatives of every anchor and positive among the embeddings."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return hard_negatives.mine(hard_negatives.vectors(rows))


def language_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by the field learnt from the folds 0 and 2."""
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(language.fold() == 1, F.lit(False)).alias("held_out")
    found = language.predict(docs.select("doc_id", held_out, "text"), language.fit(docs), ("doc_id", "held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


NGRAM_JOIN_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN ['text ' || t] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM words
), grams AS (SELECT doc_id, unnest(s) AS g, len(s) AS n FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING CAST(count(*) AS DOUBLE) / (a.n + b.n - count(*)) >= 0.8
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, p.y FROM reached r JOIN pairs p ON r.y = p.x
)
SELECT x AS doc_id, min(y) AS class_id, (SELECT count(*) FROM pairs p WHERE p.x = r.x) AS n_links
FROM reached r GROUP BY r.x
"""
EXACT_DEDUP_SQL = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS whole
  FROM documents
), groups AS (
  SELECT whole, min(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY whole
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(whole) AS text_sha256
FROM texts JOIN groups USING (whole)
"""
COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
f1 AS (SELECT lang, w, count(*) AS f FROM (SELECT lang, unnest(w) AS w FROM w) GROUP BY lang, w),
f2 AS (
  SELECT lang, w[1] AS w1, w[2] AS w2, count(*) AS f
  FROM (SELECT lang, unnest([w[i:i + 1] FOR i IN range(1, len(w))]) AS w FROM w) GROUP BY ALL HAVING count(*) >= 10
), f3 AS (
  SELECT lang, w[1] AS w1, w[2] AS w2, w[3] AS w3, count(*) AS f
  FROM (SELECT lang, unnest([w[i:i + 2] FOR i IN range(1, len(w) - 1)]) AS w FROM w) GROUP BY ALL HAVING count(*) >= 10
), around AS (
  SELECT lang, w1, w2, max(f) AS most
  FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY lang, w1, w2
), cuts AS (
  SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, p.f AS a, x.f AS l, y.f AS r, 1 AS cut
  FROM f2 p JOIN f1 x ON p.lang = x.lang AND p.w1 = x.w JOIN f1 y ON p.lang = y.lang AND p.w2 = y.w
  LEFT JOIN around o ON o.lang = p.lang AND o.w1 = p.w1 AND o.w2 = p.w2
  WHERE 100 * coalesce(o.most, 0) < 50 * p.f
  UNION ALL
  SELECT p.lang, p.w1 || ' ' || p.w2 || ' ' || p.w3, p.f, x.f, y.f, 1
  FROM f3 p JOIN f1 x ON p.lang = x.lang AND p.w1 = x.w
  JOIN f2 y ON p.lang = y.lang AND p.w2 = y.w1 AND p.w3 = y.w2
  UNION ALL
  SELECT p.lang, p.w1 || ' ' || p.w2 || ' ' || p.w3, p.f, x.f, y.f, 2
  FROM f3 p JOIN f2 x ON p.lang = x.lang AND p.w1 = x.w1 AND p.w2 = x.w2
  JOIN f1 y ON p.lang = y.lang AND p.w3 = y.w
), scored AS (
  SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase, a ORDER BY score, cut) = 1
), totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM lowest JOIN totals USING (lang) QUALIFY rank <= 2000
"""
NEGATIVES_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT * FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, p.other AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
  n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""

QUERIES = {
    "op1_quality_classifier": (quality_classifier, None),
    "op2_ngram_jaccard_join": (ngram_jaccard_join, NGRAM_JOIN_SQL),
    "op3_best_fit_packing": (best_fit_packing, None),
    "op4_document_fingerprints": (document_fingerprints, None),
    "op5_byte_level_bpe": (byte_level_bpe, None),
    "op6_toxicity_trees": (toxicity_trees, None),
    "op7_suffix_array_dedup": (suffix_array_dedup, None),
    "op8_licence_scan": (licence_scan, None),
    "op9_pii_surrogates": (pii_surrogates, None),
    "op10_exact_dedup": (exact_dedup, EXACT_DEDUP_SQL),
    "op11_phrase_collocations": (phrase_collocations, COLLOCATIONS_SQL),
    "op12_hard_negatives": (mined_negatives, NEGATIVES_SQL),
    "op13_language_field": (language_field, None),
}
