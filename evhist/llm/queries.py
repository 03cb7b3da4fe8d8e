"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare
from .divergence import audit
from .exact_dedup import exact_dedup
from .lang_id import identify
from .license_scan import scan_licenses
from .minhash import near_duplicates
from .packing import pack
from .periodic import run_report
from .pieces import encode_documents
from .quality import classify
from .sharding import shard_documents
from .suffix_dedup import repeated_bytes
from .token_counts import build, masks, update
from .topk import top_k


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of license phrases and labels of license wordings in every document."""
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the 100-byte strings that also start earlier."""
    return repeated_bytes(_table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place in sequences of at most 1024 tokens."""
    return pack(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned outside the held-out quarter."""
    return identify(_table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels outside the held-out third."""
    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after masking its long digit runs."""
    state = build(_table(spark, sf_dir, "documents"), edits=masks())
    return update(state).drop("_text", "_tree").withColumnRenamed("_id", "doc_id")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece counts and a checksum of the ids of every document, and whether they decode to its text."""
    return encode_documents(_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of equal texts; the largest doc_id stays."""
    docs = _table(spark, sf_dir, "documents")
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    return exact_dedup(docs, carry={"text_sha256": sha})


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near copies (five-word shingles, similarity >= 0.8)."""
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest integer inner products of every hundredth vector with all others."""
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source against the others of its language, and the terms it uses most above it."""
    return audit(_table(spark, sf_dir, "documents"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and place of every document, and its shard when there is one more."""
    return shard_documents(_table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, with repeats planted in every tenth."""
    return run_report(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_language_id": op4_language_id,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_token_counts": op6_token_counts,
    "op7_sentencepiece": op7_sentencepiece,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_exact_topk": op10_exact_topk,
    "op11_source_divergence": op11_source_divergence,
    "op12_sharding": op12_sharding,
    "op13_periodic_runs": op13_periodic_runs,
}

SQL = {
    "op10_exact_topk": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op11_source_divergence": r"""
WITH d AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), g AS (SELECT DISTINCT lang, source FROM d), w AS (
    SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), v AS (
    SELECT lang, term, count(*) AS lang_n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3
), l AS (SELECT lang, count(*) AS v, sum(lang_n) AS total FROM v GROUP BY lang), c AS (
    SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN v USING (lang, term) GROUP BY ALL
), p AS (
    SELECT g.lang, g.source, v.term, v.lang_n, coalesce(c.n, 0) AS n, l.v, l.total,
           sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS own
    FROM g JOIN v USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term
), s AS (
    SELECT *, 1 + (1000000000::HUGEINT * (n + 1)) // (own + v) AS p, 1 + (1000000000::HUGEINT * (lang_n + 1)) // (total + v) AS q FROM p
), f AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pair AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), term AS (
    SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value FROM s WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200""",
    "op8_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
}
