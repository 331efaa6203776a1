"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm import (
    ann, bpe, decontam, divergence, fim, licenses, quality, secrets, simhash, tokencount, toxicity, warc, wordbpe,
)
from candela.llm.common import bounded_batches
from candela.session import scratch_dir
from candela.sources.tables import read_table

RANKS = "byte_bpe_multi_50k.tiktoken"
WORD_FILE = "word_bpe_49k.json"
#: The first id that the rank file leaves free.
END_OF_DOCUMENT = 50256


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table; texts go to Python in batches of bounded size."""
    bounded_batches(spark)
    return read_table(spark, sf_dir, "documents")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text encoded to ids and decoded again."""
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return bpe.encode_decode(documents(spark, sf_dir), tokenizer).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License detections of every document's text."""
    found = documents(spark, sf_dir).select("doc_id", licenses.scan("text").alias("r"))
    return found.select(
        "doc_id", "r.n_words", "r.n_base", "r.first_word", "r.last_word", "r.base_labels", "r.labels", "r.score"
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that leak into documents: the best passage of each (word edits up to a fifth)."""
    return decontam.find_leaks(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, scanned once per distinct text through a fresh ledger."""
    found = secrets.scan_versions(documents(spark, sf_dir).select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*[r.kind for r in secrets.BASE_RULES]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(r.kind).alias(f"n_{r.kind}") for r in secrets.BASE_RULES],
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text("spans").alias("spans"),
    )


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC captures, read back and assembled to one row per capture."""
    bounded_batches(spark)
    archive = scratch_dir(spark, "warc")
    warc.write_archive(read_table(spark, sf_dir, "pages"), archive)
    captures = warc.read_captures(spark, archive, with_payload=False)
    return captures.select(
        warc.capture_page_id(F.col("metadata.fields")).alias("page_id"),
        "response.payload_bytes", "response.payload_digest", F.col("response.type").alias("record_type"),
        warc.referred_page_id(F.col("response.refers_to")).alias("refers_to"),
    )


def op6_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted by scanning flat token files for their separators."""
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return tokencount.count_documents(
        documents(spark, sf_dir).select("doc_id", "text"), tokenizer, END_OF_DOCUMENT, scratch_dir(spark, "tokens")
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (4-word shingles, 4 bits)."""
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle_words=4, max_bits=4)
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by the rule ensemble."""
    return quality.score_documents(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document after deobfuscation."""
    return toxicity.score_documents(documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every 20th vector by inner product, over all vectors."""
    bounded_batches(spark)
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), query_every=20, k=20)


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text encoded by word-end BPE and decoded again."""
    tokenizer = wordbpe.Tokenizer(spark, public_tokenizers.path(WORD_FILE))
    return wordbpe.encode_decode(documents(spark, sf_dir), tokenizer).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("decimal").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle form of every document's text, and the text restored from it."""
    seed = F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = fim.transform(docs, seed=seed).select("doc_id", "fim.*")
    return found.select(
        "doc_id", "n", "form",
        F.length("prefix").cast("long").alias("prefix_chars"), F.length("middle").cast("long").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fim.restore(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the term shares of the sources of each lang lie apart, and the terms that set each apart."""
    return divergence.audit(documents(spark, sf_dir), min_docs=30, smooth=5, scale=10**9, top=50)


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_license_scan": op2_license_scan,
    "op3_decontamination": op3_decontamination,
    "op4_secret_scan": op4_secret_scan,
    "op5_warc": op5_warc,
    "op6_token_count": op6_token_count,
    "op7_simhash": op7_simhash,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_ann": op10_ann,
    "op11_word_bpe": op11_word_bpe,
    "op12_fim": op12_fim,
    "op13_divergence": op13_divergence,
}


OP10_SQL = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
  GROUP BY vec_id
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
) WHERE rank <= 20
"""


OP5_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages WHERE page_id IS NOT NULL
), d AS (
  SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, max(page_id) OVER (PARTITION BY hex) AS latest,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
      (CAST('0x' || substr(hex, CAST(1 + 10 * (i // 8) AS BIGINT), 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31 AS BIGINT), 1)), '')
      AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> latest THEN latest END AS refers_to
FROM d
"""


OP12_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex
  FROM documents
), h AS (
  SELECT *, len(units) AS n, CAST('0x' || hex[1:8] AS BIGINT) AS h1, CAST('0x' || hex[9:16] AS BIGINT) AS h2,
    CAST('0x' || hex[17:24] AS BIGINT) AS h3, CAST('0x' || hex[25:32] AS BIGINT) AS h4
  FROM d
), f AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid,
    array_to_string(units[b + 1:n], '') AS suf
  FROM f
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid
    ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), t AS (
  SELECT id, lang, source, unnest(terms) AS term FROM d
), kept AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS total FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 30
), l AS (
  SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(total) AS n FROM kept GROUP BY lang
), c AS (
  SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term
), g AS (
  SELECT DISTINCT lang, source FROM d
), gt AS (
  SELECT g.lang, g.source, k.term, CAST(coalesce(c.n, 0) AS HUGEINT) AS n, k.total
  FROM g JOIN kept k ON k.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), p AS (
  SELECT gt.lang, gt.source, gt.term, gt.n,
    1 + (1000000000 * (gt.n + 5)) // (sum(gt.n) OVER (PARTITION BY gt.lang, gt.source) + 5 * l.v) AS p,
    1 + (1000000000 * (gt.total + 5)) // (l.n + 5 * l.v) AS q
  FROM gt JOIN l ON l.lang = gt.lang
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS f
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q
), r AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM parts
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {"op5_warc": OP5_SQL, "op10_ann": OP10_SQL, "op12_fim": OP12_SQL, "op13_divergence": OP13_SQL}
