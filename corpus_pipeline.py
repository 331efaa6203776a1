"""Corpus pipeline: stages over ``documents`` built from the operators of ``candela.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages
but the last return the columns of ``docs``.

Defined results: a stage passes NULL and empty texts on by the rule of its
operator (the quality of the empty text, fingerprint zero, no leak, no
secret, no ids); extra columns, whatever their names and types, are kept by
every stage but the last; repeated rows share their fate in every stage but
near-dedup, which keeps one of those that copy each other (rows without a
doc_id all stay); texts of any length are read whole; an empty table passes
through empty.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm import bpe, decontam, quality, secrets, simhash
from candela.llm.common import bounded_batches, stored
from candela.llm.queries import RANKS
from candela.sources.tables import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rule-ensemble quality classifier: documents scored under 0.3 go."""
    bounded_batches(spark)
    return quality.keep_quality(docs, read_table(spark, sf_dir, "labels"), threshold=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: the document of smallest doc_id of each component stays."""
    bounded_batches(spark)
    return simhash.drop_near_duplicates(docs, shingle_words=4, max_bits=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark item within a fifth of its words in edits go."""
    bounded_batches(spark)
    return decontam.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every found secret is replaced by a mark; all documents stay."""
    bounded_batches(spark)
    return secrets.redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of the remaining texts: doc_id, lang, source, n_tokens, ids."""
    bounded_batches(spark)
    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    kept = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    ids = docs.select(*kept, tokenizer.encode_array("text").alias("ids"))
    return ids.select(*kept, F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secrets", redact_secrets),
    ("tokenize", tokenize),
]

#: Fitted models, fingerprints, edit distances and token ids are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
