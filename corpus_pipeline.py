"""The corpus pipeline: quality rules, near-duplicate removal, benchmark decontamination, secret redaction, encoding.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept. The first four return the
columns of documents, the last the token ids. Stages are meant to be written and read again between each other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import bpe, decontaminate, neardup, quality, secrets
from loomwork.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the certified cutoffs of their language."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates (five words, similarity 0.8)."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without windows of ten words of benchmark items; documents that are mostly such windows go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced."""
    return secrets.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids (packed little-endian unsigned 32-bit integers)."""
    import public_tokenizers

    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return coded.select("doc_id", "lang", "source", (F.octet_length("bpe.ids") / 4).cast("long").alias("n_tokens"), F.col("bpe.ids").alias("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret scans", secret_scan),
    ("encoding", encoding),
]

#: Components, suffix automata and byte-pair merges are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs)
    return docs
