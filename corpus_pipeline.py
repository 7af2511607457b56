"""Corpus pipeline: quality rules, near-duplicates, decontamination, PII, tokenisation.

Each stage reads what its predecessor wrote. All stages but the last return
the columns of ``documents``; the last adds token ids and digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricewise.llm import bpe, decontaminate, pii, quality_rules, simhash
from pricewise.llm.base import cut
from pricewise.sources.tables import read_table


TEST_KEY = "surrogates-1"       # where the session names none: for tables without real persons' data


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or are outliers of their group go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.remove(docs, read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by surrogates, keyed by the session's ``spark.pricewise.surrogates.key``."""
    return pii.with_surrogates(docs, key=spark.conf.get("spark.pricewise.surrogates.key", TEST_KEY))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit), their count and digests per document."""
    added = {"n_tokens", "ids_sha256", "decoded_sha256", "ids"}
    return bpe.encode(docs, [c for c in docs.columns if c not in added])


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("surrogates", surrogates), ("tokens", tokens)]

# Fingerprint bits over shingle hashes, robust estimates and byte-pair merges have no SQL form;
# the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
