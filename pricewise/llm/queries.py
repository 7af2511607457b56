"""Queries of the training-data operators on the driver tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewise.sources.tables import read_table

from . import (alignment, bpe, chat, conversation_trie, decontaminate, license_scan, pii, quality_model, quality_rules, simhash,
               url_filter, warc, wordpiece)
from .base import cut, scratch_path
from .oracle import ORACLE  # noqa: F401 - registered with the queries

PUBLIC_KEY = "surrogates-1"      # of the test tables, which hold no real person's data

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@_query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), ["doc_id"], keep_ids=False)


@_query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@_query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                                  read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))


@_query
def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))


@_query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@_query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                                read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


@_query
def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source"]))


@_query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(read_table(spark, sf_dir, "documents", ["doc_id", "text"]), key=PUBLIC_KEY)


@_query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@_query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    hard = "\\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"))
    return chat.digests(chat.format_turns(said.unionByName(more)))


@_query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    turns = cut(conversation_trie.turn_table(said), "trie-turns")
    return conversation_trie.prefix_trie(conversation_trie.share_openings(turns))


@_query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_table(spark, sf_dir, "documents", ["doc_id", "text"])).drop("groups")


@_query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    return warc.round_trip(pages, scratch_path(spark, "warc")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
