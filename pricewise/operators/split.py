"""Reproducible hash split and exact-size seeded sample.

Both are functions of the row key only, so they select the same rows in
every engine, every run and every partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewise.config import RANDOM_STATE, TEST_PERCENT
from pricewise.operators.dims import written


def key_text(keys: list[str], seed: int | None = None) -> Column:
    parts = [F.col(k).cast("string") for k in keys]
    if seed is not None:
        parts.append(F.lit(str(seed)))
    return F.concat_ws("|", *parts)


def bucket(keys: list[str]) -> Column:
    """0..99 from the first 32 bits of md5(key)."""
    return F.conv(F.substring(F.md5(key_text(keys)), 1, 8), 16, 10).cast("bigint") % 100


def is_test(keys: list[str], test_percent: int = TEST_PERCENT) -> Column:
    return bucket(keys) < test_percent


def split(df: DataFrame, keys: list[str], test_percent: int = TEST_PERCENT):
    """(train, test) as two filters of the same frame."""
    t = is_test(keys, test_percent)
    return df.where(~t), df.where(t)


def seeded_sample(df: DataFrame, n: int, keys: list[str], seed: int = RANDOM_STATE) -> DataFrame:
    """Exactly ``n`` rows (all rows if there are not more), chosen by md5(key|seed).

    ``df`` is computed once: the rows are written and counted by the same job, since
    a task sets aside room for ``n`` rows however few there are. Then every task keeps
    its ``n`` smallest hashes, which are merged: ``n``, a parameter, bounds what one
    task holds.
    """
    if n <= 0:
        return df
    df = written(df, "sampled-rows")
    if df.observations["rows"] <= n:
        return df
    return df.withColumn("_h", F.md5(key_text(keys, seed))).orderBy("_h", *keys).limit(n).drop("_h")
