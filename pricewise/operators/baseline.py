"""Baseline predictors with exact SQL equivalents.

* group baseline: mean price per (make, body) — a model whose predictions an
  independent SQL engine can reproduce exactly, so the whole pricing chain
  has an oracle.
* median baseline: the median of the training target for every row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewise.config import TARGET_COLUMN
from pricewise.operators.dims import broadcast_ok, checked_broadcast, written
from pricewise.operators.median import grouped_median


@dataclass
class GroupBaseline:
    """Fitted mean-by-group predictor: a small table plus a global fallback
    (the overall mean, a single scalar fixed at fit time) for unseen groups."""

    table: DataFrame          # keys..., prediction, n
    keys: list[str]
    fallback: float | None

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        t = self.table.select(*self.keys, F.col("prediction").alias("_pred"))
        j = df.join(t, self.keys, "left")
        return j.withColumn(out, F.coalesce(F.col("_pred"), F.lit(self.fallback).cast("double"))) \
            .drop("_pred")


def fit_group_baseline(train: DataFrame, keys=("make", "body"), target: str = TARGET_COLUMN,
                       broadcast_check: bool = True) -> GroupBaseline:
    keys = list(keys)
    table = train.groupBy(*keys).agg(F.sum(F.col(target).cast("decimal(18,2)")).alias("_sum"),
                                     F.count(F.lit(1)).alias("n"))
    table = table.withColumn("prediction", F.col("_sum").cast("double") / F.col("n"))
    # overall mean from the exact group sums, added up by the job that writes the table
    sums = dict(s=F.sum("_sum").cast("double"), n=F.sum("n"))
    table = checked_broadcast(table, **sums) if broadcast_check else written(table, "baseline", **sums)
    tot = table.observations
    fallback = tot["s"] / tot["n"] if tot["n"] else None
    out = table.drop("_sum")
    return GroupBaseline(F.broadcast(out) if broadcast_ok(table) else out, keys, fallback)


def scalar_median(df: DataFrame, value: str, out: str = "median",
                  partitions: int | None = None) -> DataFrame:
    """One-row median of a column; the values are spread over all tasks."""
    g = df.select(F.lit(0).alias("_g"), value)
    return grouped_median(g, ["_g"], value, out=out, count_col="_n", partitions=partitions).select(out)


def median_baseline(train: DataFrame, test: DataFrame, target: str = TARGET_COLUMN,
                    out: str = "prediction") -> DataFrame:
    """Every test row gets the median of the training target (a fitted scalar)."""
    med = scalar_median(train, target, "_m").first()
    return test.withColumn(out, F.lit(med["_m"] if med else None).cast("double"))


def fold_of(keys: list[str], folds: int):
    """Fold 0 .. ``folds`` - 1 of a row, by its key alone."""
    from pricewise.operators.split import key_text
    return F.conv(F.substring(F.md5(F.concat_ws("|", key_text(keys), F.lit("fold"))), 1, 8), 16, 10).cast("bigint") % folds


@dataclass
class OutOfFold:
    """One model per fold, fitted on all other folds; each row is scored by the one that never saw it."""

    models: list
    keys: list[str]

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` read once: every model adds its score, the row's own fold picks one."""
        names, k = [c for c in df.columns if c != out], len(self.models)
        scored = df.select(*names, fold_of(self.keys, k).alias("_fold"))
        for i, m in enumerate(self.models):
            scored = m.transform(scored, out=f"_fold_{i}")
        pick = F.element_at(F.array(*[F.col(f"_fold_{i}") for i in range(k)]), (F.col("_fold") + 1).cast("int"))
        return scored.select(*names, pick.alias(out))


def fit_out_of_fold(frame: DataFrame, fit, keys: list[str], folds: int = 5) -> OutOfFold:
    """``fit`` is called with the rows outside each fold and returns a model with ``transform(df, out)``."""
    marked = frame.withColumn("_fold", fold_of(keys, folds))
    return OutOfFold([fit(marked.where(F.col("_fold") != i).drop("_fold")) for i in range(folds)], keys)


def fit_group_baselines(frame: DataFrame, fold_keys: list[str], folds: int = 5, keys=("make", "body"),
                        target: str = TARGET_COLUMN) -> OutOfFold:
    """Group baselines of all folds from one pass: sums per fold and group, less the fold's own."""
    keys = list(keys)
    per = frame.withColumn("_fold", fold_of(fold_keys, folds)).groupBy("_fold", *keys).agg(
        F.sum(F.col(target).cast("decimal(18,2)")).alias("_sum"), F.count(F.lit(1)).alias("n"))
    grid = written(per, "fold-sums", s=F.sum("_sum"), n=F.sum("n"))     # a row per fold and group
    total = grid.groupBy(*keys).agg(F.sum("_sum").alias("_all"), F.sum("n").alias("_n"))
    own = {r["_fold"]: r for r in grid.groupBy("_fold").agg(F.sum("_sum").alias("s"), F.sum("n").alias("n")).collect()}
    seen, models = grid.observations, []
    for i in range(folds):
        part = grid.where(F.col("_fold") == i).select(*keys, F.col("_sum").alias("_own"), F.col("n").alias("_own_n"))
        rest = total.join(part, keys, "left").select(
            *keys, (F.col("_all") - F.coalesce("_own", F.lit(0))).cast("double").alias("_s"),
            (F.col("_n") - F.coalesce("_own_n", F.lit(0))).alias("n")).where("n > 0")
        table = checked_broadcast(rest.select(*keys, (F.col("_s") / F.col("n")).alias("prediction"), "n"))
        s = (seen["s"] or 0) - (own[i]["s"] if i in own else 0)
        n = (seen["n"] or 0) - (own[i]["n"] if i in own else 0)
        models.append(GroupBaseline(table, keys, float(s) / n if n else None))
    return OutOfFold(models, fold_keys)
