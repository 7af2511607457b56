"""Quality rules: exact text statistics and robust multivariate outliers.

Whole texts give counts (words, symbols, repeated lines, repeated three-word
windows). Transformed statistics form a vector per document. Per language and
source a minimum-covariance-determinant estimate is fitted by concentration
steps: start from medians and interquartile ranges, keep the ``H`` share of
documents with the smallest distances, re-estimate mean and covariance from
them, and repeat. A document is rejected if its Mahalanobis distance to the
final estimate exceeds a chi-square quantile. Sources with few documents are
pooled by language, then over all languages; what is still few is judged by
the estimate over all documents.

Everything is grouped sums: moments and distance histograms are partially
aggregated per task, so a source with a third of all rows is one more group of
partial sums. Statistics are written once; texts are read once.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import ROW, cut, drop_cut, pack, small, unpack

WORD = r"[^\x20\x09-\x0D]+"
SPACES = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS = 50              # base rule: fewer words fail
MAX_REPEAT = 50             # base rule: percent of words in repeated windows
H = 0.75                    # share of a group that an estimate rests on
STEPS = 4                   # concentration steps
MIN_GROUP = 200             # documents below which a group is pooled
QUANTILE = 0.9999           # of the chi-square distribution, where rejection starts
RIDGE = 0.25                # added to variances, in units of the robust scale
BINS = 64                   # distance histogram bins per power of two

# Least scale of a share that is mostly zero, in its range past the base rules: with the ridge a document of a clean
# group reaches the limit at SHARE_SCALE * sqrt(limit * RIDGE), about 0.51 of the range, by this statistic alone.
SHARE_SCALE = 1 / 6
# transformed statistic and the least robust scale that a group may have in it
FEATURES = {
    "log_words": (lambda: F.log1p(F.col("n_words")), 0.8),
    "log_word_length": (lambda: F.log(F.col("word_chars") / F.greatest("n_words", F.lit(1)) + 1), 0.1),
    "symbols": (lambda: F.sqrt(F.col("n_symbols") / F.greatest("word_chars", F.lit(1))), 0.06),
    "dup_lines": (lambda: F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), SHARE_SCALE),
    "repeats": (lambda: F.col("n_repeat_words") / F.greatest("n_words", F.lit(1)),
                SHARE_SCALE * MAX_REPEAT / 100),
    "upper": (lambda: F.col("n_upper") / F.greatest("word_chars", F.lit(1)), 0.06),
}
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(rows: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and the counts of the whole ``text`` (null: empty), one row per row."""
    def without(chars: str) -> Column:
        return F.length(F.translate("t", chars, ""))

    a = rows.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("t"))
    b = a.select(*keep, "t", F.regexp_extract_all("t", F.lit(WORD), F.lit(0)).alias("w"),
                 F.filter(F.split("t", "\n", -1), lambda x: x.rlike(WORD)).alias("lines"))
    c = b.select(
        *keep, "w", F.size("w").cast("long").alias("n_words"), without(SPACES).cast("long").alias("word_chars"),
        (F.length("t") - without(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length("t") - without(UPPER)).cast("long").alias("n_upper"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    counts = ["n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines"]
    windows = F.transform(F.expr("slice(w, 1, greatest(size(w) - 2, 0))"),
                          lambda x, i: F.concat_ws(" ", x, F.get("w", i + 1), F.get("w", i + 2)))
    d = c.select(*keep, *counts, windows.alias("win"))
    repeated = F.size(F.array_distinct("win")) < F.size("win")
    e = d.select(*keep, *counts, F.when(
        repeated, F.sort_array(F.transform("win", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).alias("s"))
    f = e.select(*keep, *counts, F.sort_array(F.transform(
        F.filter("s", lambda x, k: (x.x == F.get("s", k - 1).x) | (x.x == F.get("s", k + 1).x)),
        lambda x: x.i)).alias("p"))
    covered = F.aggregate(
        F.transform("p", lambda x, k: F.coalesce(F.least(F.get("p", k + 1) - x, F.lit(3)), F.lit(3))),
        F.lit(0).cast("long"), lambda acc, x: acc + x)
    return f.select(*keep, *counts, F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))


def _chi2_cdf(x: float, df: int) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    half = x / 2
    return 1 - math.exp(-half) * sum(half ** k / math.factorial(k) for k in range(df // 2))


def _chi2_quantile(p: float, df: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2_cdf(mid, df) < p else (lo, mid)
    return (lo + hi) / 2


ALL = "all"


def _pools(stats: DataFrame) -> DataFrame:
    """Pool of every (language, source): its own, the language's, the common one of the rest or that of all documents."""
    n = stats.groupBy("g_lang", "g_source").agg(F.count("*").alias("n"))
    n = n.select("*", (F.col("n") >= MIN_GROUP).alias("own"))
    rest = n.filter("not own").groupBy("g_lang").agg(F.sum("n").alias("m"))
    left = rest.filter(F.col("m") < MIN_GROUP).agg(F.coalesce(F.sum("m"), F.lit(0)).alias("few"))
    n = n.join(rest, "g_lang", "left").crossJoin(F.broadcast(left))
    return n.select("g_lang", "g_source", F.when(F.col("own"), F.concat_ws("\x1f", F.lit("s"), "g_lang", "g_source"))
                    .when(F.col("m") >= MIN_GROUP, F.concat_ws("\x1f", F.lit("l"), "g_lang"))
                    .when(F.col("few") >= MIN_GROUP, "a").otherwise(ALL).alias("pool"))


def _distance(rows: DataFrame, params: DataFrame, p: int, keep: list[str]) -> DataFrame:
    """``keep`` and the squared Mahalanobis distance ``d`` of ``z0..`` by the pool's estimate."""
    j = rows.join(params, "pool")
    for i in range(p):
        rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"y{k}"), range(i), F.col(f"z{i}") - F.col(f"m{i}"))
        j = j.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    return j.select(*keep, reduce(lambda a, b: a + b, [F.col(f"y{i}") * F.col(f"y{i}") for i in range(p)]).alias("d"))


def _nearest(dist: DataFrame) -> DataFrame:
    """Per pool the histogram bin at which the ``H`` share of distances is reached."""
    hist = dist.groupBy("pool", _bin().alias("bin")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("pool")
    cum = hist.select("pool", "bin", F.sum("n").over(w.orderBy("bin")).alias("c"), F.sum("n").over(w).alias("all"))
    return cum.filter(F.col("c") >= F.lit(H) * F.col("all")).groupBy("pool").agg(F.min("bin").alias("upto"))


def _bin() -> Column:
    return F.floor(F.log2(F.col("d") + 2.0 ** -10) * BINS).cast("int")


def _estimate(rows: DataFrame, p: int) -> DataFrame:
    """Mean and Cholesky factor of the covariance of ``rows`` per pool."""
    aggs = [F.avg(f"z{i}").alias(f"m{i}") for i in range(p)]
    aggs += [F.avg(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"q{i}{j}") for i in range(p) for j in range(i + 1)]
    q = rows.groupBy("pool").agg(*aggs)
    q = q.select("pool", *[F.round(f"m{i}", 6).alias(f"m{i}") for i in range(p)], *[
        (F.round(F.col(f"q{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}"), 6) + (RIDGE if i == j else 0.0)).alias(f"c{i}{j}")
        for i in range(p) for j in range(i + 1)])
    for j in range(p):
        q = q.withColumn(f"l{j}{j}", F.sqrt(F.greatest(reduce(
            lambda a, k: a - F.col(f"l{j}{k}") * F.col(f"l{j}{k}"), range(j), F.col(f"c{j}{j}")), F.lit(1e-6))))
        q = q.withColumns({f"l{i}{j}": reduce(
            lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), F.col(f"c{i}{j}")) / F.col(f"l{j}{j}")
            for i in range(j + 1, p)})
    return q.select("pool", *[f"m{i}" for i in range(p)], *[f"l{i}{j}" for i in range(p) for j in range(i + 1)])


def verdicts(stats: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, ``base_failed``, ``distance`` and ``kept`` of a written statistics table.

    ``stats`` has ``g_lang``, ``g_source`` and the counts. Documents that fail
    a base rule take no part in the estimates and have a null distance.
    """
    names, p = list(FEATURES), len(FEATURES)
    pools = small(cut(_pools(stats.filter(~base_failed())), "rules-pools"))
    x = stats.filter(~base_failed()).join(pools, ["g_lang", "g_source"]).select(
        "pool", *[f().alias(f"x{i}") for i, (f, _) in enumerate(FEATURES.values())])
    if not pools.filter(F.col("pool") == ALL).isEmpty():
        # every document takes part in this estimate, also those of other pools
        x = x.filter(F.col("pool") != ALL).unionByName(x.withColumn("pool", F.lit(ALL)))
    start = cut(x.groupBy("pool").agg(F.count("*").alias("size"), *[
        F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 10000).alias(f"r{i}") for i in range(p)]).select(
        "pool", "size", *[F.col(f"r{i}")[1].alias(f"a{i}") for i in range(p)],
        *[F.greatest((F.col(f"r{i}")[2] - F.col(f"r{i}")[0]) / 1.349, F.lit(FEATURES[names[i]][1])).alias(f"s{i}")
          for i in range(p)]), "rules-start")
    z = cut(x.join(small(start), "pool").select(
        "pool", *[((F.col(f"x{i}") - F.col(f"a{i}")) / F.col(f"s{i}")).alias(f"z{i}") for i in range(p)]), "rules-z")
    zs = [f"z{i}" for i in range(p)]
    dist = z.select("pool", *zs, reduce(lambda a, b: a + b, [F.col(c) * F.col(c) for c in zs]).alias("d"))
    params = None
    for _ in range(STEPS):
        near = cut(_nearest(dist), "rules-near")
        core = dist.join(small(near), "pool").filter(_bin() <= F.col("upto"))
        old, params = params, cut(_estimate(core, p), "rules-estimate")
        drop_cut(near)
        if old is not None:
            drop_cut(old)
        dist = _distance(z, small(params), p, ["pool", *zs])
    drop_cut(z)
    shrink = H / _chi2_cdf(_chi2_quantile(H, p), p + 2)     # the core's covariance is too small by this
    limit = _chi2_quantile(QUANTILE, p) * shrink
    fit = params.join(start, "pool")
    fit = cut(pools.join(fit, "pool").drop("pool", "size"), "rules-fit")
    j = stats.join(small(fit), ["g_lang", "g_source"], "left")
    j = j.select("*", *[((f() - F.col(f"a{i}")) / F.col(f"s{i}")).alias(f"z{i}") for i, (f, _) in
                        enumerate(FEATURES.values())])
    for i in range(p):
        rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"y{k}"), range(i), F.col(f"z{i}") - F.col(f"m{i}"))
        j = j.withColumn(f"y{i}", rest / F.col(f"l{i}{i}"))
    d = reduce(lambda a, b: a + b, [F.col(f"y{i}") * F.col(f"y{i}") for i in range(p)])
    return j.select(*keep, base_failed().alias("base_failed"),
                    F.when(~base_failed(), d / shrink).alias("distance"),
                    (~base_failed() & (F.coalesce(d, F.lit(0.0)) <= limit)).alias("kept"))


def _stats_table(docs: DataFrame, first: list[Column], keep: list[str], text: str, lang: str, source: str) -> DataFrame:
    rows = docs.select(*first, F.col(f"`{text}`").alias("__text"),
                       F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("")).alias("g_lang"),
                       F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("g_source"))
    return cut(statistics(rows, "__text", [*keep, "g_lang", "g_source"]), "rules-stats")


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          source: str = "source") -> DataFrame:
    """Per row: doc_id, the base counts, base_failed, kept and distance.

    Null texts are empty (no words, so the base rule fails); null languages and
    sources count as the empty name. Repeated rows and null ids keep their rows
    and their weight. An empty table gives no rows. Other columns are not read.
    """
    stats = _stats_table(docs, [F.col(f"`{doc_id}`").alias("doc_id")], ["doc_id"], text, lang, source)
    return verdicts(stats, ["doc_id", *STATS]).select("doc_id", *STATS, "base_failed", "kept", "distance")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    stats = _stats_table(docs, [pack(docs)], [ROW], text, lang, source)
    return unpack(verdicts(stats, [ROW]).filter("kept"), docs.columns)
