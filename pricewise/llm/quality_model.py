"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; unlabelled web text is every
document of the training folds, labels unseen. The class prior is the share of
good labels among the labelled training rows. With the logistic loss the
unbiased risk is ``prior E_P[l(f)] + (E_U[l(-f)] - prior E_P[l(-f)])``; its
second part estimates a risk and must not be negative. Newton steps on the
risk are halved while the non-negative risk ``prior E_P[l(f)] + max(0, ...)``
does not fall, so a fit stops where the second part would turn negative.

Feature vectors (character classes, word and line statistics of the whole
text) are computed once and written. Each Newton step is one pass over all
training vectors: tasks return sums, which are added in two levels; nothing is
sampled and the driver sees a few sums of fixed size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import cut, small_batches, text_bytes

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
STEPS = 12                  # Newton steps at most
L2 = 0.01                   # the least log loss of five values, cross-validated on the training folds (README)
BLOBS = 16                  # partial sums that reach the driver

_CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n",
            b".,;:", b"!?", b"#*$%&", b"|<>", b"\"'()[]{}-_/\\@+=~^`")
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)
_CLASS_OF[128:] = len(_CLASSES) + 1
for _i, _c in enumerate(_CLASSES):
    _CLASS_OF[list(_c)] = _i
N_CLASSES = len(_CLASSES) + 2


def features(data: bytes | None) -> np.ndarray:
    """Feature vector of one whole text; the last entry is the constant one."""
    data = data or b""
    n = len(data)
    counts = np.zeros(N_CLASSES, np.int64)
    for at in range(0, n, 1 << 20):
        counts += np.bincount(_CLASS_OF[np.frombuffer(data[at:at + (1 << 20)], np.uint8)], minlength=N_CLASSES)
    words, lines = data.split(), [ln for ln in data.split(b"\n") if ln.strip()]
    nw, nl = len(words), len(lines)
    share = counts / max(n, 1)
    letters = counts[0] + counts[1] + counts[N_CLASSES - 1]
    unique = len(set(words)) / nw if nw else 0.0
    again = sum(map(bytes.__eq__, words, words[1:])) / nw if nw else 0.0
    starts = sum(1 for w in words if 65 <= w[0] <= 90) / nw if nw else 0.0
    symbol_words = sum(1 for w in words if w[-1] in b"#*$%&|<>!") / nw if nw else 0.0
    own = np.array([
        np.log1p(nw), np.log1p(n), (n - counts[3] - counts[4]) / nw if nw else 0.0, unique, unique * np.log1p(nw),
        again, np.sqrt(again), starts, symbol_words, np.sqrt(symbol_words),
        counts[1] / max(letters, 1), np.sqrt(counts[1] / max(letters, 1)),
        1 - len(set(lines)) / nl if nl else 0.0, np.log1p(nl), np.log1p(nw / nl) if nl else 0.0,
        float(nw == 0), float(nw < 50), 1.0])
    return np.concatenate([share, np.sqrt(share[5:10]), own])


WIDTH = N_CLASSES + 5 + 18


def feature_table(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``x`` (the feature vector) per row."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_bytes(text).alias("b"))
    schema = T.StructType([src.schema[0], T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in batches:
            x = [features(v.as_py()) for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), _rows(x)], names=["doc_id", "x"])

    return src.mapInArrow(run, schema)


def _rows(x: list[np.ndarray]) -> pa.Array:
    flat = pa.array(np.concatenate(x) if x else np.zeros(0))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * WIDTH), flat)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)


def _summed(rows: DataFrame, add, size: int) -> np.ndarray:
    """The sum over all rows of what ``add`` makes of a batch."""
    def first(batches):
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += add(b)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    def second(batches):
        total = np.zeros(size)
        for b in batches:
            for v in b.column(0):
                total += np.frombuffer(v.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])

    parts = rows.mapInArrow(first, "s binary").repartition(BLOBS).mapInArrow(second, "s binary").collect()
    return np.sum([np.frombuffer(r.s) for r in parts], axis=0) if parts else np.zeros(size)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


class Model:
    """Affine score on standardised features."""

    def __init__(self, weights: np.ndarray, mean: np.ndarray, scale: np.ndarray, prior: float):
        self.weights, self.mean, self.scale, self.prior = weights, mean, scale, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(train: DataFrame) -> Model:
    """Fit on ``x`` and ``quality`` (null where unlabelled); every row is read.

    Without positives, or without any row, the model is the constant prior
    (0.5 with no label at all).
    """
    w = WIDTH

    def moments(b):
        x = _matrix(b.column(0))
        return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])

    m = _summed(train.select("x"), moments, 1 + 2 * w)
    n = max(m[0], 1.0)
    mean = m[1:1 + w] / n
    scale = np.sqrt(np.maximum(m[1 + w:] / n - mean ** 2, 0))
    scale[scale < 1e-9] = 1.0
    mean[-1], scale[-1] = 0.0, 1.0
    labelled = {r["quality"]: r["n"] for r in
                train.filter("quality is not null").groupBy("quality").agg(F.count("*").alias("n")).collect()}
    good, bad = labelled.get(1, 0), labelled.get(0, 0)
    prior = (good + 1) / (good + bad + 2)
    if not good:
        bias = np.zeros(w)
        bias[-1] = np.log(prior / (1 - prior))
        return Model(bias, mean, scale, prior)

    def sums(weights):
        def add(b):
            x = np.clip((_matrix(b.column(0)) - mean) / scale, -8, 8)
            pos = b.column(1).to_numpy(zero_copy_only=False) == 1
            f = x @ weights
            s = 1 / (1 + np.exp(-np.clip(f, -500, 500)))
            p = x[pos]
            return np.concatenate([
                [len(x), _softplus(f).sum(), pos.sum(), _softplus(-f[pos]).sum(), _softplus(f[pos]).sum()],
                x.T @ s, p.sum(0), ((x * (s * (1 - s))[:, None]).T @ x).ravel()])

        t = _summed(train.select("x", F.coalesce("quality", F.lit(-1)).alias("q")), add, 5 + 2 * w + w * w)
        nu, np_ = t[0], t[2]
        positive, negative = prior * t[3] / np_, t[1] / nu - prior * t[4] / np_
        grad = t[5:5 + w] / nu - prior * t[5 + w:5 + 2 * w] / np_ + L2 * weights
        hess = t[5 + 2 * w:].reshape(w, w) / nu + L2 * np.eye(w)
        return positive + max(0.0, negative) + L2 / 2 * weights @ weights, grad, hess

    weights = np.zeros(w)
    risk, grad, hess = sums(weights)
    step = 1.0
    for _ in range(STEPS):
        trial = weights - step * np.linalg.solve(hess, grad)
        new = sums(trial)
        if new[0] < risk - 1e-7:
            weights, (risk, grad, hess), step = trial, new, min(1.0, 2 * step)
        elif step > 0.05 and new[0] > risk + 1e-7:
            step /= 2
        else:
            break
    return Model(weights, mean, scale, prior)


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
             quality: str = "quality") -> DataFrame:
    """Per row: doc_id, held_out, score, predicted.

    A row is held out if crc32 of its id as text leaves ``HELD_OUT`` modulo
    ``FOLDS``; such rows and their labels take no part in the fit. Ids with
    several labels count as good if any says so. Null and empty texts have the
    features of an empty text. Null ids have no label and are not held out.
    Repeated rows keep their rows. Labels, language, source and id are not
    features; other columns are not read.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    x = cut(feature_table(docs, doc_id, text), "quality-features")
    known = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{quality}`").alias("quality")) \
        .filter("doc_id is not null and quality is not null").filter(fold != HELD_OUT) \
        .groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    held = F.coalesce(fold == HELD_OUT, F.lit(False))
    train = cut(x.filter(~held).join(known, "doc_id", "left").select("x", "quality"), "quality-train")
    model = docs.sparkSession.sparkContext.broadcast(fit(train))
    src = x.select("doc_id", held.alias("held_out"), "x")
    schema = T.StructType([*src.schema.fields[:2], T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])

    def run(batches):
        for b in batches:
            s = model.value.score(_matrix(b.column(2)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"])

    return src.mapInArrow(run, schema)
