"""Toxicity scores: a linear classifier on character n-grams, each feature scaled by
its naive Bayes log-count ratio.

The ratios and the weights are fitted on a bounded sample of labelled rows (the rows
of the smallest hashes, at most ``fit_rows``): counts of n-gram buckets by class in
Spark, the buckets that tell the classes apart best as features, and a regularised
logistic regression on scaled presences. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.context import materialise
from starloom.llm.arrow import flat_map_rows, in_batches, map_rows, slices
from starloom.llm.bounded import hash_sample

#: Labelled rows that the classifier is fitted on at most.
FIT_ROWS = 20_000
SIZES = (3, 5)
BUCKET_BITS = 18
FEATURES = 1_024
#: Documents a bucket must occur in to be a feature.
LEAST_DOCS = 8
RIDGE = 2.0
STEPS = 250

_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def buckets(data: bytes | None) -> np.ndarray:
    """Hash buckets of the n-grams of a text (words joined by one space; A-Z
    lower-cased), with repeats."""
    raw = np.frombuffer(b" " + b" ".join((data or b"").translate(_NORMAL).split()) + b" ", np.uint8).astype(np.uint64)
    out = []
    for size in SIZES:
        if len(raw) >= size:
            n = len(raw) - size + 1
            code = raw[:n] + np.uint64(size << 56)
            for j in range(1, size):
                code += raw[j : j + n] << np.uint64(8 * j)
            out.append((code * _MIX) >> np.uint64(64 - BUCKET_BITS))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def held_out(key: str = "doc_id"):
    """Rows that labels are never learned from: crc32 of the id as text, modulo 5.
    A null id has no label; it is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    """Weights by bucket (zero: no feature), log-count ratio included."""

    weights: np.ndarray
    bias: float

    def score(self, data: bytes | None) -> float:
        at = buckets(data)
        at = np.unique(at[self.weights[at] != 0])
        return float(1 / (1 + np.exp(-(self.bias + self.weights[at].sum()))))


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, fit_rows: int) -> DataFrame:
    known = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
        .filter(F.col("key").isNotNull() & F.col("label").isin(0, 1) & ~held_out("key"))
        .groupBy("key")
        .agg(F.max("label").alias("label"))
    )
    chosen = hash_sample(known, "key", fit_rows, known.count())
    few = docs.sparkSession.createDataFrame(chosen.collect(), chosen.schema)  # at most fit_rows pairs of numbers
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("data"))
    return narrow.join(F.broadcast(few), "key")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    fit_rows: int = FIT_ROWS,
) -> Model:
    """Fits on labelled rows that are not held out. Null labels and ids are left
    out; of several labels for one id the highest counts. Without any labelled row
    the score is 0 everywhere, with one class only it is the smoothed share of it."""
    # read and joined by all tasks once; what follows reads the few rows kept
    sample = materialise(_sample(docs, labels, key, text, label, fit_rows).select("label", "data"), "sample")

    def counts(batches):
        seen = np.zeros((2, 1 << BUCKET_BITS), np.int32)
        rows = np.zeros(2, np.int64)
        for part in slices(batches):
            for y, data in zip(*(c.to_pylist() for c in part.columns)):
                seen[y, np.unique(buckets(data))] += 1
                rows[y] += 1
        at = np.flatnonzero(seen.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1)), pa.array(np.append(seen[0, at], rows[0])), pa.array(np.append(seen[1, at], rows[1]))],
            names=["bucket", "n0", "n1"],
        )

    # few, larger tasks: a task's counts hold most buckets however few its texts
    lots = sample.coalesce(max(1, docs.sparkSession.sparkContext.defaultParallelism))
    counted = in_batches(lots, counts, "bucket bigint, n0 bigint, n1 bigint").groupBy("bucket")
    table = counted.agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas()  # at most one row for each of the fixed number of buckets
    totals = table[table.bucket == -1]
    rows0, rows1 = (int(totals.n0.sum()), int(totals.n1.sum()))
    weights = np.zeros(1 << BUCKET_BITS)
    if not rows0 or not rows1:
        share = (rows1 + 0.5) / (rows0 + rows1 + 1) if rows0 + rows1 else 0.0
        return Model(weights, float(np.log(share / (1 - share))) if share else -np.inf)
    table = table[(table.bucket >= 0) & (table.n0 + table.n1 >= LEAST_DOCS)].sort_values("bucket")
    p, q = (table.n1 + 1) / (rows1 + 2), (table.n0 + 1) / (rows0 + 2)
    pooled = (table.n0 + table.n1 + 2) / (rows0 + rows1 + 4)
    apart = (p - q) / np.sqrt(pooled * (1 - pooled) * (1 / rows0 + 1 / rows1) + 1e-12)
    best = apart.abs().sort_values(ascending=False, kind="stable").index[:FEATURES]
    chosen, ratio = table.bucket[best].to_numpy(), np.log(p / q)[best].to_numpy()
    number = np.full(1 << BUCKET_BITS, -1, np.int32)
    number[chosen] = np.arange(len(chosen))
    sent = docs.sparkSession.sparkContext.broadcast(number)

    def setup():
        def each(y, data):
            at = sent.value[buckets(data)]
            yield y, np.unique(at[at >= 0]).tolist()

        return each

    found = flat_map_rows(sample, setup, "label int, found array<int>").toPandas()  # at most fit_rows rows
    sent.destroy()
    found["first"] = [zlib.crc32(np.asarray(at, np.int32).tobytes()) for at in found.found]
    found = found.sort_values(["first", "label"])  # rows come in no fixed order
    x = np.zeros((len(found), len(chosen) + 1), np.float32)
    for i, at in enumerate(found.found):
        x[i, at] = ratio[at]
    x[:, -1] = 1
    w = _regress(x, found.label.to_numpy(np.float32))
    weights[chosen] = ratio * w[:-1]
    return Model(weights, float(w[-1]))


def _regress(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by accelerated gradient steps."""
    penalty = np.full(x.shape[1], RIDGE, np.float32)
    penalty[-1] = 0
    v = np.ones(x.shape[1], np.float32)
    for _ in range(12):  # the largest curvature, for the step length
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v)
    step = 1 / (0.25 * np.linalg.norm(x.T @ (x @ v)) + RIDGE)
    w = np.zeros(x.shape[1], np.float32)
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    ahead, t = w.copy(), 1.0
    for _ in range(STEPS):
        slope = x.T @ (1 / (1 + np.exp(-(x @ ahead))) - y) + penalty * ahead
        new, later = ahead - step * slope, (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / later * (new - w), new, later
    return w.astype(np.float64)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``score`` (0 to 1) of each row.

    A null or empty text has the score of a text without features; a null key
    stays null; repeated rows each give a row; other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("data"))

    def setup():
        return lambda k, data: (k, sent.value.score(data))

    ddl = f"key {narrow.schema['key'].dataType.simpleString()}, score double"
    return map_rows(narrow, setup, ddl).withColumnRenamed("key", key)


def keep_clean(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows, with all their columns, that score under ``threshold``. A null or
    empty text scores as one without features; repeated rows fare alike."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([sent.value.score(data) for data in texts], dtype="float64")

    return docs.filter(scored(F.col(text).cast("binary")) < threshold)
