"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.llm.common import labelled_sample, labelled_texts, table, train_row
from panelwright.llm.words import SPLIT, Words, mix, slices

BITS = 20
MOST_FEATURES = 12_000_000   # distinct features of a class's training texts, four bytes each
PER_CLASS = 6_000        # labelled rows of each class to fit on, at most
ALPHA, BETA, L1, L2 = 1.0, 1.0, 12.0, 0.5       # chosen on training rows: rare features stay at zero
EPOCHS = 4
THRESHOLD = 0.7


def features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, row of each feature, feature) of the distinct hashed unigrams, bigrams and one-word skip-grams.

    Units are lower-cased runs of letters and digits; signs part them and are not units.
    """
    for a, e, raw, off in slices(texts):
        w = Words(raw, off, lower=True, classes=SPLIT)
        h = w.hashes()
        letters = SPLIT[raw[w.starts]] == 1 if len(w) else np.zeros(0, bool)
        h, row = h[letters], w.rows()[letters]
        parts, rows = [mix(h, 41)], [row]
        for gap, seed in ((1, 42), (2, 43)):
            same = row[gap:] == row[:-gap]
            parts.append(mix(h[:-gap] + mix(h[gap:], seed), seed)[same])
            rows.append(row[gap:][same])
        cell = np.concatenate(rows).astype(np.int64) << BITS | (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)
        cell = np.unique(cell)
        yield a, (cell >> BITS) + a, (cell & ((1 << BITS) - 1)).astype(np.int32)


def train(samples: list[np.ndarray], y: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(indices, weights, bias): per-coordinate rates, L1 leaves few coordinates. Rows in the order given, ``share`` their weights."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    zb = nb = bias = 0.0

    def weight(i):
        zi = z[i]
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for i, label, s in zip(samples, y, share, strict=True):
            w = weight(i)
            g = s * (1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - label)
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
            zb += g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / ALPHA * bias
            nb += g * g
            bias = -zb / ((BETA + np.sqrt(nb)) / ALPHA)
    used = np.flatnonzero(np.abs(z) > L1)
    w = weight(used)
    return used[w != 0], w[w != 0], float(bias)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS,
        most_features: int = MOST_FEATURES) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights from at most ``per_class`` labelled training rows of each class (their whole texts), in an order set by id hashes.

    Rows of a class beyond its first ``most_features`` features in hash order are not learnt from, so 8 x ``most_features`` bytes reach the driver at
    most. An id that several rows share counts once, with the smallest of its texts.

    Both classes weigh the same, so a score is the probability under an even prior.
    """
    chosen = labelled_sample(labels, label, per_class)

    def extract(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in texts:
            row, cell = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
            for _, r, c in features(t):
                row.append(r)
                cell.append(c)
            bound = np.searchsorted(np.concatenate(row), np.arange(len(t) + 1))
            yield pa.ListArray.from_arrays(pa.array(bound, pa.int32()), pa.array(np.concatenate(cell)))

    found = labelled_texts(docs, chosen).select("doc_id", "label", F.arrow_udf(extract, "array<int>")("text").alias("x"))
    so_far = W.partitionBy("label").orderBy(F.xxhash64("doc_id", F.lit(17)), "doc_id").rowsBetween(W.unboundedPreceding, 0)   # per_class rows
    rows = found.withColumn("_sum", F.sum(F.size("x").cast("long")).over(so_far)).where(F.col("_sum") <= most_features).drop("_sum").toArrow()
    if not rows.num_rows:
        return np.zeros(0, np.int64), np.zeros(0), 0.0
    x = rows["x"].combine_chunks()
    bound, flat = x.offsets.to_numpy(), x.values.to_numpy()
    order = np.argsort(mix(rows["doc_id"].to_numpy().astype(np.uint64), 4), kind="stable")
    y = rows["label"].to_numpy().astype(float)[order]
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    return train([flat[bound[i]:bound[i + 1]] for i in order], y, share)


def scored(spark: SparkSession, model: tuple[np.ndarray, np.ndarray, float], text: Column) -> Column:
    """Score of each whole text. A null or empty text has no features and gets the model's base rate."""
    sent = spark.sparkContext.broadcast(model)                             # sparse: at most 2^BITS entries

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        used, weights, bias = sent.value
        dense = np.zeros(1 << BITS)
        dense[used] = weights
        for t in texts:
            total = np.full(len(t), bias)
            for _, row, cell in features(t):
                total += np.bincount(row, dense[cell], minlength=len(t))
            yield pa.array(1 / (1 + np.exp(-np.clip(total, -35, 35))), pa.float64())

    return F.arrow_udf(run, "double").asNondeterministic()(text)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; predicted is 1 from ``THRESHOLD`` on.

    Labels outside 0 and 1 are not learnt from; without any label every score is 0.5. Rows are scored one by one, so repeated
    rows, null ids and further columns change nothing.
    """
    out = docs.select("doc_id", (~train_row()).alias("held_out"),
                      scored(docs.sparkSession, fit(docs, labels), F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
