"""Quality classifier: random-indexing word vectors pooled per document, a two-layer network, a calibrated temperature."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm.common import labelled_sample, labelled_texts, table, train_row, whole_rows
from panelwright.llm.words import SPLIT, Words, mix, slices

BUCKETS = 1 << 14        # units (runs of letters and digits, or of signs) share this many hashed vectors
DIM = 48
NONZERO = 6              # of an index vector: so many +1 or -1
SLICE = 1 << 18          # bytes of text whose vectors are held at once: some 50,000 units of DIM numbers, a few times
SPAN = 2                 # neighbours on either side
PER_CLASS = 12_000       # labelled rows of each class to fit the network on, at most
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 30, 128, 2e-3, 1e-4
HELD_FOR_TEMPERATURE = 5                              # one in so many sample rows
INPUTS = 3 * DIM + 2


def index_vectors() -> np.ndarray:
    """The fixed sparse ternary vector of each bucket; one more row of zeros for places outside a text."""
    out = np.zeros((BUCKETS + 1, DIM), np.float32)
    b = np.arange(BUCKETS, dtype=np.uint64)
    for k in range(NONZERO):
        h = mix(b * np.uint64(NONZERO) + np.uint64(k), 31)
        out[b.astype(int), ((h >> np.uint64(8)) % np.uint64(DIM)).astype(int)] += np.where(h & np.uint64(1), 1.0, -1.0)
    return out


def _buckets(w: Words) -> np.ndarray:
    return (w.hashes() >> np.uint64(40)).astype(np.int64) % BUCKETS


def _contexts(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the neighbours' index vectors per bucket over a whole partition: (bucket, n, c0..). Integers, so exact."""
    index = index_vectors()
    total = np.zeros((BUCKETS, DIM), np.int64)
    count = np.zeros(BUCKETS, np.int64)
    for batch in stream:
        for _, _, raw, off in slices(batch.column("text"), SLICE):
            w = Words(raw, off, classes=SPLIT)
            if not len(w):
                continue
            b = _buckets(w)
            room = np.full(len(b) + SPAN * (len(off) + 1), BUCKETS)             # SPAN empty places around each text
            at = np.arange(len(b)) + SPAN * (w.rows() + 1)
            room[at] = b
            near = sum(index[room[at + d]] for d in range(-SPAN, SPAN + 1) if d)
            order = np.argsort(b, kind="stable")
            cut = np.append(0, np.flatnonzero(np.diff(b[order])) + 1)
            total[b[order[cut]]] += np.add.reduceat(near[order], cut, axis=0).astype(np.int64)
            count += np.bincount(b, minlength=BUCKETS)
    used = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array(count[used]), *[pa.array(total[used, j]) for j in range(DIM)]],
        ["bucket", "n", *[f"c{j}" for j in range(DIM)]])


def word_vectors(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, weights) per bucket from all documents: unit-length centred context vectors, and a/(a + frequency).

    Each task sums its documents locally and Spark adds the at most BUCKETS rows of each; the result has a fixed size.
    """
    schema = ", ".join(["bucket int", "n long", *[f"c{j} long" for j in range(DIM)]])
    sums = docs.select("text").mapInArrow(_contexts, schema).groupBy("bucket").agg(
        F.sum("n").alias("n"), *[F.sum(f"c{j}").alias(f"c{j}") for j in range(DIM)]).toArrow()
    vectors, weights = np.zeros((BUCKETS, DIM), np.float32), np.ones(BUCKETS, np.float32)
    if sums.num_rows:
        b, n = sums["bucket"].to_numpy(), sums["n"].to_numpy().astype(float)
        c = np.stack([sums[f"c{j}"].to_numpy() for j in range(DIM)], axis=1).astype(float)
        v = c / n[:, None] - c.sum(0) / n.sum()
        vectors[b] = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
        weights[b] = 1e-3 / (1e-3 + n / n.sum())
    return vectors, weights


def _pool(texts: pa.Array, vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per text: weighted mean, spread and plain mean of its vectors, log length, share of units equal to an earlier neighbour."""
    out = np.zeros((len(texts), INPUTS), np.float32)
    for a, e, raw, off in slices(texts, SLICE):
        w = Words(raw, off, classes=SPLIT)
        n = w.counts()
        has = np.flatnonzero(n)
        if not len(has):
            continue
        b = _buckets(w)
        first = w.first[has]                                                # non-empty rows only: reduceat needs it
        v, g = vectors[b], weights[b][:, None]
        total = np.add.reduceat(g, first)
        mean = np.add.reduceat(v * g, first) / total
        spread = np.sqrt(np.maximum(np.add.reduceat(v * v * g, first) / total - mean ** 2, 0))
        again = np.zeros(len(b), np.float32)
        for d in (1, 2):
            again[d:] = np.maximum(again[d:], b[d:] == b[:-d])
        out[a + has] = np.concatenate([mean, spread, np.add.reduceat(v, first) / n[has, None], np.log1p(n[has, None]),
                                       np.add.reduceat(again, first)[:, None] / n[has, None]], axis=1)
    return out


@dataclass
class Model:
    vectors: np.ndarray
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, texts: pa.Array) -> np.ndarray:
        z = self.logits(_pool(texts, self.vectors, self.weights)) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def fit_network(x: np.ndarray, y: np.ndarray, share: np.ndarray, vectors: np.ndarray, weights: np.ndarray) -> Model:
    """Adam on the sample but one in ``HELD_FOR_TEMPERATURE``, which then sets the temperature. ``share``: weight of each row."""
    held = np.arange(len(y)) % HELD_FOR_TEMPERATURE == 0
    if len(y) < 50:
        held[:] = False
    centre, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(INPUTS), np.ones(INPUTS))
    rng = np.random.default_rng(5)
    params = [rng.normal(0, INPUTS ** -0.5, (INPUTS, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -0.5, HIDDEN), np.zeros(1)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    tx, ty, ts = ((x - centre) / scale)[~held], y[~held], share[~held]
    step = 0
    for _ in range(EPOCHS if len(ty) else 0):
        order = rng.permutation(len(ty))
        for at in range(0, len(order), BATCH):
            i = order[at:at + BATCH]
            hidden = np.tanh(tx[i] @ params[0] + params[1])
            z = hidden @ params[2] + params[3]
            d = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - ty[i]) * ts[i] / ts[i].sum()
            back = np.outer(d, params[2]) * (1 - hidden ** 2)
            grads = [tx[i].T @ back + DECAY * params[0], back.sum(0), hidden.T @ d + DECAY * params[2], np.array([d.sum()])]
            step += 1
            for p, g, (m, v) in zip(params, grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    model = Model(vectors, weights, centre, scale, *params[:3], float(params[3][0]), 1.0)
    if held.any():
        z = model.logits(x[held])
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        model.temperature = float(min(grid, key=lambda t: _loss(z / t, y[held])))
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Vectors from all of ``docs``; the network from at most ``per_class`` labelled training rows of each class.

    A sampled class is weighted back to its share of the training labels. Without labelled rows every score is 0.5.
    """
    spark = docs.sparkSession
    vectors, weights = word_vectors(docs)
    sent = spark.sparkContext.broadcast((vectors, weights))                # BUCKETS x DIM floats: 3 MB
    chosen = labelled_sample(labels, label, per_class)

    def pooled(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in texts:
            yield pa.array(list(_pool(t, *sent.value)), pa.list_(pa.float32()))

    sizes = {r["label"]: r["count"] for r in labels.where(train_row()).select(F.col(label).alias("label")).groupBy("label").count().collect()}
    rows = (labelled_texts(docs, chosen).select("doc_id", "label", F.arrow_udf(pooled, "array<float>")("text").alias("x")).toArrow())        # INPUTS numbers for at most 2 x per_class ids
    sent.unpersist()
    order = np.lexsort((mix(rows["doc_id"].to_numpy().astype(np.uint64), 3),))
    x = np.array(rows["x"].combine_chunks().flatten().to_numpy(), float).reshape(-1, INPUTS)[order] if rows.num_rows else np.zeros((0, INPUTS))
    y = rows["label"].to_numpy().astype(float)[order] if rows.num_rows else np.zeros(0)
    share = np.where(y == 1, sizes.get(1, 0) / max(1, (y == 1).sum()), sizes.get(0, 0) / max(1, (y == 0).sum()))
    return fit_network(x, y, share, vectors, weights)


def scored(spark: SparkSession, model: Model, text: Column) -> Column:
    """Score of each text. Null and empty texts have no units; they get the score of a text without any, 0 to 1 like others."""
    sent = spark.sparkContext.broadcast(model)

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for t in texts:
            yield pa.array(sent.value.scores(t), pa.float64())

    return F.arrow_udf(run, "double").asNondeterministic()(text)


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; predicted is 1 from 0.5 on.

    Labels outside 0 and 1, null labels and labels of unknown documents are not learnt from. Rows are scored one by one, so
    repeated rows, null ids and further columns change nothing.
    """
    model = fit(docs, labels)
    out = docs.select("doc_id", (~train_row()).alias("held_out"), scored(docs.sparkSession, model, F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` predicted to be of good quality, with all their columns.

    Null and empty texts get the score of a text without words. Rows are scored one by one: repeated rows stay or go together, null ids change
    nothing, columns of any other name are kept as they are. An empty table stays empty; without labels all rows stay.
    """
    model = fit(docs, labels)
    return whole_rows(docs, scored(docs.sparkSession, model, F.col("text"))).where("_value >= 0.5").select("_row.*")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
