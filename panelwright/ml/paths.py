"""Shapley paths of a row, scored where the row is: what trees or weights give along a whole feature order at once.

Along a path, features are switched one by one from a background row to the row's own values. A tree's leaf is reached during one run of steps: each
condition on its way holds always, from the step that switches its feature on, until that step, or never. So a tree costs the nodes that
a path can reach, not a descent for each step, and no mixed row is made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

P1, P2, P3, P4, P5 = (np.uint64(v) for v in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
START = 42               # of Spark's xxhash64
NUMBERS = 1 << 18        # (row, order, feature) cells handled at a time


def _turned(v: np.ndarray, bits: int) -> np.ndarray:
    return (v << np.uint64(bits)) | (v >> np.uint64(64 - bits))


def _mixed(v: np.ndarray) -> np.ndarray:
    v = (v ^ (v >> np.uint64(33))) * P2
    v = (v ^ (v >> np.uint64(29))) * P3
    return v ^ (v >> np.uint64(32))


def hash_long(v: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """Spark's xxhash64 of a long, as unsigned numbers; ``seed`` is the hash of the columns before it."""
    with np.errstate(over="ignore"):
        h = np.asarray(seed).astype(np.uint64) + P5 + np.uint64(8)
        h = h ^ (_turned(v.astype(np.int64).view(np.uint64) * P2, 31) * P1)
        return _mixed(_turned(h, 27) * P1 + P4)


def hash_int(v: np.ndarray | int, seed: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of an int that is not negative."""
    with np.errstate(over="ignore"):
        h = seed + P5 + np.uint64(4)
        h = h ^ (np.asarray(v).astype(np.uint64) * P1)
        return _mixed(_turned(h, 23) * P2 + P3)


def ordered(h: np.ndarray, permutations: int, d: int, seed: int, n_back: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows * permutations) numbers of background rows and, per feature, the place in its order: what Spark's xxhash64(h, permutation, ...) gives."""
    perm = np.arange(1, permutations + 1)
    base = hash_int(perm[None, :], hash_long(h, START)[:, None]).ravel()
    back = np.mod(hash_int(seed, base).view(np.int64), n_back)
    order = np.argsort(hash_int(np.arange(d)[None, :], base[:, None]).view(np.int64), axis=1, kind="stable")
    place = np.empty(order.shape, np.int16 if d < 30_000 else np.int32)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(d, dtype=place.dtype), order.shape), axis=1)
    return back, place


class Trees:
    """A sum of trees over plain columns: node arrays, with the value of a leaf already weighted."""

    def __init__(self, trees: list[dict[str, np.ndarray]], link: str | None):
        self.trees, self.link = trees, link

    def steps(self, x: np.ndarray, back: np.ndarray, which: np.ndarray, place: np.ndarray) -> np.ndarray:
        """(paths, features + 1) scores: none switched up to all."""
        d = place.shape[1]
        change = np.zeros((len(which), d + 2))
        after = np.ascontiguousarray(place.T) + place.dtype.type(1)    # the first step at which a feature is switched
        each = len(which) // len(x)
        for t in self.trees:
            todo = [(0, np.arange(len(which)), np.zeros(len(which), place.dtype), np.full(len(which), d + 1, place.dtype))]
            while todo:
                node, paths, low, high = todo.pop()
                f = t["feature"][node]
                if f < 0:
                    change[paths, low] += t["value"][node]
                    change[paths, high] -= t["value"][node]
                    continue
                own, other = (x[:, f] <= t["limit"][node])[paths // each], (back[:, f] <= t["limit"][node])[which[paths]]
                at = after[f, paths]
                for child, a, b in ((t["left"][node], own, other), (t["right"][node], ~own, ~other)):
                    lo = np.where(b, low, np.maximum(low, at))
                    hi = np.where(a, high, np.minimum(high, at))
                    go = np.flatnonzero((a | b) & (lo < hi))
                    if len(go):
                        todo.append((int(child), paths[go], lo[go], hi[go]))
        total = np.cumsum(change[:, :d + 1], axis=1)
        return total if self.link is None else _chance(2.0 * total)


class Weights:
    """A logistic regression."""

    def __init__(self, weights: np.ndarray, intercept: float):
        self.weights, self.intercept = weights, intercept

    def steps(self, x: np.ndarray, back: np.ndarray, which: np.ndarray, place: np.ndarray) -> np.ndarray:
        d = place.shape[1]
        each = len(which) // len(x)
        moved = np.zeros((len(which), d + 1))
        moved[:, 0] = (back @ self.weights + self.intercept)[which]
        np.put_along_axis(moved, place.astype(int) + 1, np.repeat(x * self.weights, each, axis=0) - (back * self.weights)[which], axis=1)
        return _chance(np.cumsum(moved, axis=1))


def _chance(margin: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-margin))


def _nodes(root, value: Callable) -> dict[str, np.ndarray] | None:
    """Node arrays of one of Spark's trees; None if it holds a split of categories."""
    out: dict[str, list] = {"feature": [], "limit": [], "left": [], "right": [], "value": []}
    todo = [(root, -1, "")]
    while todo:
        node, parent, side = todo.pop()
        me = len(out["feature"])
        if parent >= 0:
            out[side][parent] = me
        leaf = node.subtreeDepth() == 0
        row = (-1, 0.0, -1, -1, value(node)) if leaf else None
        if not leaf:
            split = node.split()
            if split.getClass().getSimpleName() != "ContinuousSplit":
                return None
            row = (split.featureIndex(), split.threshold(), -1, -1, 0.0)
            todo += [(node.rightChild(), me, "right"), (node.leftChild(), me, "left")]
        for c, v in zip(out, row, strict=True):
            out[c].append(v)
    return {c: np.array(v) for c, v in out.items()}


def scorer_of(classifier) -> Trees | Weights | None:
    """The plain arrays of a two-class forest, boosted trees or logistic regression; None for anything else."""
    kind = type(classifier).__name__
    if getattr(classifier, "numClasses", None) != 2:
        return None
    if kind == "LogisticRegressionModel":
        if classifier.coefficientMatrix.numRows != 1:
            return None
        return Weights(classifier.coefficientMatrix.toArray()[0], float(classifier.interceptVector.toArray()[0]))
    if kind not in ("RandomForestClassificationModel", "GBTClassificationModel"):
        return None
    models = list(classifier._java_obj.trees())
    if kind == "RandomForestClassificationModel":
        def share(node) -> float:
            counts = list(node.impurityStats().stats())
            return counts[1] / sum(counts) / len(models) if sum(counts) else np.nan
        trees = [_nodes(m.rootNode(), share) for m in models]
    else:
        weights = list(classifier._java_obj.treeWeights())
        trees = [_nodes(m.rootNode(), lambda node, w=w: node.prediction() * w) for m, w in zip(models, weights, strict=True)]
    if any(t is None or np.isnan(t["value"]).any() for t in trees):
        return None
    return Trees(trees, "logistic" if kind == "GBTClassificationModel" else None)


def attributed(scorer: Trees | Weights, back: Sequence[Sequence[float]], d: int, permutations: int, seed: int):
    """For ``mapInArrow`` over rows (h, x): a row (f, total, n) for each feature with the sum of the absolute Shapley values of the task's rows."""
    back = np.array(back, float)

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(d), 0
        size = max(1, NUMBERS // (permutations * d))
        for batch in stream:
            h = batch.column("h").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().fill_null(0.0).to_numpy(zero_copy_only=False).reshape(len(h), d)
            for at in range(0, len(h), size):
                own = x[at:at + size]
                which, place = ordered(h[at:at + size], permutations, d, seed, len(back))
                gain = np.diff(scorer.steps(own, back, which, place), axis=1)
                phi = np.take_along_axis(gain, place.astype(int), axis=1).reshape(len(own), permutations, d).sum(axis=1) / permutations
                total += np.abs(phi).sum(axis=0)
                n += len(own)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), pa.array(total), pa.array(np.full(d, n), pa.int64())], ["f", "total", "n"])

    return run
