"""Second moments of many columns at once: the Gram matrix of a table by column blocks, and what follows from it.

Each task adds up products of column blocks for its rows, with the sums over the rows in which both cells hold a number, so that every
pair of columns is complete on its own. The partial blocks are summed in two levels. The plan has the same size for five columns and for
five hundred, and the driver sees nothing but results.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.rules import number

BLOCK = 256              # columns of a block: its six matrices take 3 MB
FAN_IN = 32              # partial matrices that one task of the first level adds up
SHIFT_ROWS = 1_000       # rows that give the shift; any shift gives the same moments, a near one gives them exactly


def cells_of(cols: Sequence[str]) -> Column:
    """The columns as one array of numbers; NaN and NULL are missing."""
    return F.array(*[number(c) for c in cols])


def shifts(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """A number near the middle of each column, from a few rows."""
    rows = df.select(cells_of(cols).alias("x")).limit(SHIFT_ROWS).collect()
    if not rows:
        return np.zeros(len(cols))
    x = np.array([r["x"] for r in rows], float)
    known = ~np.isnan(x)
    return np.where(known, x, 0.0).sum(axis=0) / np.maximum(known.sum(axis=0), 1)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of equal-sized lists as rows of numbers; null is NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def _partials(width: int, shift: np.ndarray, block: int):
    starts = list(range(0, width, block))
    pairs = [(i, j) for i in range(len(starts)) for j in range(i, len(starts))]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        part = 0
        for batch in stream:
            x = matrix(batch.column("x"), width) - shift
            known = ~np.isnan(x)
            x, m = np.where(known, x, 0.0), known.astype(float)
            for i, j in pairs:
                a, b = slice(starts[i], starts[i] + block), slice(starts[j], starts[j] + block)
                # For both sides: rows complete in the pair, sums and squares over them, and the products.
                cell = np.stack([m[:, a].T @ m[:, b], x[:, a].T @ x[:, b], x[:, a].T @ m[:, b], (m[:, a].T @ x[:, b]),
                                 (x[:, a] ** 2).T @ m[:, b], m[:, a].T @ (x[:, b] ** 2)])
                sums[i, j] = sums[i, j] + cell if (i, j) in sums else cell
            part = batch.column("part")[0].as_py()
        for (i, j), cell in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([part], pa.int32()), pa.array([cell.ravel()])], ["a", "b", "part", "cell"])

    return run


def _added(group: pa.Table) -> pa.Table:
    total = None
    for value in group["cell"].chunks:
        for row in value:
            cell = row.values.to_numpy(zero_copy_only=False)
            total = cell if total is None else total + cell
    return pa.table({"a": group["a"][:1], "b": group["b"][:1], "part": group["part"][:1], "cell": pa.array([total])})


PARTIAL = "a int, b int, part int, cell array<double>"


def gram_blocks(df: DataFrame, cols: Sequence[str], block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """(a, b, cell): per pair of column blocks six matrices, flat: rows complete in the pair, products, sums of either side, squares of either side.

    Values are shifted by a constant per column. A table without rows has no blocks.
    """
    rows = df.select(cells_of(cols).alias("x"), F.spark_partition_id().alias("part"))
    partial = rows.mapInArrow(_partials(len(cols), shifts(df, cols), block), PARTIAL)
    some = partial.withColumn("part", F.floor(F.col("part") / fan_in).cast("int")).groupBy("a", "b", "part").applyInArrow(_added, PARTIAL)
    return some.groupBy("a", "b").applyInArrow(_added, PARTIAL).drop("part")


def _pearson(cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, correlation) of each column pair of a block pair; NaN where a side does not vary."""
    n, p, sa, sb, qa, qb = cell
    with np.errstate(all="ignore"):
        va, vb = qa - sa * sa / n, qb - sb * sb / n
        r = (p - sa * sb / n) / np.sqrt(va * vb)
    # What is left of a constant column's variance is rounding.
    flat = (va <= 1e-13 * qa) | (vb <= 1e-13 * qb) | (n < 2)
    return n, np.where(flat, np.nan, np.clip(r, -1.0, 1.0))


def _pairs(cols: Sequence[str], block: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for i, j, flat in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("cell"), strict=True):
                high, wide = (len(cols[k * block:(k + 1) * block]) for k in (i, j))
                n, r = _pearson(flat.values.to_numpy(zero_copy_only=False).reshape(6, high, wide))
                a, b = np.nonzero(np.ones((high, wide), bool) if i < j else np.triu(np.ones((high, wide), bool), 1))
                value = r[a, b]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cols[i * block + k] for k in a], pa.string()), pa.array([cols[j * block + k] for k in b], pa.string()),
                     pa.array(value, mask=np.isnan(value)), pa.array(n[a, b].astype(np.int64))], ["a", "b", "r", "n"])

    return run


def gram_correlations(df: DataFrame, cols: Sequence[str], block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """(a, b, r, n) for every column pair, over the rows in which both hold a number; r is NULL where one does not vary."""
    return gram_blocks(df, cols, block, fan_in).mapInArrow(_pairs(list(cols), block), "a string, b string, r double, n long")


def correlation_filter(df: DataFrame, cols: Sequence[str], limit: float = 0.95, block: int = BLOCK) -> list[str]:
    """The columns in order without those that correlate above ``limit``, in size, with one kept before them. Only such pairs are collected."""
    close: dict[str, set[str]] = {}
    for r in gram_correlations(df, cols, block).where(F.abs("r") > limit).select("a", "b").collect():
        close.setdefault(r["b"], set()).add(r["a"])
    kept: list[str] = []
    for c in cols:
        if close.get(c, set()).isdisjoint(kept):
            kept.append(c)
    return kept
