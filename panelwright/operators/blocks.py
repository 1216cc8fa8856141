"""All rows of one table against all rows of another, without shuffled copies of either.

Rows are packed into blocks, each a single row of a stored table. The two tables meet in a Cartesian product that reads the stored blocks
again for every pair of partitions, so nothing is written for a pair. A task holds one partition of the second table, one or a few blocks of the
first, and what these have found so far; it returns that once per block of the first table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.runtime import materialize

ROW_BYTES = 4 << 20      # of one packed block
PART_BYTES = 64 << 20    # of one partition of packed blocks
HELD = 4                 # blocks of the first table that a task keeps in mind

Packer = Callable[[pa.Table], dict[str, np.ndarray]]


def rows_a_block(most: int, numbers: int, size: int = 8) -> int:
    """At most ``most`` rows, and no more than fit ``ROW_BYTES`` with so many numbers in a row."""
    return max(1, min(most, ROW_BYTES // (size * (numbers + 1))))


def numbered(counts: Sequence[tuple[int, int]], rows: int, joined: bool = True) -> list[tuple[int, int, int]]:
    """(group, first block, parts): groups in order share blocks of about ``rows`` rows if ``joined``; larger groups are dealt to parts."""
    out, block, filled = [], 0, 0
    for group, n in sorted(counts):
        if filled and (not joined or filled + n > rows):
            block, filled = block + 1, 0
        parts = max(1, math.ceil(n / rows))
        out.append((int(group), block, parts))
        block, filled = (block + parts, 0) if parts > 1 else (block, filled + n)
    return out


def packed(rows: DataFrame, groups: Sequence[tuple[int, int, int]], pack: Packer, columns: Sequence[str], row_bytes: int, whole: int,
           spread: bool = False, name: str = "blocks") -> DataFrame:
    """The rows, which hold ``id`` and ``grp``, as a stored table (block, *columns) of binary values made by ``pack``.

    It has as many files as ``whole`` rows of ``row_bytes`` need partitions; with ``spread``, as many as there are cores at least.
    """
    spark = rows.sparkSession
    blocks = sum(parts for _, _, parts in groups)
    least = 2 * spark.sparkContext.defaultParallelism if spread else 1
    files = max(1, min(blocks, max(least, math.ceil(whole * row_bytes / PART_BYTES))))
    lookup = F.broadcast(spark.createDataFrame(groups, "grp long, first long, parts int"))         # one row a group
    dealt = rows.join(lookup, "grp").withColumn("block", F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).drop("first", "parts")

    def run(group: pa.Table) -> pa.Table:
        made = pack(group)
        return pa.table({"block": group["block"][:1].cast(pa.int64()), **{c: pa.array([made[c].tobytes()], pa.binary()) for c in columns}})

    schema = "block long, " + ", ".join(f"{c} binary" for c in columns)
    return materialize(dealt.repartition(files, "block").groupBy("block").applyInArrow(run, schema), name)


def meet(first: DataFrame, second: DataFrame, start: Callable[[dict], object], step: Callable[[object, int, dict], None],
         finish: Callable[[object], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Every block of ``first`` meets every block of ``second``.

    ``start`` makes the state of a block of the first table, ``step`` takes a block of the second into it, ``finish`` gives what it has found.
    """
    left, right = (t.select([F.col(c).alias(f"{side}{c}") for c in t.columns]) for side, t in (("a_", first), ("b_", second)))
    names = [[c for c in t.columns if c != "block"] for t in (first, second)]

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, object] = {}
        for batch in stream:
            cells = {c: batch.column(c) for c in batch.schema.names}
            for i in range(batch.num_rows):
                a, b = cells["a_block"][i].as_py(), cells["b_block"][i].as_py()
                if a not in held:
                    if len(held) >= HELD:
                        yield from finish(held.pop(next(iter(held))))
                    held[a] = start({c: cells[f"a_{c}"][i].as_buffer() for c in names[0]})
                step(held[a], b, {c: cells[f"b_{c}"][i].as_buffer() for c in names[1]})
        for state in held.values():
            yield from finish(state)

    return left.hint("shuffle_replicate_nl").crossJoin(right).mapInArrow(run, schema)


def nearest_of(k: int, at: np.ndarray, best: dict[str, np.ndarray], new: dict[str, np.ndarray]) -> np.ndarray:
    """Take candidates into the ``k`` best of each place, by distance and then id; returns the places that were looked at.

    ``best`` holds (places, k) arrays: ``distance``, infinite where there is none, ``other``, and further ones; ``new`` has their candidates for places ``at``.
    """
    places, own = np.unique(at, return_inverse=True)
    row = np.concatenate([np.repeat(np.arange(len(places)), k), own])
    every = {c: np.concatenate([best[c][places].ravel(), new[c]]) for c in best}
    order = np.lexsort((every["other"], every["distance"], row))
    row = row[order]
    first = np.searchsorted(row, np.arange(len(places)))
    rank = np.arange(len(row)) - first[row]
    keep = rank < k
    for c in best:
        best[c][places[row[keep]], rank[keep]] = every[c][order][keep]
    return places
