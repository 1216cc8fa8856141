"""Packing by shortest-pack-first over the histogram of lengths; patterns are joined back to the pieces by rank."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.llm.common import Scratch, table
from panelwright.llm.token_ids import encoder, with_end

ROOM = 2048
END = 1
CHUNK_ROWS = 20_000      # pieces of one rank chunk, about


def cut(n: int, room: int = ROOM) -> list[int]:
    """Piece lengths of a document of ``n`` ids: full sequences, then the rest."""
    return [room] * (n // room) + ([n % room] if n % room else [])


def _pieces(room: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            doc = batch.column("doc_id")
            for a, e, ids, n in encoder()(batch.column("text")):
                ids, n = with_end(ids, n, END)
                raw, first = memoryview(ids.astype("<u4").tobytes()), np.cumsum(n) - n
                k = -(-n // room)
                row = np.repeat(np.arange(e - a), k)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)) * room
                length = np.minimum(n[row] - start, room)
                begin = 4 * (first[row] + start)
                crc = [zlib.crc32(raw[b:b + 4 * m]) for b, m in zip(begin.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [doc.slice(a, e - a).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(n[row])],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def shortest_pack_first(histogram: dict[int, int], room: int = ROOM) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """[(pattern, count)]: a pattern is ((length, how many), ...), longest first; ``count`` sequences follow it.

    Lengths are placed longest first. Each goes into the shortest open packs that hold it, a whole pattern count at a time, and
    the pattern splits where fewer items than packs are left. New packs open only when none holds it; the first takes further items of
    the length until it is full, as it is then the only one that holds any, then the next, and the last one what is left.
    The work depends on ``room`` alone, never on the counts.
    """
    open_: dict[int, list[list]] = defaultdict(list)                     # used length -> [pattern, count]
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            used = min((u for u, v in open_.items() if v), default=room)
            if used + length > room:
                each = room // length
                for packs, items in ((left // each, each), (1, left % each)):
                    if packs and items:
                        open_[items * length].append([((length, items),), packs])
                break
            pattern, count = open_[used].pop()
            take = min(left, count)
            if take < count:
                open_[used].append([pattern, count - take])
            own = dict(pattern)
            own[length] = own.get(length, 0) + 1
            open_[used + length].append([tuple(own.items()), take])
            left -= take
        merged = defaultdict(int)                                        # equal patterns become one again
        for u, v in list(open_.items()):
            if len(v) > 64:
                merged.clear()
                for pattern, count in v:
                    merged[pattern] += count
                open_[u] = [[p, c] for p, c in merged.items()]
    return [(p, c) for v in open_.values() for p, c in v]


def placements(patterns: list, room: int = ROOM) -> list[tuple[int, int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, per sequence, offset, filled) of each part of each pattern."""
    rows, rank, sequence = [], defaultdict(int), 0
    for pattern, count in patterns:
        filled, at = sum(n * k for n, k in pattern), 0
        for length, k in pattern:
            rows.append((length, rank[length], rank[length] + k * count, sequence, k, at, filled))
            rank[length] += k * count
            at += length * k
        sequence += count
    return rows


def pack(docs: DataFrame, room: int = ROOM) -> DataFrame:
    """Pieces of all documents with their places: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length).

    A null or empty text is its end id alone. Documents are cut every ``room`` ids. A sequence is padded to ``room``; one that is filled
    to a power of two stays as it is. Repeated rows and rows with null ids are packed like others. The histogram has ``room`` counts
    and is all that reaches the driver; a piece's rank among those of its length is its place in a chunk of rows plus the count
    of that length in the chunks before, so a length that a third of all pieces share is ranked by many tasks.
    """
    spark = docs.sparkSession
    with Scratch(spark, "packing") as s:
        pieces = s.store(docs.select("doc_id", "text").mapInArrow(
            _pieces(room), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"))
        histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
        rows = placements(shortest_pack_first(histogram, room), room)
        chunks = max(16, sum(histogram.values()) // CHUNK_ROWS)
        chunk = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(chunks)).cast("int")
        pieces = pieces.withColumn("chunk", chunk)
        before = (pieces.groupBy("length", "chunk").count().withColumn(
            "before", F.sum("count").over(W.partitionBy("length").orderBy("chunk").rowsBetween(W.unboundedPreceding, 0)) - F.col("count"))
            .select("length", "chunk", "before"))
        ranked = pieces.withColumn("r", F.row_number().over(
            W.partitionBy("length", "chunk").orderBy("doc_id", "start", "ids_crc32")) - 1)
        ranked = ranked.join(before, ["length", "chunk"]).withColumn("rank", F.col("r") + F.col("before"))
        plan = spark.createDataFrame(rows, "length long, low long, high long, sequence long, per long, at long, filled long")
        placed = ranked.join(F.broadcast(plan), (plan["length"] == ranked["length"]) & (F.col("rank") >= F.col("low"))     # O(room) rows
                             & (F.col("rank") < F.col("high"))).drop(plan["length"])
        step = F.col("rank") - F.col("low")
        two = F.expr("filled & (filled - 1)") == 0
        return s.result(placed.select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("sequence") + F.expr("(rank - low) div per")).alias("sequence_id"),
            (F.col("at") + step % F.col("per") * F.col("length")).alias("offset"),
            F.when(two, F.col("filled")).otherwise(F.lit(room)).cast("long").alias("padded_length")))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
