"""Token-id files coded by a static range asymmetric numeral system (rANS) with one shared frequency table.

A corpus folder holds two tables: ``model`` (id, frequency, summing to 2^20) and ``blocks``. A block row codes a run of whole
documents in ascending doc_id order: their ids and lengths, and a payload of interleaved lanes. Any block, and within
it any segment between two checkpoints, decodes alone; checksums cover the payload and every document's ids.

Payload, little-endian: magic ``RNS1``, u32 lanes, u32 steps of a segment, u64 ids, u32 segments; per segment u64 first word and
u64 states of all lanes; then the u32 words in the order in which decoding reads them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelwright.llm.common import Scratch, table
from panelwright.llm.token_ids import encoder, with_end

BITS = 20                # frequencies sum to 2^BITS; every id of the vocabulary has at least 1
LOW = np.uint64(1 << 31)
LANES = 1024
SEGMENT = 256            # steps between checkpoints
BLOCK_IDS = 1 << 19      # a block closes with the document that reaches this many ids
END = 2
HEAD = "<4sIIQI"


def normalised(counts: np.ndarray) -> np.ndarray:
    """Frequencies of at least 1 that sum to 2^BITS, in proportion to the counts. Needs fewer than 2^BITS ids."""
    n, total = len(counts), max(1, int(counts.sum()))
    spare = (1 << BITS) - n
    extra = (counts.astype(object) * spare // total).astype(np.int64) if counts.sum() else np.zeros(n, np.int64)
    extra[int(np.argmax(counts))] += spare - int(extra.sum())
    return extra + 1


class Coder:
    def __init__(self, frequency: np.ndarray):
        self.f = frequency.astype(np.uint64)
        self.c = np.cumsum(self.f) - self.f
        self.symbol = np.repeat(np.arange(len(frequency), dtype=np.uint32), frequency)
        self.filler = int(np.argmax(frequency))

    def encode(self, ids: np.ndarray) -> bytes:
        lanes = 1
        while lanes < LANES and lanes * 64 < len(ids):
            lanes *= 2
        steps = -(-len(ids) // lanes)
        grid = np.full(steps * lanes, self.filler, np.int64)
        grid[:len(ids)] = ids
        grid = grid.reshape(steps, lanes)
        x = np.full(lanes, LOW, np.uint64)
        words, points, sent = [], [], 0
        for s in range(steps - 1, -1, -1):
            f, c = self.f[grid[s]], self.c[grid[s]]
            full = x >= f << np.uint64(63 - BITS)
            if full.any():
                out = x[full].astype(np.uint32)
                words.append(out)
                sent += len(out)
                x[full] >>= np.uint64(32)
            q = x // f
            x = (q << np.uint64(BITS)) + (x - q * f) + c
            if s % SEGMENT == 0:
                points.append((sent, x.copy()))
        head = struct.pack(HEAD, b"RNS1", lanes, SEGMENT, len(ids), len(points))
        table_ = b"".join(struct.pack("<Q", sent - at) + states.astype("<u8").tobytes() for at, states in reversed(points))
        return head + table_ + (np.concatenate(words[::-1]).astype("<u4").tobytes() if words else b"")

    def decode(self, payload: bytes) -> np.ndarray:
        """All segments side by side."""
        magic, lanes, segment, n, segments = struct.unpack_from(HEAD, payload)
        if magic != b"RNS1":
            raise ValueError("not a block")
        size = 8 + 8 * lanes
        points = np.frombuffer(payload, np.uint8, size * segments, struct.calcsize(HEAD)).reshape(segments, size)
        at = points[:, :8].copy().view("<u8").ravel().astype(np.int64)
        x = points[:, 8:].copy().view("<u8").astype(np.uint64)
        words = np.append(np.frombuffer(payload, "<u4", offset=struct.calcsize(HEAD) + size * segments), np.uint32(0)).astype(np.uint64)
        steps = -(-n // lanes)
        out = np.zeros((segments * segment, lanes), np.uint32)
        mask = np.uint64((1 << BITS) - 1)
        for s in range(min(segment, steps)):
            live = segments if (segments - 1) * segment + s < steps else segments - 1    # only the last may be shorter
            y = x[:live]
            slot = y & mask
            ids = self.symbol[slot]
            out[s:s + live * segment:segment][:live] = ids
            y = self.f[ids] * (y >> np.uint64(BITS)) + slot - self.c[ids]
            low = y < LOW
            used = np.cumsum(low, axis=1)
            fetch = words[np.where(low, at[:live, None] + used - 1, len(words) - 1)]
            x[:live] = np.where(low, (y << np.uint64(32)) | fetch, y)
            at[:live] += used[:, -1]
        return out.reshape(-1)[:n]


def _tokenize(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, at = TaskContext.get().partitionId(), 0
    for batch in stream:
        for a, e, ids, n in encoder()(batch.column("text")):
            ids, n = with_end(ids, n, END)
            to = np.cumsum(n)
            raw = ids.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(a, e - a), pa.array(np.full(e - a, part, np.int32)), pa.array(at + to - n),
                 pa.array([raw[4 * (t - k):4 * t] for t, k in zip(to.tolist(), n.tolist(), strict=True)], pa.binary())],
                ["doc_id", "part", "at", "ids"])
            at += int(to[-1])


def _counts(size: int):
    def run(stream):
        total = np.zeros(size, np.int64)
        for batch in stream:
            for x in batch.column("ids"):
                total += np.bincount(np.frombuffer(x.as_buffer(), "<u4"), minlength=size) if len(x.as_buffer()) > 4 * size else 0
            small = [x.as_buffer() for x in batch.column("ids") if len(x.as_buffer()) <= 4 * size]
            if small:
                total += np.bincount(np.frombuffer(b"".join(small), "<u4"), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["id", "n"])

    return run


BLOCKS = ("part int, at long, doc_ids binary, null_ids binary, sizes binary, doc_crcs binary, payload binary, payload_crc32 long")


def _write_blocks(model):
    def run(stream):
        coder = Coder(model.value)
        held: list[tuple] = []
        names = [f.split()[0] for f in BLOCKS.split(", ")]

        def block():
            ids = np.frombuffer(b"".join(h[3] for h in held), "<u4")
            payload = coder.encode(ids)
            columns = [held[0][1], held[0][2], np.array([h[0] or 0 for h in held], "<i8").tobytes(),
                       bytes(h[0] is None for h in held), np.array([len(h[3]) // 4 for h in held], "<i8").tobytes(),
                       np.array([zlib.crc32(h[3]) for h in held], "<u4").tobytes(), payload, zlib.crc32(payload)]
            types = [pa.int32(), pa.int64(), *[pa.binary()] * 5, pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, types, strict=True)], names)

        size = 0
        for batch in stream:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "at", "ids")), strict=True):
                if held and (row[1] != held[0][1] or size >= BLOCK_IDS or row[2] != held[-1][2] + len(held[-1][3]) // 4):
                    yield block()
                    held, size = [], 0
                held.append(row)
                size += len(row[3]) // 4
        if held:
            yield block()

    return run


def write_corpus(docs: DataFrame, path: str) -> None:
    """Tokenize every document (null text: only the end id) and write the corpus folder at ``path``.

    Documents are dealt into ranges of doc_id before tokenizing, so a task's ids are consecutive; null ids come first, rows that
    share an id stay in one order once dealt. The frequency table counts all ids. Only it, one number per id of the vocabulary,
    passes through the driver.
    """
    spark = docs.sparkSession
    size = len(encoder().width)
    with Scratch(spark, "rans") as s:
        ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
        tokens = s.store(ordered.mapInArrow(_tokenize, "doc_id long, part int, at long, ids binary"))
        seen = tokens.select("ids").mapInArrow(_counts(size), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
        counts = np.zeros(size, np.int64)
        for r in seen:
            counts[r["id"]] = r["n"]
        frequency = normalised(counts)
        spark.createDataFrame([(i, int(f)) for i, f in enumerate(frequency)], "id int, frequency int").coalesce(1).write.parquet(f"{path}/model")
        model = spark.sparkContext.broadcast(frequency)
        parts = (tokens.agg(F.max("part")).first()[0] or 0) + 1
        (tokens.mapInArrow(_write_blocks(model), BLOCKS).repartitionById(parts, F.col("part")).sortWithinPartitions("at")
         .write.option("compression", "none").parquet(f"{path}/blocks"))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of each document, decoded from a corpus folder; checksums are verified."""
    model = spark.read.schema("id int, frequency int").parquet(f"{path}/model").orderBy("id").toArrow()["frequency"].to_numpy()
    sent = spark.sparkContext.broadcast(model)

    def run(stream):
        coder = Coder(sent.value)
        for batch in stream:
            for row in batch.to_pylist():
                if zlib.crc32(row["payload"]) != row["payload_crc32"]:
                    raise ValueError("damaged block")
                raw = coder.decode(row["payload"]).astype("<u4").tobytes()
                n = np.frombuffer(row["sizes"], "<i8")
                to = np.cumsum(n)
                ids = [raw[4 * (t - k):4 * t] for t, k in zip(to.tolist(), n.tolist(), strict=True)]
                crc = [zlib.crc32(x) for x in ids]
                if crc != np.frombuffer(row["doc_crcs"], "<u4").tolist():
                    raise ValueError("ids differ from their checksums")
                none = np.frombuffer(row["null_ids"], np.uint8).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=none), pa.array(np.full(len(n), row["part"], np.int32)),
                     pa.array(row["at"] + to - n), pa.array(n), pa.array(crc, pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "part", "at", "n_tokens", "ids_crc32", "ids"])

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    docs = blocks.mapInArrow(run, "doc_id long, part int, at long, n_tokens long, ids_crc32 long, ids binary")
    # One row per file part: their totals are all that the running sum needs.
    totals = blocks.select("part", "at", "sizes").mapInArrow(_totals, "part int, n long").groupBy("part").agg(F.sum("n").alias("n"))
    base = totals.select("part", (F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("base"))
    return docs.join(base, "part").select("doc_id", (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids_crc32", "ids")


def _totals(stream):
    for batch in stream:
        n = [int(np.frombuffer(x, "<i8").sum()) for x in batch.column("sizes").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(n, pa.int64())], ["part", "n"])


def round_trip(docs: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row of ``docs``, read back from the files that it writes."""
    with Scratch(docs.sparkSession, "rans-corpus") as s:
        write_corpus(docs, s.root)
        return s.result(read_corpus(docs.sparkSession, s.root).drop("ids"))


def op7_rans_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
