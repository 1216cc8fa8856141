"""Byte-level BPE by a rank file: whole pre-tokens through a minimal perfect hash, the others by a heap over linked bytes."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm.common import per_worker, table
from panelwright.llm.token_ids import TextEncoder

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PER_BUCKET = 2
_STEP = 0x9E3779B97F4A7C15
_MASK = 2 ** 64 - 1


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file by rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * (max(int(r) for _, r in pairs) + 1)
    for token, rank in pairs:
        out[int(rank)] = base64.b64decode(token)
    return out


class PerfectHash:
    """A minimal perfect hash of distinct byte strings: as many slots as keys, one displacement per bucket of about two.

    Buckets are placed from the largest to the smallest; a bucket of one key stores its slot itself. A string that is no key
    meets some key's slot and is told apart by comparing with it.
    """

    def __init__(self, keys: list[bytes]):
        self.n, self.buckets = len(keys), max(1, len(keys) // PER_BUCKET)
        groups: dict[int, list[int]] = {}
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        for i, h in enumerate(hashes):
            groups.setdefault(h % self.buckets, []).append(i)
        self.shift = [0] * self.buckets
        self.key: list[bytes | None] = [None] * self.n
        self.index = [-1] * self.n
        for bucket, members in sorted(groups.items(), key=lambda g: -len(g[1])):
            if len(members) == 1:
                break
            shift = 0
            while True:
                slots = [self._slot(hashes[i], shift) for i in members]
                if len(set(slots)) == len(slots) and all(self.key[s] is None for s in slots):
                    break
                shift += 1
            self.shift[bucket] = shift
            for i, s in zip(members, slots, strict=True):
                self.key[s], self.index[s] = keys[i], i
        free = iter([s for s in range(self.n) if self.key[s] is None])
        for bucket, members in groups.items():
            if len(members) == 1:
                s = next(free)
                self.shift[bucket] = -s - 1
                self.key[s], self.index[s] = keys[members[0]], members[0]

    def _slot(self, h: int, shift: int) -> int:
        x = (h + shift * _STEP) & _MASK
        x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & _MASK
        return (x ^ (x >> 29)) % self.n

    def get(self, key: bytes) -> int:
        """The key's index, or -1."""
        h = xxhash.xxh3_64_intdigest(key)
        shift = self.shift[h % self.buckets]
        s = -shift - 1 if shift < 0 else self._slot(h, shift)
        return self.index[s] if self.key[s] == key else -1


class BytePairs:
    def __init__(self, path: str | None = None):
        self.tokens = read_ranks(path or public_tokenizers.path(VOCABULARY))
        self.ranks = PerfectHash(self.tokens)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.text = TextEncoder(self.encode_pieces, lambda t: np.array(self.encode_text(t), np.uint32))
        self.width = np.array([len(t) for t in self.tokens])
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        decimal = [f"{i}," for i in range(len(self.tokens))]
        self.decimal_width = np.array([len(d) for d in decimal])
        self.decimal = np.frombuffer("".join(decimal).encode(), np.uint8)

    def merge(self, word: bytes) -> list[int]:
        """Always joins the neighbours of the lowest rank, the leftmost of equals. The heap holds pairs of runs; a pair whose
        runs changed meanwhile is passed over."""
        n, rank = len(word), self.ranks.get
        after, before = list(range(1, n + 2)), list(range(-1, n))         # start of the next and of the previous run
        alive = [True] * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(word[i:i + 2])) >= 0]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            if not alive[i] or after[i] >= n or after[after[i]] != end:
                continue
            gone = after[i]
            alive[gone] = False
            after[i] = end
            if end < n:
                before[end] = i
                r = rank(word[i:after[end]])
                if r >= 0:
                    heapq.heappush(heap, (r, i, after[end]))
            if before[i] >= 0:
                p = before[i]
                r = rank(word[p:end])
                if r >= 0:
                    heapq.heappush(heap, (r, p, end))
        out, i = [], 0
        while i < n:
            out.append(rank(word[i:after[i]]))
            i = after[i]
        return out

    def encode_word(self, word: bytes) -> list[int]:
        r = self.ranks.get(word)
        return [r] if r >= 0 else self.merge(word)

    def encode_text(self, text: bytes) -> list[int]:
        return [i for w in self.pattern.findall(text.decode()) for i in self.encode_word(w.encode())]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        out, size = [], []
        for p in pieces:
            t = p.decode()
            ids = self.encode_word(p) if (t[1:] if t[0] == " " else t).isalpha() else self.encode_text(p)
            out += ids
            size.append(len(ids))
        return np.array(out, np.uint32), np.array(size, np.int64)

    @staticmethod
    def _gather(ids: np.ndarray, flat: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = np.cumsum(width) - width
        size = width[ids]
        to = np.append(0, np.cumsum(size))
        return flat[np.repeat(begin[ids] - to[:-1], size) + np.arange(to[-1])], to

    def decode(self, ids: np.ndarray, bound: np.ndarray) -> list[bytes]:
        """The bytes of ids[bound[i]:bound[i + 1]] for each i."""
        flat, to = self._gather(ids, self.bytes, self.width)
        data, at = flat.tobytes(), to[bound].tolist()
        return [data[a:b] for a, b in zip(at, at[1:], strict=False)]

    def written(self, ids: np.ndarray, bound: np.ndarray) -> list[bytes]:
        """The same ids in decimal, joined by commas."""
        flat, to = self._gather(ids, self.decimal, self.decimal_width)
        data, at = flat.tobytes(), to[bound].tolist()
        return [data[a:max(a, b - 1)] for a, b in zip(at, at[1:], strict=False)]


def codec() -> BytePairs:
    return per_worker("byte_pairs", BytePairs)


def encoded(text: Column) -> Column:
    """Ids of each whole text; null is the empty text, which has none."""

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            parts = [pa.array([], pa.list_(pa.int32()))]
            for _, _, ids, n in codec().text(column):
                parts.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), pa.array(ids.astype(np.int32))))
            yield pa.concat_arrays(parts)

    return F.arrow_udf(run, "array<int>").asNondeterministic()(text)


def decoded(ids: Column) -> Column:
    """Bytes of each array of ids; null stays null."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            sizes = np.array([len(x) if x.is_valid else 0 for x in column], np.int64)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            out = codec().decode(flat, np.append(0, np.cumsum(sizes)))
            yield pa.array([x if v.is_valid else None for x, v in zip(out, column, strict=True)], pa.binary())

    return F.arrow_udf(run, "binary")(ids)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each row of ``docs``; the last is of the bytes decoded from the ids.

    Rows are handled one by one, so repeated rows, null ids and further columns change nothing.
    """
    def run(stream):
        for batch in stream:
            for a, e, ids, n in codec().text(batch.column("text")):
                bound = np.append(0, np.cumsum(n))
                ids = ids.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, e - a), pa.array(n.astype(np.int64)),
                     pa.array([hashlib.sha256(x).hexdigest() for x in codec().written(ids, bound)]),
                     pa.array([hashlib.sha256(x).hexdigest() for x in codec().decode(ids, bound)])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
