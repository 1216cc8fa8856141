"""Token files, packing, byte-level BPE, neighbours and chat formatting: exact round trips and brute force."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from panelwright.llm import byte_bpe, chat_format, neighbours, packing, rans_files


@pytest.fixture(scope="module")
def ids(odd_rows):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {i: np.array(t.encode(x or "", add_special_tokens=False).ids, "<u4") for i, x in odd_rows}


@pytest.mark.parametrize("n", [0, 1, 64, 65, 5000, 40_000])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    coder = rans_files.Coder(rans_files.normalised(rng.integers(0, 900, 5000)))
    values = (rng.zipf(1.4, n) % 5000).astype(np.uint32)
    assert np.array_equal(coder.decode(coder.encode(values)), values)


def test_token_files(odd_docs, odd_rows, ids):
    rows = rans_files.round_trip(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    start = None
    for r in sorted(rows, key=lambda r: r.start):
        assert start in (None, r.start)
        start = r.start + r.n_tokens
        if r.doc_id is not None:
            own = np.append(ids[r.doc_id], 2).astype("<u4")
            assert (r.n_tokens, r.ids_crc32) == (len(own), zlib.crc32(own.tobytes()))
    order = [r.doc_id if r.doc_id is not None else -1 for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order)


def test_packing(odd_docs, odd_rows, ids):
    rows = packing.pack(odd_docs, 256).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        if r.doc_id is not None:
            own = np.append(ids[r.doc_id], 1).astype("<u4")
            assert zlib.crc32(own[r.start:r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(own)
            pieces[r.doc_id].append((r.start, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    times = defaultdict(int)
    for i, _ in odd_rows:
        times[i] += 1
    assert {i: sum(n for _, n in p) for i, p in pieces.items()} == {i: (len(ids[i]) + 1) * k for i, k in times.items()}


def test_histogram_packing_places_everything():
    histogram = {2048: 5, 1500: 7, 700: 11, 300: 40, 40: 90, 3: 1000}
    patterns = packing.shortest_pack_first(histogram)
    placed = defaultdict(int)
    for pattern, count in patterns:
        assert sum(n * k for n, k in pattern) <= 2048
        for length, k in pattern:
            placed[length] += k * count
    assert placed == histogram


def test_byte_pairs(odd_docs, odd_rows):
    import base64

    import tiktoken
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in byte_bpe.digests(odd_docs).collect()}
    for i, t in odd_rows:
        own = library.encode_ordinary(t or "")
        assert got[i].n_tokens == len(own)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    back = odd_docs.select("text", byte_bpe.decoded(byte_bpe.encoded(odd_docs["text"])).alias("b")).collect()
    assert all(bytes(r.b).decode() == (r.text or "") for r in back)


def item_by_item(histogram, room):
    """Fill of each pack when one item after the other, longest first, goes to the shortest pack that holds it."""
    packs, heap = [], defaultdict(list)                                # used -> packs
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            used = min((u for u, ps in heap.items() if ps and u + length <= room), default=None)
            place = heap[used].pop() if used is not None else len(packs)
            if used is None:
                packs.append(0)
            packs[place] += length
            heap[packs[place]].append(place)
    return sorted(packs)


@pytest.mark.parametrize("seed", range(12))
def test_packing_equals_item_by_item(seed):
    rnd = np.random.default_rng(seed)
    room = int(rnd.choice([32, 100, 256]))
    lengths = rnd.choice(np.arange(1, room + 1), size=int(rnd.integers(1, 9)), replace=False)
    histogram = {int(n): int(rnd.integers(1, 120)) for n in lengths}
    patterns = packing.shortest_pack_first(histogram, room)
    placed = defaultdict(int)
    for pattern, count in patterns:
        for n, k in pattern:
            placed[n] += k * count
    assert dict(placed) == histogram
    assert sorted(sum(n * k for n, k in p) for p, c in patterns for _ in range(c)) == item_by_item(histogram, room)


@pytest.mark.parametrize("histogram,sequences", [({100: 1000}, 50), ({3: 1000}, 2), ({1024: 1000}, 500), ({300: 50, 40: 3000}, 67), ({1: 2049}, 2)])
def test_few_lengths_share_packs(histogram, sequences):
    assert sum(c for _, c in packing.shortest_pack_first(histogram)) == sequences


def test_equal_documents_share_sequences(spark):
    docs = spark.createDataFrame([(i, "word " * 60 + ".") for i in range(300)], "doc_id long, text string")
    rows = packing.pack(docs).collect()
    n = rows[0].doc_tokens
    assert len(rows) == 300 and all(r.doc_tokens == n == r.length for r in rows)
    used = defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length, r.padded_length))
    assert sorted(used) == list(range(-(-300 // (2048 // n))))
    for parts in used.values():
        end = 0
        for offset, length, _ in sorted(parts):
            assert offset == end
            end += length
        assert {p for *_, p in parts} == {end if end & (end - 1) == 0 else 2048}


def test_perfect_hash():
    keys = [f"key {i}".encode() for i in range(3000)]
    table = byte_bpe.PerfectHash(keys)
    assert [table.get(k) for k in keys] == list(range(3000)) and sorted(table.index) == list(range(3000))
    assert table.get(b"other") == -1


def test_neighbours(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 20)).astype(np.float32)
    x[50:90] = x[0]                                        # copies of a query
    rows = [(i, v.tolist(), "k", 1) for i, v in enumerate(x)]
    rows += [(600, None, "k", 1), (700, [0.0] * 20, "k", 1), (800, [float("nan")] * 20, "k", 1), (None, x[1].tolist(), "k", 1), (601, [1.0, None] * 10, "k", 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node string, key int")
    got = defaultdict(list)
    for r in neighbours.nearest(df, cell=64).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == {0, 100, 200, 300, 400, 500}
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        d[q] = np.inf
        best = np.lexsort((np.arange(600), d))[:10]
        assert [a for a, _, _ in sorted(found)] == list(range(1, 11))
        assert all(abs(d[v] - s) < 1e-12 for _, v, s in found)
        assert [(s, v) for _, v, s in sorted(found)] == sorted((s, v) for _, v, s in found)
        hits += len(set(best.tolist()) & {v for _, v, _ in found})
    assert hits >= 54
    few = neighbours.nearest(df.where("vec_id in (0, 100, 3)")).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in few if r.query_id == 0)[0][1] == 1 and len(few) == 4
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_chat(spark):
    rows = [(1, 0, "user", "hi", "x"), (1, 1, "user", "[SEP]</s>", "x"), (1, 2, "assistant", "<\\\\s> <\\s> [/INST]", "x"), (1, 3, "assistant", None, "x"),
            (2, 0, "system", "", "x"), (2, 1, "tool", "a[ROLE]b", "x"), (2, 1, "tool", "a[ROLE]b", "x"), (2, 5, None, "n", "x"),
            (3, 0, "[SEP]", "odd role", "x"), (None, 0, "user", "<", "x"), (None, 1, "assistant", "/s>", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    back = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in chat_format.read_back(chat_format.format_conversations(df)).collect()}
    want = defaultdict(list)
    for c, _, role, text, _ in rows:
        want[c].append((role or "", text or ""))
    assert back == want
    assert chat_format.digests(df.limit(0)).count() == 0


def test_empty_tables(no_docs):
    assert rans_files.round_trip(no_docs).count() == 0
    assert packing.pack(no_docs).count() == 0
    assert byte_bpe.digests(no_docs).count() == 0
