"""Vector codes, importance resampling and source mixing against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from panelwright.llm.catalog import QUERIES
from panelwright.llm.common import Scratch, numbered
from panelwright.llm.importance import bucket_gains, resample
from panelwright.llm.mixing import fit_budget, fit_sum, mix
from panelwright.llm.vector_codes import assign, compress

# ---- vector codes


def plain_codes(rows, parts, entries, rounds, scale):
    """[(vec_id, code, error)] and the codebooks, all in Python numbers; rows are (vec_id, vector)."""
    kept = [(i, [math.floor(scale * v) for v in x]) for i, x in rows]
    start = [x for _, x in sorted((r for r in kept if r[0] is not None))[:entries]]
    w = len(kept[0][1]) // parts
    books = [[x[p * w:(p + 1) * w] for x in start] for p in range(parts)]

    def nearest(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(x[p * w:(p + 1) * w], c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, x in kept:
            for p in range(parts):
                members[p, nearest(x, p)[1]].append(x[p * w:(p + 1) * w])
        for (p, e), ms in members.items():
            books[p][e] = [sum(c) // len(ms) for c in zip(*ms, strict=True)]
    out = []
    for i, x in kept:
        near = [nearest(x, p) for p in range(parts)]
        out.append((i, bytes(e for _, e in near).hex(), sum(d for d, _ in near)))
    return out, books


def vectors_of(seed, n, size, grid):
    """Clustered vectors on a coarse grid, so that distances tie."""
    rnd = random.Random(seed)
    centres = [[rnd.uniform(-1, 1) for _ in range(size)] for _ in range(7)]
    return [(i, [round((c + rnd.gauss(0, 0.2)) * grid) / grid for c in rnd.choice(centres)]) for i in range(n)]


def key(row):
    return tuple((v is None, v) for v in row)


@pytest.mark.parametrize("seed,n,size,parts,entries,listed", [(1, 400, 12, 3, 16, None), (2, 300, 4, 4, 5, 2), (3, 9, 8, 2, 16, None), (4, 250, 6, 1, 20, 3), (5, 200, 4, 2, 1, None)])
def test_codes_equal_plain_rounds(spark, seed, n, size, parts, entries, listed):
    rows = vectors_of(seed, n, size, 4)
    rows += [(None, rows[3][1]), (5, rows[8][1]), (5, rows[8][1])]                       # null id, repeated id and row
    df = spark.createDataFrame([(i, x, "l", 1) for i, x in rows], "vec_id long, embedding array<float>, part string, error int").repartition(3)
    want, books = plain_codes(rows, parts, entries, 6, 32)
    with Scratch(spark, "test") as s:
        got = compress(df, s, parts, entries, 6, 32, listed=listed)
        found = [(r["vec_id"], bytes(r["codes"]).hex(), r["error"]) for r in got.rows.collect()]
    assert got.books.tolist() == books
    assert sorted(found, key=key) == sorted(want, key=key)


def test_bounds_give_the_same_as_all_distances():
    rng = np.random.default_rng(3)
    x, c = rng.integers(-40, 40, (500, 3)), rng.integers(-40, 40, (16, 3))
    ids, low, own, _ = assign(x, c, None, None, np.zeros(16), 6)
    looked = 0
    for step in range(12):
        new = c + rng.integers(-3, 4, c.shape) * (rng.random(16) < 0.4)[:, None]
        moved = np.sqrt(((new - c) ** 2).sum(1)) * (1 + 1e-12)
        c = new
        ids, low, own, depth = assign(x, c, ids, np.nextafter(low.astype("f4"), np.float32(-np.inf)), moved, max(2, 6 - step // 3))
        d = ((x[:, None] - c) ** 2).sum(2)
        assert (ids[:, 0] == d.argmin(1)).all() and (own == d.min(1)).all()
        for j in range(1, ids.shape[1]):                                                 # bounds stay below the distances
            assert (low[:, j - 1] <= np.sqrt(d[np.arange(500), ids[:, j]]) * (1 + 1e-9)).all()
        rest = np.sqrt(np.where((np.arange(16) == ids[..., None]).any(1), 10 ** 12, d).min(1))
        assert (low[:, -1] <= rest * (1 + 1e-9)).all()
        looked += (depth > 1).mean()
    assert looked < 12                                                                   # some were decided by their bounds alone


def test_codes_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0], None), (2, None, 1), (3, [nan, 1.0], 1), (4, [inf, 0.0], 1), (5, [None, 0.0], 1), (6, [], 1), (7, [1.0, 2.0, 3.0], 1),
            (8, [1e30, -1e30], 1), (9, [0.0, 0.0], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    with Scratch(spark, "test") as s:
        got = compress(df, s, 2, 2, 3, carry=["label"])
        assert sorted(r["vec_id"] for r in got.rows.collect()) == [1, 8, 9]
        none = compress(df.where("vec_id = 2"), s, carry=["label"])
        assert none.rows.columns == got.rows.columns and none.rows.count() == 0
        with pytest.raises(ValueError):
            compress(df, s, 3, 2)


def test_labels_null_together(spark, sf):
    rows = QUERIES["op11_vector_codes"](spark, sf)
    assert rows.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    total = rows.join(spark.read.parquet(f"{sf}/embeddings.parquet"), "vec_id")
    assert total.groupBy("label").agg({"error": "sum", "label_error": "max"}).where("`sum(error)` <> `max(label_error)`").count() == 0


# ---- importance resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, longest):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i:i + n]).encode() for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain_resample(docs, target, longest, buckets, least, percent, seed):
    """{(doc_id, n_words, n_features, weight, score, rank)} as sorted rows."""
    feats = [(i, *plain_features(t, longest)) for i, t in docs]
    raw, aim = Counter(), Counter()
    for _, _, f in feats:
        raw.update(zlib.crc32(g) % buckets for g in f)
    for t in target:
        aim.update(zlib.crc32(g) % buckets for g in plain_features(t, longest)[1])
    s, t = sum(raw.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1.0) * (s + buckets) / ((raw[b] + 1.0) * (t + buckets)))) for b in range(buckets)}
    rows = []
    for i, n, f in feats:
        weight = sum(gain[zlib.crc32(g) % buckets] for g in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    for place, r in enumerate(fit[:percent * len(fit) // 100], 1):
        r[5] = place
    return sorted(map(tuple, rows), key=key)


@pytest.mark.parametrize("longest,percent,least", [(1, 10, 20), (2, 35, 5), (3, 100, 1)])
def test_resampling_equals_plain_python(spark, odd_rows, odd_docs, longest, percent, least):
    target = [odd_rows[20][1], None, "", "W1 w2-w3 É w4", " ".join(f"w{i}" for i in range(40))]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    docs = [*odd_rows, (None, "a null id " * 40)]
    with Scratch(spark, "test") as s:
        got = resample(odd_docs, aim, s, longest, 257, least, percent, 5)
        found = sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=key)
    assert found == plain_resample(docs, target, longest, 257, least, percent, 5)


def test_resampling_of_nothing(spark, no_docs):
    with Scratch(spark, "test") as s:
        assert resample(no_docs, no_docs, s).count() == 0
        alone = resample(spark.createDataFrame([(1, "a " * 30), (2, None)], "doc_id long, text string"), no_docs, s)
        assert sorted((r["doc_id"], r["n_features"], r["rank"]) for r in alone.collect()) == [(1, 30, None), (2, 0, None)]
    assert bucket_gains(np.zeros(3, int), np.zeros(3, int)).tolist() == [0, 0, 0]


def test_numbered_in_many_ranges(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 30), rnd.randint(0, 10 ** 6)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a long, b long").repartition(6)
    with Scratch(spark, "test") as s:
        got = sorted(numbered(df, s, df["a"].desc(), df["b"], rows=100).collect(), key=lambda r: r["_place"])
    assert [(r["a"], r["b"]) for r in got] == sorted(rows, key=lambda r: (-r[0], r[1]))
    assert [r["_place"] for r in got] == list(range(3000))


# ---- mixing


def best_sum(lengths, counts, budget):
    sums = {0}
    for n, c in zip(lengths, counts, strict=True):
        sums = {s + k * n for s in sums for k in range(c + 1) if s + k * n <= budget}
    return max(sums)


def test_fit_sum_is_the_best_there_is():
    rnd = random.Random(9)
    for _ in range(300):
        k = rnd.randint(0, 6)
        lengths, counts = rnd.sample(range(1, 40), k), [rnd.randint(0, 9) for _ in range(k)]
        budget = rnd.randint(0, 300)
        got = fit_sum(lengths, counts, budget)
        assert all(0 <= g <= c for g, c in zip(got, counts, strict=True))
        assert sum(g * n for g, n in zip(got, lengths, strict=True)) == best_sum(lengths, counts, budget)


@pytest.mark.parametrize("sums", [50, 1000, 1 << 17])
def test_budgets_are_met_from_below(sums):
    rnd = random.Random(sums)
    for _ in range(200):
        sizes = np.array(sorted(rnd.sample(range(0, 400), rnd.randint(1, 30))))
        counts = np.array([rnd.choice([1, 2, 1000, 10 ** 6]) for _ in sizes])
        total = int((sizes * counts).sum())
        target = rnd.random() * 2 * total
        passes, extra = fit_budget(sizes, counts, target, 2, sums)
        taken = passes * total + int((sizes * extra).sum())
        left = sizes[(sizes > 0) & (extra < counts)] if passes < 2 else sizes[:0]
        assert ((extra >= 0) & (extra <= counts)).all() and taken <= target
        assert not len(left) or target - taken < left.min() + 1


def plain_targets(sizes, weights, share, most):
    """{source: target} by sharing the excess again and again."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, budget = dict.fromkeys(order, 0.0), list(order), share * sum(sizes.values()) / 100
    while budget > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            out[s] += budget * weight[s] / total
        budget = sum(max(0.0, out[s] - most * sizes[s]) for s in open_)
        for s in open_:
            out[s] = min(out[s], most * sizes[s])
        open_ = [s for s in open_ if out[s] < most * sizes[s]]
    return out


def mixed(spark, docs, **settings):
    with Scratch(spark, "test") as s:
        return sorted((tuple(r) for r in mix(docs, s, **settings).select("doc_id", "source", "size", "source_size", "target", "times").collect()), key=key)


@pytest.mark.parametrize("settings", [{}, {"chunk_rows": 3}, {"share": 40, "sums": 64}, {"weights": (1, 9), "seed": 3}])
def test_mix_meets_its_targets(spark, odd_rows, settings):
    names = ["b", "a", None, "é", "Z", "tiny"]
    rows = [(i, t, names[5] if i == 15 else names[(i or 0) % 5]) for i, t in [*odd_rows, (None, "one two three"), (None, "one two three")]]
    rows += [(1000 + i, "same length here ok", "hot") for i in range(200)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, times int").repartition(4)
    got = mixed(spark, docs, **settings)
    size = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, s in rows]
    assert Counter(r[:3] for r in got) == Counter(size)
    per = Counter()
    for _, s, n in size:
        per[s] += n
    want = plain_targets(per, settings.get("weights", (3, 1, 2)), settings.get("share", 150), 2)
    taken = Counter()
    for _, s, n, total, target, times in got:
        assert total == per[s] and math.isclose(target, want[s], rel_tol=1e-9, abs_tol=1e-6) and 0 <= times <= 2
        taken[s] += n * times
    for s, target in want.items():
        least = min((n for _, x, n, _, _, times in got if x == s and n and times < 2), default=0)
        assert taken[s] <= target + 1e-6 and target - taken[s] < least + 1
    assert mixed(spark, docs.repartition(7), **settings) == got                          # reruns agree, wherever the rows lie


def test_mix_of_nothing(spark):
    assert mixed(spark, spark.createDataFrame([], "doc_id long, text string, source string")) == []
    empty = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [r[2:5] for r in mixed(spark, empty)] == [(0, 0, 0.0)] * 2


def test_mix_query(spark, sf):
    rows = QUERIES["op13_mixing"](spark, sf)
    assert rows.columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert rows.where("taken > 2 * size or taken % nullif(size, 0) <> 0").count() == 0
