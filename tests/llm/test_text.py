"""Word windows, shingle joins and quality rules against plain Python; edge cases of each."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from panelwright.llm import jaccard, quality_rules, substring

WORD = "[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(WORD, text or "")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize(("window", "start"), [(50, 25), (12, 6), (9, 4)])
def test_removed_words(odd_docs, odd_rows, window, start):
    first = {}
    for i, t in odd_rows:
        w = words(t)
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            first[k] = min(first.get(k, i), i)
    got = by_id(substring.repeat_digests(odd_docs, window, start))
    assert substring.repeat_digests(odd_docs, window, start).count() == odd_docs.count()
    for i, t in odd_rows:
        w = words(t)
        gone = {q for p in range(len(w) - window + 1) if first[tuple(w[p:p + window])] < i for q in range(p, p + window)}
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        r = got[i]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()), i
    assert got[None].n_removed == 0


def test_rewritten_rows_keep_their_columns(odd_docs):
    out = substring.remove_repeats(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    digest = {r.doc_id: r for r in substring.repeat_digests(odd_docs).collect()}
    old = {r.doc_id: r.text for r in odd_docs.collect()}
    for r in out.collect():
        if digest[r.doc_id].n_removed == 0:
            assert r.text == old[r.doc_id]
        else:
            assert hashlib.sha256(r.text.encode()).hexdigest() == digest[r.doc_id].kept_sha256


def components(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = words(re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_similar_groups(odd_docs, odd_rows, size, percent):
    got = jaccard.similar_groups(odd_docs, size, percent)
    want = components(odd_rows, size, percent)
    rows = got.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r.doc_id
        else:
            assert r.component_id is None


def test_crowded_groups_in_small_cells(spark, monkeypatch):
    """Many variants of few texts: no group is finished by its leader alone."""
    import random

    rnd = random.Random(2)
    rows = []
    for _ in range(4):
        base = [f"v{rnd.randrange(50)}" for _ in range(60)]
        for _ in range(25):
            w = list(base)
            for _ in range(rnd.randint(0, 3)):
                w[rnd.randrange(60)] = "other"
            rows.append((len(rows), " ".join(w)))
    monkeypatch.setattr(jaccard, "CELL_A", 3)
    monkeypatch.setattr(jaccard, "CELL_B", 4)
    want = components(rows, 3, 90)
    got = by_id(jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want


def test_groups_in_a_chain_send_only_sets_that_may_link(spark, monkeypatch, tmp_path):
    """Unlike texts that share passages in a chain: their groups overlap, so all hang together, yet only the near copies among them may link."""
    import random
    import uuid

    rnd = random.Random(5)
    passages = [[f"p{i}x{k}" for k in range(30)] for i in range(13)]
    rows = []
    for i in range(12):
        for v in range(5):
            rows.append((len(rows), " ".join(passages[i] + [f"u{i}x{v}x{k}" for k in range(25)] + passages[i + 1])))
    for i in (12, 31, 48):                                      # near copies, each twice, that need not meet a leader
        for _ in range(2):
            w = rows[i][1].split()
            w[rnd.randrange(len(w))] = "other"
            rows.append((len(rows), " ".join(w)))
    plain, folder = jaccard._cell, str(tmp_path)

    def counted(percent):
        product = plain(percent)

        def of(one, other):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(len(one) + len(other)))
            return product(one, other)

        return of

    monkeypatch.setattr(jaccard, "_cell", counted)
    monkeypatch.setattr(jaccard, "CELL_A", 3)
    monkeypatch.setattr(jaccard, "CELL_B", 4)
    got = by_id(jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80))
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == components(rows, 5, 80)
    assert sum(int(p.read_text()) for p in tmp_path.iterdir()) <= 2 * len(rows)


def test_rows_that_surely_stay_are_not_shuffled(spark, monkeypatch):
    """Also where too many ids are gone for a broadcast: only rows that may be gone reach the join."""
    rows = [(i, f"t{i} " * 3 + " ".join(f"w{i}x{k}" for k in range(20))) for i in range(3000)]
    rows += [(i + 5000, rows[i][1]) for i in range(40)] + [(None, rows[0][1])]
    seen, plain = [], jaccard._slot
    monkeypatch.setattr(jaccard, "_slot", lambda *a: seen.append(a) or plain(*a))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
        assert sorted(r.doc_id for r in out.collect() if r.doc_id is not None) == list(range(3000))
        assert out.where("doc_id is null").count() == 1
        plan = out._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.startswith("Union") and plan.count("LeftAnti") == 1 and seen


def test_one_of_each_keeps_rows_whole(odd_docs, odd_rows):
    out = jaccard.one_of_each(odd_docs)
    want = {i for i, (_, c) in components(odd_rows, 3, 90).items() if c == i}
    assert out.columns == odd_docs.columns
    assert {r.doc_id for r in out.collect()} - {None} == want


def test_rules(odd_docs, odd_rows):
    got = by_id(quality_rules.quality_report(odd_docs))
    for i, t in odd_rows:
        w, t = words(t), t or ""
        grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        times = Counter(grams)
        repeat = {q for k, g in enumerate(grams) if times[g] > 1 for q in (k, k + 1, k + 2)}
        lines, seen = 0, set()
        for line in t.split("\n"):
            if words(line):
                lines += line in seen
                seen.add(line)
        failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), lines, len(repeat), failed), i
        assert not (r.kept and r.base_failed)


def test_kept_against_zstandard(spark, odd_rows):
    import random

    import zstandard

    rnd = random.Random(5)
    noise = ["".join(chr(rnd.randrange(0x4E00, 0x9000)) for _ in range(12)) for _ in range(600)]
    prose = [rnd.choice(["the", "river", "town", "walks", "along", "bright", "cold", "stone"]) + rnd.choice(["", "s", "ed", "ing"]) + str(rnd.randrange(300))
             for _ in range(6000)]
    rows = [(i, t or "") for i, t in odd_rows if i < 80] + [
        (100 + k, " ".join(prose[:60 * k] + noise[:30 * k] + prose[60 * k:200 * k])) for k in range(1, 20)] + [
        (200 + k, " ".join(prose[:20 * k])) for k in range(3, 60, 4)]

    def passes(data):
        def inside(part, bands):
            low, high = next((lo, hi) for most, lo, hi in bands if len(part) <= most)
            return low <= len(part) / len(zstandard.ZstdCompressor(level=3).compress(part)) <= high

        if not data:
            return True
        parts = [data[at:at + 4096] for at in range(0, len(data), 4096)] if len(data) > 4096 else []
        if parts and len(parts[-1]) < 256:                       # a short end belongs to the chunk before it
            parts[-2:] = [parts[-2] + parts[-1]]
        judged = [inside(p, quality_rules.BANDS) if len(p) <= 4096 else 1.5 <= len(p) / len(zstandard.ZstdCompressor(level=3).compress(p)) <= 4.2 for p in parts]
        return inside(data, quality_rules.BANDS) and judged.count(False) < max(1, 0.3 * len(judged))

    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(quality_rules.quality_report(docs))
    want = {i: not got[i].base_failed and passes(t.encode()) for i, t in rows}
    assert {i: got[i].kept for i in want} == want
    assert {k for i, k in want.items() if not got[i].base_failed} == {True, False}
    assert {r.doc_id for r in quality_rules.passing(docs).collect()} == {i for i, k in want.items() if k}


def test_short_texts_are_judged_too(spark):
    """Fifty words fit in 99 bytes; such texts have a band of their own."""
    import random

    rnd = random.Random(3)
    prose = " ".join(rnd.choice("the of and to in is it he was for on are as with his at be by or".split()) for _ in range(58))
    noise = " ".join("".join(chr(rnd.randrange(33, 127)) for _ in range(3)) for _ in range(60))
    loop = ("ab cd ef " * 25).strip()
    more = "".join(chr(rnd.randrange(97, 110)) if rnd.random() < 0.8 else " " for _ in range(4096 + 100))
    docs = spark.createDataFrame([(1, prose), (2, noise), (3, loop), (4, more)], "doc_id long, text string")
    got = by_id(docs.select("doc_id", quality_rules.judged(docs["text"]).alias("q")).select("doc_id", "q.*"))
    assert max(len(x) for x in (prose, noise, loop)) < 256
    assert 1.2 <= got[1].ratio <= 2.6 and got[1].kept and got[2].ratio < 1.2 and not got[2].kept and not got[3].kept and got[3].ratio > 2.6
    assert got[4].n_chunks == 1


def test_bands_tell_noise_and_repetition_from_prose(spark):
    import random

    rnd = random.Random(4)
    syllables = ["ra", "ken", "tol", "mi", "sta", "vo", "ner", "lu", "pa", "ing"]
    prose = " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(900))
    noise = " ".join("".join(chr(rnd.randrange(0x4E00, 0x9000)) for _ in range(12)) for _ in range(300))
    loop = " ".join(f"{rnd.choice(syllables)} tail of the same long sentence number one" for _ in range(600))
    docs = spark.createDataFrame([(1, prose), (2, noise), (3, loop)], "doc_id long, text string")
    got = by_id(quality_rules.quality_report(docs))
    assert got[1].kept and not got[2].kept and not got[3].kept
    assert [r.doc_id for r in quality_rules.passing(docs).collect()] == [1]


def test_empty_tables(no_docs):
    assert substring.repeat_digests(no_docs).count() == 0
    assert substring.remove_repeats(no_docs).count() == 0
    assert jaccard.similar_groups(no_docs).count() == 0
    assert quality_rules.quality_report(no_docs).count() == 0


def test_shingle_bounds():
    """A pair of a size and a larger partner never differs in more shingles than assumed, and blocks exceed that."""
    for percent in (80, 90):
        links = defaultdict(int)
        for a in range(1, 120):
            for b in range(a, 160):
                both = -(-percent * (a + b) // (100 + percent))
                if both <= a:
                    links[a] = max(links[a], a + b - 2 * both)
        for a, most in links.items():
            assert most <= jaccard.most_differences(a, percent)
            assert jaccard.needed(most, percent) >= most + 2


def test_packed_keys_meet_in_one_partition_and_lose_nothing(spark):
    import numpy as np
    import pyarrow as pa
    from pyspark.sql import functions as F

    from panelwright.llm import jaccard

    rng = np.random.default_rng(4)
    key = np.concatenate([rng.integers(-2 ** 63, 2 ** 63 - 1, 5000), np.full(300, 77 << 40), [-1, 0, 2 ** 63 - 1]]).astype(np.int64)
    s1 = rng.integers(-2 ** 63, 2 ** 63 - 1, len(key)).astype(np.int64)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(key, s1, strict=True)], "key long, s1 long").repartition(3)
    parts = jaccard._parts(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert 0.8 * n <= len(parts) <= n
    packed = df.mapInArrow(jaccard._packed_keys(lambda stream: stream, parts), "part int, n int, cells binary")
    assert packed.select(F.sum(F.octet_length("cells"))).first()[0] == 14 * len(key)     # a row a key takes 16 bytes and its own overhead
    opened = packed.repartition("part").mapInArrow(jaccard._opened_keys, "key long, s1 long").withColumn("at", F.spark_partition_id()).collect()
    want = sorted(zip(((key.view(np.uint64) >> np.uint64(16)).astype(np.int64)).tolist(), s1.tolist(), strict=True))
    assert sorted((r["key"], r["s1"]) for r in opened) == want
    where = {}
    for r in opened:
        where.setdefault(r["key"], set()).add(r["at"])
    assert all(len(w) == 1 for w in where.values())
    empty = next(iter([b for b in jaccard._packed_keys(lambda stream: stream, parts)([])]), None)
    assert empty is None and isinstance(jaccard.PACKED, pa.Schema)
