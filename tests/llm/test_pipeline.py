"""The stages of the corpus pipeline and their chain against plain Python, on a small folder of tables."""

import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from panelwright.llm import packing, quality_model, quality_rules
from panelwright.runtime import new_path
from tests.llm.test_text import components, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "with.dot"]


@pytest.fixture(scope="module")
def folder(spark):
    rnd = random.Random(12)
    vocab = ["".join(rnd.choice(["ra", "ken", "tol", "mi", "sta", "vo", "ner", "lu", "pa", "ing"]) for _ in range(rnd.randint(1, 4))) for _ in range(400)]
    passage = [rnd.choice(vocab) for _ in range(90)]
    rows, labels = [], []
    for i in range(220):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(60, 400))]
        if i % 5 == 0:
            w[20:20] = passage[rnd.randint(0, 20):]
        if i % 6 == 1:
            w = [x + rnd.choice(["###", "@@", "%%%"]) for x in w]            # what the labels call bad
        rows.append([i, " ".join(w)])
        labels.append((i, int(i % 6 != 1), 0))
    for i in range(220, 260):                                              # near copies and exact ones
        w = rows[i - 200][1].split()
        if i % 2:
            w[rnd.randrange(len(w))] = "changed"
        rows.append([i, " ".join(w)])
    rows += [[300, None], [301, ""], [302, "short"], [303, " ".join(["again and again"] * 200)], [304, " ".join(rnd.choice(vocab) for _ in range(30_000))],
             [20, rows[20][1]], [None, " ".join(rnd.choice(vocab) for _ in range(120))]]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, `with.dot` int")
    path = new_path(spark, "corpus")
    docs.repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def steps(spark, folder):
    """Input and output of every stage, as lists of rows."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        path = new_path(spark, name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == COLUMNS
        out.append(docs.collect())
    return out


def ids(rows):
    return sorted((r["doc_id"] is None, r["doc_id"]) for r in rows)


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "near_duplicates", "substring_dedup", "packing"]


def test_classifier_stage(spark, folder, steps):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    score = {(r["doc_id"], r["text"]): r["s"] for r in docs.select("doc_id", "text", quality_model.scored(spark, quality_model.fit(docs, labels), docs["text"]).alias("s")).collect()}
    assert ids(steps[1]) == ids([r for r in steps[0] if score[r["doc_id"], r["text"]] >= 0.5])
    bad = {r["doc_id"] for r in steps[0] if r["text"] and r["doc_id"] is not None and r["doc_id"] % 6 == 1 and r["doc_id"] < 220}
    kept = {r["doc_id"] for r in steps[1]}
    assert len(kept & bad) <= 2 and len([i for i in range(220) if i % 6 != 1 and i not in kept]) <= 4


def test_rules_stage(spark, steps):
    verdict = {(r["doc_id"], r["text"]): r["kept"] for r in spark.createDataFrame([(r["doc_id"], r["text"]) for r in steps[1]], "doc_id long, text string").select(
        "doc_id", "text", quality_rules.judged(F.col("text"))["kept"].alias("kept")).collect()}
    assert ids(steps[2]) == ids([r for r in steps[1] if verdict[r["doc_id"], r["text"]]])
    kept = {r["doc_id"] for r in steps[2]}
    assert not kept & {300, 301, 302, 303} and 304 in kept


def test_near_duplicate_stage(steps):
    linked = components([(r["doc_id"], r["text"]) for r in steps[2] if r["doc_id"] is not None], 5, 80)
    want = [r for r in steps[2] if r["doc_id"] is None or linked[r["doc_id"]][1] == r["doc_id"]]
    assert ids(steps[3]) == ids(want) and len(steps[3]) < len(steps[2])
    assert {(r["doc_id"], r["text"]) for r in steps[3]} == {(r["doc_id"], r["text"]) for r in want}


def test_substring_stage(steps):
    first = {}
    for r in steps[3]:
        w = words(r["text"])
        for p in range(len(w) - 49 if r["doc_id"] is not None else 0):
            k = tuple(w[p:p + 50])
            first[k] = min(first.get(k, r["doc_id"]), r["doc_id"])
    want = {}
    for r in steps[3]:
        w = words(r["text"])
        gone = {q for p in range(len(w) - 49) if r["doc_id"] is not None and first[tuple(w[p:p + 50])] < r["doc_id"] for q in range(p, p + 50)}
        want[r["doc_id"]] = " ".join(x for q, x in enumerate(w) if q not in gone) if gone else r["text"]
    assert {r["doc_id"]: r["text"] for r in steps[4]} == want and any(want[r["doc_id"]] != r["text"] for r in steps[3])
    assert all(r["n_chars"] == len(r["text"]) for r in steps[4])


def check_pieces(pieces, texts):
    """Every id of every text once, sequences gapless, within their room, padded to it or to a power of two."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = defaultdict(int)
    for t in texts:
        total[len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1] += 1
    seen, used = defaultdict(int), defaultdict(list)
    parts = defaultdict(int)
    for r in pieces:
        used[r["sequence_id"]].append((r["offset"], r["length"], r["padded_length"]))
        parts[r["doc_tokens"]] += r["length"]
    for n, c in total.items():
        seen[n] = parts[n] == n * c
    assert all(seen.values()) and set(parts) == set(total)
    for own in used.values():
        end = 0
        for offset, length, _ in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048 and {p for *_, p in own} == {end if end & (end - 1) == 0 else 2048}
    lengths = defaultdict(int)
    for r in pieces:
        lengths[r["length"]] += 1
    assert len(used) == sum(c for _, c in packing.shortest_pack_first(lengths))


def test_packing_stage_and_the_whole_chain(spark, folder, steps):
    check_pieces(steps[5], [r["text"] for r in steps[4]])
    chain = corpus_pipeline.run(spark, folder).collect()
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(str([r[c] for c in key]) for r in chain) == sorted(str([r[c] for c in key]) for r in steps[5])
    check_pieces(chain, [r["text"] for r in steps[4]])
    assert np.sum([r["length"] for r in chain]) > 10_000


def test_stages_on_no_rows(spark, folder):
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0, name
