"""Classifiers: held-out accuracy on data with a known rule, folds, edge cases."""

import random
import zlib

import numpy as np
import pytest

from panelwright.llm import quality_model, toxicity


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(6)
    vocab = [f"word{i}" for i in range(150)]
    docs, labels = [], []
    for i in range(900):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(20, 90))]
        bad, toxic = i % 4 == 0, i % 5 == 0
        if bad:
            w = [x + rnd.choice(["###", "%%%"]) for x in w]
        if toxic:
            for _ in range(3):
                w[rnd.randrange(len(w))] = rnd.choice(["vile", "awful", "nasty"])
        docs.append((i, " ".join(w), "x", 1))
        labels.append((i, int(not bad), int(toxic)))
    docs += [(900, None, "x", 1), (901, "", "x", 1), (None, "word1 word2", "x", 1)]
    labels += [(950, 1, 0), (3, None, None), (None, 1, 1)]
    return (spark.createDataFrame(docs, "doc_id long, text string, label string, score int"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


@pytest.mark.parametrize(("score", "column", "at"), [(quality_model.score_quality, 1, 0.5), (toxicity.score_toxicity, 2, 0.7)])
def test_learns_what_it_has_not_seen(corpus, score, column, at):
    docs, labels = corpus
    truth = {r[0]: r[column] for r in labels.collect() if r[column] is not None}
    rows = score(docs, labels).collect()
    assert len(rows) == docs.count()
    held = [(r, truth[r.doc_id]) for r in rows if r.doc_id in truth and r.held_out and r.doc_id is not None]
    assert np.mean([r.predicted == y for r, y in held]) > 0.97
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= at)
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_held_out_labels_are_not_learnt(corpus, spark):
    docs, labels = corpus
    wrong = labels.selectExpr("doc_id", "quality", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - toxic, toxic) as toxic")
    a = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    b = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, wrong).collect()}
    assert a == b


def test_accepted_keeps_columns(corpus):
    docs, labels = corpus
    out = quality_model.accepted(docs, labels)
    assert out.columns == docs.columns and 0 < out.count() < docs.count()


def test_no_rows_and_no_labels(corpus, no_docs):
    docs, labels = corpus
    none = labels.limit(0)
    assert quality_model.score_quality(no_docs, labels).count() == 0
    assert toxicity.score_toxicity(no_docs, labels).count() == 0
    assert {r.score for r in quality_model.score_quality(docs, none).collect()} != set()
    assert {r.score for r in toxicity.score_toxicity(docs, none).collect()} == {0.5}


def plain_weights(samples, y, share):
    """FTRL-proximal, one coordinate after the other."""
    z, n, zb, nb, bias = {}, {}, 0.0, 0.0, 0.0

    def weight(i):
        if abs(z.get(i, 0.0)) <= toxicity.L1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * toxicity.L1) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for cells, label, s in zip(samples, y, share, strict=True):
            w = {i: weight(i) for i in cells}
            total = max(-35.0, min(35.0, sum(w.values()) + bias))
            g = s * (1 / (1 + np.exp(-total)) - label)
            for i in cells:
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - ((old + g * g) ** 0.5 - old ** 0.5) / toxicity.ALPHA * w[i]
                n[i] = old + g * g
            zb += g - ((nb + g * g) ** 0.5 - nb ** 0.5) / toxicity.ALPHA * bias
            nb += g * g
            bias = -zb / ((toxicity.BETA + nb ** 0.5) / toxicity.ALPHA)
    return {i: weight(i) for i in z if weight(i)}, bias


def test_weights_equal_plain_ftrl():
    rnd = random.Random(1)
    samples = [np.unique([rnd.randrange(40) for _ in range(rnd.randint(0, 12))]).astype(int) for _ in range(120)]
    y = np.array([float(3 in s or 7 in s) for s in samples])
    share = np.where(y == 1, 1.5, 0.75)
    used, weights, bias = toxicity.train(samples, y, share)
    want, want_bias = plain_weights([s.tolist() for s in samples], y, share)
    assert set(used.tolist()) == set(want) and abs(bias - want_bias) < 1e-9
    assert all(abs(w - want[i]) < 1e-9 for i, w in zip(used.tolist(), weights, strict=True))


@pytest.mark.parametrize("model", [quality_model, toxicity])
def test_repeated_rows_are_learnt_once(corpus, spark, model):
    """An id that many rows share counts once, in whatever order the rows come."""
    docs, labels = corpus
    again = docs.where("doc_id in (0, 1, 2, 15)")
    more = docs
    for _ in range(5):
        more = more.unionByName(again)
    score = model.score_quality if model is quality_model else model.score_toxicity
    if model is toxicity:                                                  # its features do not depend on the corpus
        a, b = ({r.doc_id: r.score for r in score(d, labels).collect()} for d in (docs, more.repartition(7)))
        assert a == b
    assert score(more, labels).count() == more.count()


def test_the_sample_is_bounded_in_features(corpus):
    docs, labels = corpus
    used, _, _ = toxicity.fit(docs, labels, most_features=2000)
    everything, _, _ = toxicity.fit(docs, labels)
    assert 0 < len(used) < len(everything)
