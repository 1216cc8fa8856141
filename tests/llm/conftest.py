import random

import pytest

ODD = [None, "", " ", "\n\t ", "one", "two words", "É à ü ß", "a\x0bb\x0cc\rd", "x" * 3000, "the </s> [INST] text <|endoftext|> \x1d\x85\xa0 end"]


@pytest.fixture(scope="session")
def odd_rows():
    """Ids with nulls, repeated rows, copies, shared passages, ties and one long text."""
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(80)]
    passage = [rnd.choice(vocab) for _ in range(70)]
    rows = [(i, t) for i, t in enumerate(ODD)]
    for i in range(len(ODD), 60):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(1, 160))]
        if i % 4 == 0:
            at = rnd.randrange(len(words))
            words[at:at] = passage[rnd.randint(0, 10):]
        rows.append((i, rnd.choice([" ", "  ", "\n"]).join(words)))
    for i in range(60, 75):
        words = (rows[i - 30][1] or "").split()
        if words and i % 2:
            words[rnd.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words)))
    rows += [(80, rows[20][1]), (80, rows[20][1]), (81, " ".join(passage * 300))]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The same as a table with further columns whose names the operators use inside."""
    rows = [(i, t, "en", i, 1, "k", 0.5) for i, t in odd_rows] + [(None, "a null id " * 40, "en", 0, 1, "k", 0.5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n long, label int, key string, score double").repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, n_chars long")
