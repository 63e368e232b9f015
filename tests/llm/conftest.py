import random
import re

import pytest

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, key STRING, row INT, size STRING, score STRING"


def words(text):
    return WORD.findall((text or "").encode())


@pytest.fixture(scope="session")
def corpus():
    """Rows of documents with nulls, empty and long texts, ties, copies, near copies, passages, and clashing extra columns."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage, long = prose(70), prose(20_000)
    texts = [prose(rng.randint(1, 150)) for _ in range(40)]
    texts += [f"{prose(20)}\n{passage}\t{prose(30)}" for _ in range(6)] + [f"{passage} {passage}"]
    texts += [None, "", "   \n\t", None, " ", "x", "X", "a b", long, long + " end", prose(49), passage[:-3]]
    texts += [texts[0], texts[1].upper(), texts[1] + " ", texts[2] + " more", " ".join(["same"] * 120), " ".join(["same"] * 90)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(i, t, None if i % 7 == 0 else "en", [None, "b", "a", "Z", "é", "b"][i % 6]) for i, t in zip(ids, texts)]
    rows += [rows[5], rows[5], (rows[6][0], "another text under the same id", "en", "b"), (None, "no id at all", None, None), (None, None, None, "a")]
    return [(*r, None if i % 5 == 0 else i, "k", 1, "s", None) for i, r in enumerate(rows)]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
