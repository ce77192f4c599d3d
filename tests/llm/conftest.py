import random

import pytest

SCHEMA = ("doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, "
          "piece STRING, score STRING, ids STRING, k1 STRING, label STRING, `_gone` STRING, deduped STRING, n STRING")


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    syllables = "an ba co du el fi go hu in jo ka lu me no".split()
    text = " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(words))
    return text.capitalize() + "."


MESSY = [
    (1, prose(1, 120)), (2, prose(1, 120)), (2, prose(1, 120)), (3, None), (4, ""), (None, prose(2, 60)), (5, " \n\t \n"),
    (6, "line\n" * 30), (7, "x" * 20_000), (8, "é中\U0001f642 a@b.com  +1 (743) 555-3824\n\n 4111 1111 1111 1111"),
    (9, "word " * 5000), (None, None),
]


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and long texts, repeated rows, and further columns named like working columns."""
    rows = [(i, t, "en", "s", 0 if t is None else len(t), *["x"] * 8) for i, t in MESSY]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
