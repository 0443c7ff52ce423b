from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def corpus() -> dict[int, str | None]:
    """Null, empty and blank texts, odd white space, copies, near copies, shared and periodic passages,
    characters of several bytes, and one text that is far longer than the others."""
    rng = random.Random(7)
    texts: dict[int, str | None] = {1: None, 2: "", 3: " \t\n", 4: "one", 5: "Ünïcode  \x0bwörds here\r\n"}
    passage = " ".join(words(rng, 40))
    for i in range(10, 40):
        own = words(rng, rng.randrange(5, 120))
        if i % 3 == 0:
            own[2:2] = passage.split()
        texts[i] = " ".join(own)
    base = words(rng, 200, 5000)
    for i in range(40, 60):
        copy = list(base)
        for _ in range(i - 40):
            copy[rng.randrange(200)] = f"edit{i}"
        texts[i] = " ".join(copy) if i % 2 else "\n".join(copy).upper()
    texts[60] = texts[61] = texts[12]
    texts[62] = "ab " * 300
    texts[63] = "ab " * 200 + "é" * 150
    texts[64] = "x" * 500
    texts[65] = " ".join(words(rng, 30_000, 3000))
    texts[66] = texts[65][5000:9000]
    texts[-5] = texts[20]
    return texts


@pytest.fixture(scope="session")
def frame(spark):
    """Rows as a table with the columns of documents and others whose names operators use inside."""

    def make(texts: dict[int, str | None], twice: bool = False):
        rows = [(i, t, None, "s", None) for i, t in texts.items()]
        rows += rows[:3] + [(None, "no id at all", None, None, None)] if twice else []
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        return df.selectExpr("*", "1 AS spans", "'x' AS kept", "2 AS shard", "3 AS marks", "doc_id AS a", "4 AS n_words")

    return make
