import random

import pytest

from meterlake.llm.queries import ship

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture()
def documents(spark):
    """A documents table of (doc_id, text) pairs or of whole rows."""

    def make(rows, schema=SCHEMA):
        if rows and schema == SCHEMA and len(rows[0]) == 2:
            rows = [(i, t, "en", "src", len(t or "")) for i, t in rows]
        return spark.createDataFrame(rows, schema).repartition(3)

    return make


@pytest.fixture()
def stored(spark, tmp_path):
    """Write tables as Parquet files in a folder; returns the folder."""

    def make(**tables):
        for name, df in tables.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return make


@pytest.fixture()
def prose():
    """Invented words; the same for the same seed."""

    def make(n, seed=0, words=400):
        rng = random.Random(seed)
        vocabulary = random.Random(7)
        names = ["".join(vocabulary.choice("abcdefghij") for _ in range(vocabulary.randint(2, 8))) for _ in range(words)]
        return " ".join(rng.choice(names) for _ in range(n))

    return make


# Texts at the borders: null, empty, blank, one word, non-ASCII, a very long one, a word without end.
HARD = [
    None,
    "",
    " \t\n\x0b\x0c\r ",
    "one",
    "é",
    "Größe ÄÖÜ 中文 😀 x",
    "word " * 30_000,
    "x" * 50_000,
    "a\n\nb\na\n",
    "<|endoftext|> it's 12 345",
]


@pytest.fixture()
def hard():
    return list(HARD)
