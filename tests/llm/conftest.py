import random

import duckdb
import pytest

WORDS = [a + b for a in "ba de fi go ku la me no pu ra si ta vo we xi".split() for b in "n r s th ck".split()]


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, columns with clashing names."""
    long = prose(1, 60_000)
    rows = [
        (1, prose(2, 80), "en", "s", 1, 0.1, 7),
        (2, prose(2, 80), "en", "s", 1, 0.1, 7),
        (2, prose(2, 80), "en", "s", 1, 0.1, 7),
        (2, prose(3, 60), None, None, None, None, None),
        (None, prose(4, 90), "en", "s", 1, 0.1, 7),
        (None, None, None, None, None, None, None),
        (3, None, "en", "s", 1, 0.1, 7),
        (4, "", "en", "s", 1, 0.1, 7),
        (5, " \n\t\n ", "en", "s", 1, 0.1, 7),
        (6, long, "en", "s", 1, 0.1, 7),
        (7, "one two", "en", "s", 1, 0.1, 7),
        (8, "one two", "en", "s", 1, 0.1, 7),
        (9, "für Öl – 日本語 \U0001f600\nfür Öl – 日本語 \U0001f600 mehr", "de", "s", 1, 0.1, 7),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, node long"
    return spark.createDataFrame(rows, schema).coalesce(2)


@pytest.fixture(scope="session")
def documents(folder):
    return duckdb.execute(f"SELECT doc_id, text FROM '{folder}/documents.parquet' ORDER BY doc_id").fetchall()
