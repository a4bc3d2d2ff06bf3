import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, n_words string, set_id string, shard string, _key string, record string, kept string"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns named like the operators' own."""
    rng = random.Random(5)
    long = " ".join(f"w{rng.randint(0, 4000)}" for _ in range(30_000))
    clean = " ".join(f"word{rng.randint(0, 900)}" + ("." if k % 9 == 8 else "") for k in range(80))
    rows = [
        (1, clean, "en", "a", len(clean)), (2, clean, "en", "a", len(clean)), (2, clean, "en", "a", len(clean)), (3, None, None, None, None), (4, "", "en", "a", 0),
        (None, clean, "en", "a", 1), (None, None, None, None, None), (5, long, "de", "b", len(long)), (6, " \t\n\r\x0b\x0c", "fr", "c", 6), (7, "one two", "fr", "c", 7),
        (8, "   ﻿ émigré STRASSE ß 日本語 😀", "de", None, None), (9, clean + " more", "en", None, None),
    ]
    return [(*r, "x", "x", "x", "x", "x", "x", None) for r in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
