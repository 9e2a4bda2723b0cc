"""Documents with everything that may go wrong in them."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use themselves.
CLASHES = ["score", "row", "key", "n", "label", "print", "component", "held_out", "hash", "word", "line", "dropped", "piece", "tokens"]


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(n))


def odd_rows() -> list[tuple]:
    long = words(1, 6000)
    return [
        (1, words(2, 60), "en", "a", 1),
        (2, words(2, 60), "en", "a", 1),
        (2, words(2, 60), "en", "a", 1),
        (3, None, "en", None, None),
        (4, "", None, "a", 0),
        (5, " \t\n\r\f\v ", "de", "a", 3),
        (None, words(3, 40), None, None, None),
        (None, None, None, None, None),
        (6, long, "en", "b", len(long)),
        (7, "Ünï © 日本語 🙂 Don't  stop\n\nNOW <|endoftext|> x", "xx", "b", 1),
        (8, "one", "en", "b", 3),
        (9, "one\ntwo", "en", "b", 7),
        (10, words(2, 59) + " other", "en", "c", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns whose names clash."""
    frame = spark.createDataFrame(odd_rows(), SCHEMA)
    return frame.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="session")
def none(spark):
    """No documents at all."""
    return spark.createDataFrame([], SCHEMA)
