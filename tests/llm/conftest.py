import numpy as np
import pytest


@pytest.fixture
def rng():
    return np.random.default_rng(7)


@pytest.fixture
def hostile(spark):
    """Rows with nulls, empty and long texts, repeated rows and ids, and extra columns with awkward names."""
    long = " ".join(f"word{i % 97} of the" for i in range(30_000))
    rows = [(1, "The cat sat on the mat and the dog ran to the park.", "en", "text", 1), (2, None, "en", "id", 2),
            (3, "", None, None, 3), (None, "a text without an id", "fr", "x", 4), (5, long, "de", "y", 5),
            (1, "The cat sat on the mat and the dog ran to the park.", "en", "text", 1), (6, "  \n\t ", "en", "z", 6),
            (7, "é ß 日本語 👍 ́ x", "es", "w", 7), (8, "!!! ... ###", "en", "v", 8)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, `fp` string, n_chars bigint")


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
