import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, tied ids, and columns whose names operators use inside."""
    long = " ".join(f"w{i % 977} and" for i in range(20_000))
    rows = [
        (1, "the cat sat on the mat with a hat and a bat in the old red barn today", "en", "a", 1),
        (1, "the cat sat on the mat with a hat and a bat in the old red barn today", "en", "a", 1),
        (2, None, None, None, None), (3, "", "en", "a", 0), (4, " \n\t ", "fr", None, 4), (None, "no id but words enough to fill a line of ten words", None, "b", None),
        (5, long, "en", "a", len(long)), (6, long, "en", "b", len(long)), (7, "x", "de", "c", 1), (8, "!!! 123", "de", "c", 7),
        (9, "Ünï çödé — 中文 😀", "fr", "c", 17), (9, "another text under the same id", "fr", "c", 30),
    ]
    return spark.createDataFrame([(*r, 7, "k", 0) for r in rows], DOCUMENTS + ", _b int, fp string, n_hit int")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)
