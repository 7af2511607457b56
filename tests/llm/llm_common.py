import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import pytest

SF_SMALL, SF_MED = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, words int, list string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns with clashing names."""
    long = " ".join(f"word{i % 977} Token{i % 31}" for i in range(30000))
    rows = [(1, None, "en", "a"), (2, "", None, None), (3, " \n\t ", "en", "a"), (4, "one", "en", "a"), (5, "One two", "en", "b"),
            (None, "a b c d e f g h i j k l", None, "a"), (7, long, "de", "a"), (8, long, "de", "a"), (9, long + " end", "de", "a"),
            (10, "same text here now", "fr", "b"), (10, "same text here now", "fr", "b"), (11, "x" * 20000, "en", "a"),
            (12, "été 漢字 ы mail me: jo.12@mail3.example.com or +1 (555) 123-4567", "en", "a"), (None, None, None, None)]
    return spark.createDataFrame([(i, t, lang, s, None, "q", 1, "l") for i, t, lang, s in rows], DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
