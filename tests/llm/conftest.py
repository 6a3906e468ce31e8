import os

import pytest

SF = "/root/testdata/sf0.001"
ODD_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key long, size long, node long, item long, word string, "
              "slot long, part int, start long, n long, hash long, label double, domain string, row_id long, target double")


def odd_documents(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(40_000))
    base = "the quick brown fox jumps over the lazy dog and runs far away from here to there " * 6
    secret = 'please use token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b" for the api'
    rows = [
        (0, base, "en", "a"), (1, base, "en", "a"), (1, base, "en", "a"), (2, base + "and one more", "en", None), (3, None, "en", "b"), (4, "", None, "b"),
        (5, " \n\t ", "en", "b"), (None, "a short text", None, None), (None, "a short text", None, None), (6, long, "en", "a"), (7, "x", "en", "c"),
        (8, secret, "en", "c"), (9, "ÄÖÜ straße été ñandú", "de", "é"), (10, "ÄÖÜ straße été ñandú", "fr", "é"), (11, base[:250], "en", "c"), (12, "!!! ### 123", "xx-YY", "c"),
    ]
    return spark.createDataFrame(
        [(i, t, lang, s, None if t is None else len(t), 7, None, 3, 1, "the", 2, 0, 5, 6, 7, 0.5, "dom", 1, 2.0) for i, t, lang, s in rows], ODD_SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    return odd_documents(spark).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(os.path.join(SF, "documents.parquet"))
