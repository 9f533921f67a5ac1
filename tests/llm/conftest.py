import zlib

import pytest

import __spark_entry__ as entry

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and very long texts, ties, repeated rows, and a column named like an output."""
    base = "the quick brown fox jumps over the lazy dog and runs far away from all the other animals in the green forest today"
    rows = [
        (1, base, "en", 9), (2, base, "en", 9), (2, base, "en", 9), (3, base.upper() + " Again.", "en", 9),
        (4, None, "en", 9), (5, "", None, 9), (6, " \n\t", "de", 9), (7, LONG, "de", 9), (8, LONG + " end", None, 9),
        (None, "ein kleiner Text über Äpfel und Öfen", "de", 9), (9, "12 34 !!", "en", 9), (10, "x", "en", 9),
        (11, "don't it's 中文 <|endoftext|>  a\n\n b ", "en", 9), (12, "aaaa " * 300, "en", 9),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, score int")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module")
def query(spark):
    return lambda name: entry.queries()[name](spark, "/root/testdata/sf0.001").collect()


@pytest.fixture(scope="session")
def remainder():
    return lambda key, modulus: zlib.crc32(b"" if key is None else str(key).encode()) % modulus
