import hashlib
import re

import pytest

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="session")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing column names."""
    long = " ".join(f"w{i % 700}x" for i in range(60_000))
    rows = [(1, None, "en", "a", 1), (2, "", None, None, None), (3, " \n\t ", "en", "b", 2), (4, "one two", "fr", "c", 3),
            (5, long, "en", "d", 4), (6, long, "en", "e", 5), (7, "Only ünï çödé 日本 12 kg", None, "f", 6),
            (7, "Only ünï çödé 日本 12 kg", None, "f", 6), (8, "123 !!! 456", "de", "g", 7),
            (9, " ".join(f"t{i}" for i in range(40)), "es", "h", 8), (10, " ".join(f"t{i}" for i in range(41)), "es", "h", 8)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int")
