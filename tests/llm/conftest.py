from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(20_000))
RUN = "the same passage goes on and on for more than two hundred bytes " * 5


@pytest.fixture(scope="session")
def documents(spark):
    """The small documents, repeated rows, nulls in any column, empty and very long texts, ties."""
    own = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    odd = [
        (900_001, None, "en", "src0", 0),
        (900_002, "", None, None, 0),
        (900_003, " \t\n", "en", "src0", 3),
        (900_004, LONG, "en", "src0", len(LONG)),
        (900_005, LONG + " end", "en", None, len(LONG) + 4),
        (900_006, "a b  c\nd", "en", "src1", 8),
        (900_007, "a b c d", "en", "src1", 7),
        (900_008, "a b c d", "en", "src1", 7),
        (900_008, "a b c d", "en", "src1", 7),
        (900_009, RUN + "then it ends", "fr", "src2", None),
        (900_010, "it begins and " + RUN, "fr", "src2", None),
        (900_011, "x" * 1_000, None, "src2", 1_000),
        (900_012, "12 34 -- 56", "en", "src3", 11),
        (900_013, "École de l'été\nune ligne\nune autre\nla fin", "fr", "src3", None),
        (900_014, "début\nune ligne\nune autre\nautre fin", "fr", "src3", None),
        (900_015, "une ligne\nune ligne\nune ligne\nune ligne", "fr", "src3", None),
        (None, "no id here", "en", "src4", 10),
        (None, None, None, None, None),
    ]
    return own.union(spark.createDataFrame(odd, SCHEMA)).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(documents):
    """The same with more columns, named like those that operators add."""
    return documents.limit(60).select(
        "*", *[F.lit(f"own {c}").alias(c) for c in ("id", "rep", "number", "hash", "carried", "fp", "key", "ids", "block", "score")]
    )


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def collected(documents):
    return documents.collect()
