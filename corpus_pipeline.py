"""A training corpus in stages: each reads what the one before it wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.exact_dedup import drop_exact_copies
from quarry.llm.language_id import UNKNOWN, identify, network_of
from quarry.llm.mixing import in_mixed_order
from quarry.llm.simhash import drop_near_copies
from quarry.llm.tokens import decode, encode
from quarry.session import scratch_path

#: A document whose best language is less likely than this is in none of them.
LEAST_SCORE = 0.3
RANKS = "byte_bpe_multi_50k.tiktoken"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; those without letters, or in no language, go."""
    found = identify(docs, network_of(docs))
    stays = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return stays.select("carried.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints link at 4 or fewer bits the one with the smallest doc_id stays."""
    return drop_near_copies(docs, radius=4)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order of the mix: sources weigh the square root of their supply while it lasts."""
    return in_mixed_order(docs, exponent=0.5)


def with_place(docs: DataFrame) -> DataFrame:
    """``mix_part`` and ``mix_row``: the file, by its number, and the row in it that hold each document.

    Sorted by them the documents are in the order in which they were written. A table that is not read from files has
    its rows numbered as they come.
    """
    if docs.inputFiles():
        number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1)
        return docs.withColumns({"mix_part": number.try_cast("long"), "mix_row": F.col("_metadata.row_index")})
    place = F.monotonically_increasing_id()
    return docs.withColumns({"mix_part": F.shiftright(place, 33), "mix_row": place.bitwiseAND((1 << 33) - 1)})


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of each text (little-endian unsigned 32-bit integers), and whether they decode to its bytes.

    Sorted by ``mix_part`` and ``mix_row`` the rows are the mixed stream.
    """
    ranks, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    docs = with_place(docs.select("doc_id", "text", "lang", "source"))
    encoded = encode(docs, "text", ranks, pattern).select("carried.*", "n_tokens", F.col("ids").alias("tokens"))
    decoded = decode(encoded, "tokens", ranks, pattern)
    text = F.coalesce(F.col("carried.text"), F.lit("")).cast("binary")
    return decoded.select(
        *[f"carried.{c}" for c in ("doc_id", "lang", "source", "mix_part", "mix_row", "n_tokens", "tokens")],
        (F.col("decoded") == text).alias("exact"),
    )


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("pfair_mixing", mixing),
    ("byte_bpe", tokens),
]

#: SQL cannot express the network, the fingerprints' components, the schedule and the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
