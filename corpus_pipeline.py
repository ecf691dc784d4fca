"""A corpus from raw documents: language, near-duplicates, repeated passages, mixture, piece ids.

Each stage takes the documents that its predecessor kept and returns them with the same columns; the last one
returns piece ids in place of texts. Intermediate results are written and read again, so a lost executor costs
no more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from coursetrail.llm import mixing, pieces, ppm, simhash, substrings
from coursetrail.llm.queries import table, tokenizer_file
from coursetrail.session import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be told; texts without a letter go."""
    return ppm.in_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked at 4 or fewer differing bits, of shingles of four words."""
    return simhash.without_near_duplicates(docs, shingle=4, budget=4)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words or more that occur twice."""
    return substrings.without_repeats(docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and those of small sources again, at most twice in all, towards equal sources."""
    return mixing.mixed(docs, entropy=1.0, repeat=2.0, budget="whole")


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their pieces in place of the text."""
    return pieces.encode(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("source_mixture", source_mixture), ("piece_ids", piece_ids)]

# SQL cannot express the stages; tests hold them against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
