"""From raw documents to packed training sequences, in four stages.

Each stage reads what its predecessor kept, from a written table. All but the
last return the columns of ``documents``; other columns pass through. The
stages hand rows to Python workers in small batches, a setting of the session.
"""

from __future__ import annotations

import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from questlog.llm import packing, simhash, substrings, toxicity
from questlog.llm.blocks import small_batches
from questlog.session import materialise

SHINGLE_WORDS, DIFFERING_BITS = 4, 4
REPEATED_BYTES = 400
SEQUENCE_TOKENS = 2048


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from ``labels`` outside the held-out fifth.

    Null and empty texts score as texts without words; repeated rows and rows
    with a null id are judged like others.
    """
    small_batches(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.toxicity_score(model, F.col("text")) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash, that of the smallest id; texts without words are one group."""
    small_batches(spark)
    return simhash.keep_one(docs, shingle=SHINGLE_WORDS, distance=DIFFERING_BITS)


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without the strings of 400 bytes that come again.

    A character that is cut through goes too. ``n_chars`` counts what is left;
    a null text becomes empty, and so does one that is all repeats.
    """
    small_batches(spark)
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    cut = substrings.remove_repeats(docs.select(F.struct(*others).alias("row"), "text"), REPEATED_BYTES, id_col="row", whole_characters=True)

    @F.pandas_udf("string")
    def whole_characters(kept: pd.Series) -> pd.Series:
        return kept.map(lambda raw: raw.decode(errors="ignore"))

    cut = cut.select("row.*", whole_characters("kept").alias("text")).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select([F.col(f"`{c}`") for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of at most 2048 tokens."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), SEQUENCE_TOKENS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeated_strings),
    ("packing", pack_sequences),
]

# No SQL: stages learn, link over chains and pack; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
