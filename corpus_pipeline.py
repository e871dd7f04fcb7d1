"""Corpus cleaning: each stage works on what its predecessor kept.

Nulls, in any column: a null text counts as empty, a null id or source as one of its own, and both are
carried. Ids are whole numbers. Repeated rows are rows of their own until the second stage, which keeps one of
equal texts. Ties go to the smallest id, then to the text. Very long texts are worked on whole. An empty table
gives an empty result, with the same columns. Other columns, whatever their names, are carried by all stages but
the last, which returns its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm import mixing, pieces, probminhash, quality, superkmer
from chartloom.llm.cluster import ship
from chartloom.llm.queries import PIECE_MODEL
from chartloom.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the fences of their language and source. Rows of null or empty text
    go, as they have fewer than ten words."""
    ship(spark)
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the row with the smallest id; a null id comes after all others."""
    ship(spark)
    return probminhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has as well. A text that loses all its
    words goes; one that loses none stays byte for byte."""
    ship(spark)
    return superkmer.remove_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them, none to two times; equal rows share their copies."""
    ship(spark)
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and ids of each row; a null text has no ids."""
    ship(spark)
    encoded = pieces.encode(docs.select("doc_id", "lang", "source", "text"), PIECE_MODEL)
    return encoded.select("doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode_pieces),
]

#: Sketches, signatures, greedy rounding and merge encoding have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
