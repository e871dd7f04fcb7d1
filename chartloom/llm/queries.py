"""The numbered operators as queries over the whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from chartloom.llm import bitslices, chat, combinations, imatch, langid, mixing, packing, pieces, probminhash, quality, superkmer, toxicity, whitening
from chartloom.llm.cluster import ship
from chartloom.llm.oracles import SQL  # noqa: F401


#: Where the vocabularies lie, on the driver and on every executor.
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"))


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.report(_table(spark, sf_dir, "documents"))


def op4_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(_table(spark, sf_dir, "documents"))


def op5_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_copies(_table(spark, sf_dir, "documents"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(_table(spark, sf_dir, "documents"), PIECE_MODEL)


def op7_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmer.report(_table(spark, sf_dir, "documents"))


def op8_convolutional_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op9_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_probe(spark, _table(spark, sf_dir, "conversations"))
    return chat.report(chat.expand(turns))


def op10_recurrent_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(_table(spark, sf_dir, "documents"))


def op11_bit_sliced_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslices.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_token_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = combinations.join(_table(spark, sf_dir, "documents"))
    return joined.select("doc_id", "n_shingles", "component_id")


def op13_qd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_packed_ids": op1_packed_ids,
    "op2_quality_rules": op2_quality_rules,
    "op3_imatch": op3_imatch,
    "op4_entropy_balancing": op4_entropy_balancing,
    "op5_probminhash": op5_probminhash,
    "op6_pieces": op6_pieces,
    "op7_super_kmers": op7_super_kmers,
    "op8_convolutional_toxicity": op8_convolutional_toxicity,
    "op9_prefix_targets": op9_prefix_targets,
    "op10_recurrent_language_id": op10_recurrent_language_id,
    "op11_bit_sliced_search": op11_bit_sliced_search,
    "op12_token_combinations": op12_token_combinations,
    "op13_qd_whitening": op13_qd_whitening,
}
