"""The registered queries of the operators, and their DuckDB oracles where SQL
can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmart.session import scratch_path

from . import (alignment, byte_pairs, decontamination, fingerprints, jaccard_join, lm_scoring, oracles, packing, pii, quality,
               sharding, spelling, token_counts, token_files)
from .common import read_table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {"op6_jaccard_join": oracles.JACCARD_JOIN, "op7_decontamination": oracles.DECONTAMINATION}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


#: The files' folder is the installed package's on every executor.
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and greedy longest-match pieces of every whole text."""
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), WORD_VOCABULARY)


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 ids."""
    return packing.pack(read_table(spark, sf_dir, "documents"), BYTE_VOCABULARY, added=True).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-log-likelihood of every whole text, by a network trained on all of them."""
    docs = read_table(spark, sf_dir, "documents")
    return lm_scoring.score(docs, *lm_scoring.train(docs))


@query
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written as Arrow files and read back from them."""
    path = scratch_path(spark, "token-files")
    token_files.write(read_table(spark, sf_dir, "documents"), WORD_VOCABULARY, path, added=True)
    return token_files.read(spark, path)


@query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    return sharding.shard(read_table(spark, sf_dir, "documents"))


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by 3-word shingles at 0.9."""
    return jaccard_join.join(read_table(spark, sf_dir, "documents"))


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words hit in every whole text."""
    return decontamination.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("row")


@query
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and its edited text."""
    return fingerprints.fingerprint_edits(read_table(spark, sf_dir, "documents"))


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text, by a network fitted on its labels."""
    docs = read_table(spark, sf_dir, "documents")
    return quality.judged(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole text: counts, base digest, all spans."""
    return pii.detect(read_table(spark, sf_dir, "documents"))


@query
def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded by merge ranks, and decoded again: digests of both."""
    both = byte_pairs.round_trip(read_table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)
    written = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(written.cast("binary"), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over every whole text, links scored by the corpus's counts."""
    return alignment.link_scores(read_table(spark, sf_dir, "documents"), BYTE_VOCABULARY, PIECE_VOCABULARY)


@query
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents: near words, forms and roots."""
    return spelling.group(read_table(spark, sf_dir, "documents"))
