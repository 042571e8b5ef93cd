"""The corpus pipeline: documents through five stages, each written and reread.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  All but the last return the columns of ``documents``.

Cases, whatever the stage: null and empty texts pass the filters they can't
fail (an empty text is judged by the classifier like any other), a null id is
kept by the joins, repeated rows of one id and text stand or fall together, and
a table without rows gives one without rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortmart.llm import common, decontamination, jaccard_join, packing, pii, quality

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: What the encoder keeps: little, beside executors that four stages have grown.
ENCODER_BYTES = 8 << 20
#: Near copies: words in a row, and hundredths of similarity.
SHINGLE, SIMILARITY = 5, 80


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    net = quality.fit(docs, common.read_table(spark, sf_dir, "labels"))
    return quality.passed(docs, net)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the least id stays."""
    return jaccard_join.representatives(docs, SHINGLE, SIMILARITY)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark passages go."""
    return decontamination.clean(docs, common.read_table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; personal data in its text gives way to its kind."""
    return pii.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces in sequences of at most 2048 ids."""
    return packing.pack(docs, BYTE_VOCABULARY, added=True, cache_bytes=ENCODER_BYTES).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality_filter), ("jaccard", near_duplicates), ("decontamination", decontaminate),
          ("pii", redact_personal_data), ("packing", pack_sequences)]

#: A trained network and a tokenizer decide what comes out: no SQL states it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over all of ``documents``; each result is written
    as Parquet in the shared folder and reread by the next stage."""
    docs = common.read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = common.materialize(docs, f"pipeline-{i + 1}-{name}")
    return docs
