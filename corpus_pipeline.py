"""Raw documents to training tokens: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from content_signals.llm import bpe, decontaminate, line_dedup, quality, simhash_dedup
from content_signals.llm.common import stage, table
from content_signals.llm.queries import TOKENIZER, quality_model

#: SQL cannot express the classifier, the semantic search or the encoder.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text scores as good."""
    return quality.keep_good(docs, quality_model(spark, sf_dir))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many hold; ``n_chars`` counts what is left."""
    kept = line_dedup.drop_common_lines(docs).withColumn(
        "row", F.col("row").withField("text", F.when(F.col("row.text").isNotNull(), F.col("kept_text")))
    )
    if "n_chars" in docs.columns:
        length = F.length("row.text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("row", F.col("row").withField("n_chars", length))
    return kept.select("row.*")


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints are linked, as operator 7 links them."""
    return simhash_dedup.drop_near_copies(docs, per_id=False)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    space = decontaminate.fit(docs)
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"), space)


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's tokens, as little-endian 32-bit numbers, and digests of them and their text."""
    encoded = bpe.encode_documents(docs, public_tokenizers.path(TOKENIZER))
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("SimHash near-dedup", near_deduplication),
    ("benchmark decontamination", benchmark_decontamination),
    ("BPE encoding and decoding", tokenization),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what is between two stages is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
