"""Token counts by way of a cache of digests: only unseen content is encoded, once."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from content_signals.llm.common import as_bytes, slices, stage
from content_signals.plans.skew import lookup_join

CACHE_SCHEMA = "version string, digest binary, n_tokens long"
_SLICE_BYTES = 1 << 20
_ENCODERS: dict[str, object] = {}


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file: a changed file never meets another's counts."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _encoder(path: str):
    """Function from texts to token counts, made once per Python worker."""
    if path not in _ENCODERS:
        if path.endswith(".json"):
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            encode = getattr(model, "encode_batch_fast", model.encode_batch)
            _ENCODERS[path] = lambda texts: [len(e.ids) for e in encode(texts, add_special_tokens=False)]
        elif path.endswith(".model"):
            import sentencepiece

            piece = sentencepiece.SentencePieceProcessor(model_file=path)
            _ENCODERS[path] = lambda texts: [len(ids) for ids in piece.encode(texts, num_threads=1)]
        else:
            raise ValueError(f"neither a .json nor a .model vocabulary: {path}")
    return _ENCODERS[path]


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The stored counts; none where nothing has been stored yet."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(cache)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(cache)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row of ``docs``, which holds ``doc_id`` and ``text``.

    ``tokenizer`` is a vocabulary file that every executor can read, ``cache`` a
    folder in shared storage. Content is normalised as far as the tokenizers see no
    difference: null becomes empty, and texts are compared as UTF-8. Its SHA-256 and
    the vocabulary's are looked up in the cache. Of each missing digest one text is
    fetched and encoded, without begin, end or other added tokens, and its count is
    appended to the cache. An append that is lost or repeated does no harm: counts
    are read back one per digest.

    Digests are summed per key before they are shuffled, so thousands of copies
    arrive as one row; looking up counts moves narrow rows only. A null ``doc_id``
    stays null, repeated rows give repeated results, other columns are not read.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text")).withColumn(
        "digest", F.unhex(F.sha2("text", 256))
    )
    stored = read_cache(spark, cache).filter(F.col("version") == version).select("digest")
    holder = F.coalesce("doc_id", F.lit(-(1 << 63))).alias("holder")
    missing = (
        rows.select("digest", holder)
        .groupBy("digest")
        .agg(F.min("holder").alias("holder"))
        .join(stored, "digest", "left_anti")
    )
    misses = rows.select("digest", "text", holder).join(missing, ["digest", "holder"], "left_semi")
    # rows may be equal in both; they are together already, so this moves nothing
    misses = misses.dropDuplicates(["digest", "holder"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _encoder(tokenizer)
        for batch in slices(batches, "text", _SLICE_BYTES):
            n = counts([t.decode() for t in as_bytes(batch.column("text"))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(n, pa.int64())], names=["digest", "n_tokens"]
            )

    encoded = misses.select("digest", "text").mapInArrow(encode, "digest binary, n_tokens long")
    encoded.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache)

    counts = (
        read_cache(spark, cache)
        .filter(F.col("version") == version)
        .groupBy("digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )
    narrow = rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    # thousands of copies share a digest: the counts go to them where they are few, and else in parts
    counted = lookup_join(narrow, stage(counts, "token-counts"), ["digest"], "inner", spread=F.col("doc_id"))
    return counted.select("doc_id", "n_bytes", "n_tokens")
