"""Token counts through a digest cache.

The cache is a parquet table (content digest, tokenizer digest, token count). A count joins the
digests of the normalised contents (a null text is the empty text; nothing else may change the
count) to the stored ones, encodes each distinct missing text once, appends the new counts to
the table and answers from it. The tokenizer digest covers the vocabulary file, the library
version and the options, so another tokenizer never reads these entries.

Scale: one shuffle of the texts by digest, pre-aggregated so equal texts leave a task once;
the answer joins digests only, and a digest that a large share of the rows hold is split by
adaptive skew-join handling. Counting is idempotent: entries written twice (a lost driver,
two writers) agree and are merged on reading.

Defined cases: null and empty texts have 0 bytes and 0 tokens; null doc_ids pass through; equal
rows are counted each; an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipwright.llm import tokens

CACHE = "content_digest binary, tokenizer_digest string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    import tokenizers
    with open(path, "rb") as fh:
        return hashlib.sha256(fh.read() + f"|{tokenizers.__version__}|add_special_tokens=False".encode()).hexdigest()


def read_cache(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row per content; empty before the first append."""
    try:
        stored = spark.read.schema(CACHE).parquet(cache_path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        stored = spark.createDataFrame([], CACHE)
    return (stored.filter(F.col("tokenizer_digest") == version).groupBy("content_digest")
            .agg(F.max("n_tokens").alias("n_tokens")))


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(path, "space_prefixed")
        for batch in batches:
            texts = batch.column(1)
            for lo, hi in tokens.chunks(texts):
                n = enc.counts(texts.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64())],
                                                 ["content_digest", "n_tokens"])
        enc.forget()
    return run


def count_tokens(docs: DataFrame, cache_path: str, tokenizer: str = "byte_bpe_50k.json",
                 over: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per row; new counts are appended to the cache."""
    spark = docs.sparkSession
    path = tokens.tokenizer_path(tokenizer)
    version = tokenizer_digest(path)
    content = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    content = content.withColumn("content_digest", F.unhex(F.sha2("text", 256)))
    distinct = content.select("content_digest", "text").dropDuplicates(["content_digest"])
    misses = distinct.join(read_cache(spark, cache_path, version), "content_digest", "left_anti")
    new = misses.mapInArrow(_counted(path), "content_digest binary, n_tokens long")
    (new.select("content_digest", F.lit(version).alias("tokenizer_digest"), "n_tokens")
        .write.mode("append").parquet(cache_path))
    narrow = content.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content_digest")
    return (narrow.join(read_cache(spark, cache_path, version), "content_digest", "left")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > over).alias("over_limit")))
