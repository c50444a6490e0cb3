"""Corpus pipeline over the documents table: four training-data operators as stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as parquet and read again as the next stage's docs. Every stage but the last
returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipwright.llm import langid, mixing, ngram_join, packing
from shipwright.llm.common import TEXT_CODEC, ship_package, stage, table

MIN_LANGUAGE_SCORE = 0.5


def unused(docs: DataFrame, name: str) -> str:
    """A column name like ``name`` that the documents don't have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and those whose best language has a posterior under a half."""
    ship_package(spark)
    model = langid.train(docs)
    pred, score = unused(docs, "_lang_pred"), unused(docs, "_lang_score")
    scored = langid.predict(docs, model, docs.columns, pred, score)
    kept = (F.col(pred) != langid.UND) & (F.col(score) >= MIN_LANGUAGE_SCORE)
    return scored.filter(kept).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates: the one with the smallest doc_id (nulls last).

    Rows are linked by a number of their own, written once with them, so rows that repeat a doc_id or have
    none are rows like the others; of equal doc_ids the smallest number stays. Texts without a word have no copies.
    """
    ship_package(spark)
    row, copy = unused(docs, "_row"), unused(docs, "_copy")
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "joinrows", codec=TEXT_CODEC)
    groups = ngram_join.near_duplicate_components(rows.select(F.col(row).alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("_copy"), "component_id")
    ids = rows.select(F.col(row).alias("_copy"), F.col("doc_id").cast("long").alias("_id"))
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_copy"))
    shared = groups.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    members = stage(groups.join(shared, "component_id").join(ids, "_copy"), "members")
    stay = members.groupBy("component_id").agg(first.alias("first")).select(F.col("first._copy").alias("_copy"))
    copies = stage(members.join(stay, "_copy", "left_anti").select(F.col("_copy").alias(copy)), "copies")
    return rows.join(ngram_join.sized(copies), F.col(row) == F.col(copy), "left_anti").drop(row)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the temperature mix takes it, at least once, in the order of the mixed blocks."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with a checksum of each piece's ids."""
    ship_package(spark)
    return packing.piece_digests(packing.pack_documents(docs))


STAGES = [("language_id", language_id), ("ngram_jaccard_join", ngram_jaccard_join), ("mix_sources", mix_sources), ("packing", pack)]

# Tokenizer, language model and hash-permutation stages have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, fn in STAGES[:-1]:
        docs = stage(fn(spark, docs, sf_dir), f"pipeline-{name}", codec=TEXT_CODEC)
    return STAGES[-1][1](spark, docs, sf_dir)
