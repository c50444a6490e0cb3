"""Shared pieces of the training-data operators: staged tables and column guards."""

from __future__ import annotations

import ctypes
import functools
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipwright.session import scratch_root, ship_package

TEXT_CODEC = "zstd"           # copies of whole texts stay on disk until their reader ends


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder in the shared checkpoint folder of the cluster."""
    return scratch_root(spark, f"llm-{tag}-{uuid.uuid4().hex[:12]}")


def stage(df: DataFrame, tag: str, path: str | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Cuts the lineage with files every executor can see, so a lost executor costs only the
    tasks it was running, and gives the planner a measured size for its join choices.
    ``codec``: of the files, if not the session's; whole texts are written with ``TEXT_CODEC``.
    """
    spark = df.sparkSession
    path = path or shared_path(spark, tag)
    df.write.mode("append").parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col):
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def give_back() -> None:
    """Returns what a worker has freed to the system; Arrow's pool and the C heap would keep it for the worker's next tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # not in every C library
    if trim is not None:
        trim(0)


def lean(rows):
    """An Arrow map function that gives its memory back when its task ends: executors keep workers from stage to stage."""
    @functools.wraps(rows)
    def run(batches):
        try:
            yield from rows(batches)
        finally:
            give_back()
    return run
