"""Sinks: materialise a model as a table, append run outputs (S4, S6, S7, S8). All writes are commits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shipwright.sources import commits
from shipwright.sources.commits import Write


def view_name(schema: str, table: str) -> str:
    """Temp views cannot carry a schema qualifier, so ``schema.table`` becomes ``schema__table``."""
    return f"{schema}__{table}"


def materialize(df: DataFrame, root: str, schema: str, table: str, partition_by: list[str] | None = None) -> DataFrame:
    """Replace ``schema.table`` under ``root`` with the frame, read it back and register the view.

    Readers keep the old files until the new ones are complete; a repeated build leaves the same rows. Reading back
    cuts the lineage, so later models start from the written files rather than recomputing the chain.
    """
    spark = df.sparkSession
    commits.commit_all(spark, root, [Write(schema, table, df, partition_by=tuple(partition_by or ()))])
    out = commits.read(spark, root, schema, table)
    out.createOrReplaceTempView(view_name(schema, table))
    return out


def append_run(frames: dict[str, DataFrame], root: str, schema: str, run_id: str) -> list[dict]:
    """Append one run's slice to each table, all of them in one commit; the same run again replaces its slices."""
    spark = next(iter(frames.values())).sparkSession
    return commits.commit_all(spark, root, [Write(schema, table, df, key=run_id) for table, df in frames.items()])


def read_table(spark: SparkSession, root: str, schema: str, table: str) -> DataFrame:
    return commits.read(spark, root, schema, table)
