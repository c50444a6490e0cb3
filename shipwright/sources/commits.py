"""Versioned commits: tables that change all together or not at all.

A write never touches files that readers use. Every table of a commit goes to a folder of its own, and only
when all of them are complete a manifest is written: a single small file that names each table's folder. It is
written by one task, so it appears with one rename; a job that dies before that leaves folders that nobody reads.

An entry without a key is the whole table and replaces what was there; an entry with a key (a run id) is one
slice of an append-only table and replaces an earlier slice of that key only. So a load or a run that is repeated, for whatever
reason, leaves the same rows. Of two commits with the same version (two writers at once) the one whose name sorts last
counts as the later one.

Row counts and other measures of a table are observed by the job that writes it, on top of its plan, and
stand in the manifest: no reader has to scan the table for them. A task's numbers count when it succeeds, once.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F

MANIFEST = ("version long, commit string, schema_name string, table_name string, key string, folder string, rows long, "
            "measures map<string, bigint>")
COMMITS = "commits"


@dataclass
class Write:
    """One table, or with a key one slice of it, to be written by a commit."""
    schema: str
    table: str
    frame: DataFrame
    key: str | None = None
    partition_by: tuple[str, ...] = ()
    measures: dict[str, Column] = field(default_factory=dict)      # condition: rows for which it holds
    writer: object = None                                          # (DataFrame, path) -> None; Parquet if none is given


def new_commit() -> str:
    return uuid.uuid4().hex[:16]


def _folder(root: str, entry) -> str:
    return f"{root.rstrip('/')}/{entry['folder']}"


def write_one(root: str, commit: str, w: Write) -> dict:
    """Writes one table's folder; the entry a manifest needs for it, with the rows and measures seen while writing."""
    seen = Observation()
    named = {f"m{i}": name for i, name in enumerate(w.measures)}
    watched = w.frame.observe(seen, F.count(F.lit(1)).alias("rows"),
                              *[F.count_if(c).alias(m) for m, c in zip(named, w.measures.values())])
    entry = {"schema_name": w.schema, "table_name": w.table, "key": w.key, "folder": f"{w.schema}/{w.table}/{commit}"}
    if w.writer:
        w.writer(watched, _folder(root, entry))
    else:
        out = watched.write.mode("errorifexists").option("compression", "zstd")      # keys are texts of hex digits
        (out.partitionBy(*w.partition_by) if w.partition_by else out).parquet(_folder(root, entry))
    got = seen.get
    # a plan that is known to be empty has nothing to watch
    return entry | {"rows": got.get("rows", 0), "measures": {name: got.get(m, 0) for m, name in named.items()}}


def write_all(root: str, commit: str, writes: list[Write]) -> list[dict]:
    """Writes the tables of a commit side by side."""
    if not writes:
        return []
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        return list(pool.map(lambda w: write_one(root, commit, w), writes))


def _manifests(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST).json(f"{root.rstrip('/')}/{COMMITS}/*")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def publish(spark: SparkSession, root: str, commit: str, entries: list[dict]) -> int:
    """Makes the entries' folders the state of their tables, all at once; returns the commit's version."""
    # the first manifest of a root names nothing; it is there so that later ones have something to follow
    spark.createDataFrame([], MANIFEST).coalesce(1).write.mode("ignore").json(f"{root.rstrip('/')}/{COMMITS}/{0:09d}")
    version = 1 + (_manifests(spark, root).agg(F.max("version")).first()[0] or 0)
    rows = [Row(version=version, commit=commit, **{k: e[k] for k in ("schema_name", "table_name", "key", "folder", "rows", "measures")})
            for e in entries]
    (spark.createDataFrame(rows, MANIFEST).coalesce(1)
        .write.mode("errorifexists").json(f"{root.rstrip('/')}/{COMMITS}/{version:09d}-{commit}"))
    return version


def commit_all(spark: SparkSession, root: str, writes: list[Write]) -> list[dict]:
    """Writes the tables and publishes them."""
    commit = new_commit()
    entries = write_all(root, commit, writes)
    publish(spark, root, commit, entries)
    return entries


def live_entries(spark: SparkSession, root: str) -> DataFrame | None:
    """The manifest rows in force: of each table the last whole write and the last slice of each key after it."""
    found = _manifests(spark, root)
    if found is None:
        return None
    by_time = F.struct("version", "commit")
    table = Window.partitionBy("schema_name", "table_name")
    whole = F.max(F.when(F.col("key").isNull(), by_time)).over(table)
    last = F.max(by_time).over(Window.partitionBy("schema_name", "table_name", "key"))
    return (found.withColumns({"_whole": whole, "_last": last, "_at": by_time})
            .filter((F.col("_at") == F.col("_last")) & (F.col("_whole").isNull() | (F.col("_at") >= F.col("_whole"))))
            .drop("_whole", "_last", "_at"))


def folders(spark: SparkSession, root: str, schema: str, table: str) -> list[str]:
    """Folders of a table as of now, one a slice; the driver holds their names only."""
    live = live_entries(spark, root)
    if live is None:
        return []
    rows = live.filter((F.col("schema_name") == schema) & (F.col("table_name") == table)).orderBy("version", "commit").collect()
    return [_folder(root, r) for r in rows]


def read(spark: SparkSession, root: str, schema: str, table: str) -> DataFrame:
    """The table as of the last commit; a commit that comes later doesn't change this frame."""
    paths = folders(spark, root, schema, table)
    if not paths:
        raise LookupError(f"no commit under {root} has {schema}.{table}")
    return spark.read.parquet(*paths)


def recorded(spark: SparkSession, root: str) -> DataFrame:
    """(table_schema, table_name, row_count) of every live table, from the manifests alone."""
    live = live_entries(spark, root)
    if live is None:
        return spark.createDataFrame([], "table_schema string, table_name string, row_count long")
    return live.groupBy(F.col("schema_name").alias("table_schema"), "table_name").agg(F.sum("rows").alias("row_count"))
