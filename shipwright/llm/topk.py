"""Exact top-k search by tiled matrix products.

Vectors become whole numbers (floor of a scale times each component) and are packed into tiles:
rows are dealt to tiles by a hash of their id, as many tiles as give about ``TILE_ROWS`` rows each,
queries likewise. Every (query tile, shard tile) pair meets once; its task multiplies the two
matrices in strips, keeps each query's best ``k`` of the tile, and the per-query lists are
merged in a tree: lists of ``FAN`` tiles at a time, until one is left. What moves is one copy of each
tile for each tile it meets, and k rows a query and tile after that.

Products run in float64 where every partial sum is below 2^53, which makes them exact; else in
Python's whole numbers. Equal scores go to the smaller id.

Defined cases: vectors that are null or hold a null, NaN or infinite component, and rows with a null id,
take no part; only vectors of the query's length are candidates; a row's own id is never its candidate;
rows with the same id are all candidates; with fewer than k candidates all are returned; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipwright.llm.common import stage

TILE_ROWS = 8192              # rows of a shard tile
QUERY_ROWS = 1024             # rows of a query tile
STRIP = 512                   # shard rows multiplied at once
FAN = 16
EXACT = float(1 << 53)
_HITS = "query_id long, tile int, vec_id long, score long"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, dim, v): whole-number vectors of the rows that take part."""
    as_double = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    bad = F.exists(F.col("v"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), as_double.alias("v")).filter(
        F.col("id").isNotNull() & F.col("v").isNotNull())
    rows = rows.filter(~F.coalesce(bad, F.lit(True)))
    return rows.select("id", F.size("v").alias("dim"), F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("v"))


def _tiles(rows: DataFrame, n_tiles: int, side: str) -> DataFrame:
    """One row a tile and vector length: ids and the matrix, packed."""

    def pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        ids = rows.column("id").combine_chunks().to_numpy()
        matrix = rows.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), key[1].as_py())
        order = np.argsort(ids, kind="stable")
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()),
                         pa.array([ids[order].tobytes()], pa.binary()), pa.array([matrix[order].tobytes()], pa.binary())],
                        names=[f"{side}_tile", "dim", f"{side}_ids", f"{side}_m"])

    tile = F.pmod(F.xxhash64("id"), F.lit(n_tiles)).cast("int")
    return rows.withColumn("tile", tile).groupBy("tile", "dim").applyInArrow(
        pack, f"{side}_tile int, dim int, {side}_ids binary, {side}_m binary")


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= floor)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def tile_hits(q_ids, q, s_ids, s, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, ids, scores) of each query's best k in a shard tile."""
    widest = float(np.abs(q).max(initial=0)) * float(np.abs(s).max(initial=0)) * max(1, q.shape[1])
    exact = widest < EXACT
    for a in range(0, len(q_ids), QUERY_ROWS):
        queries = q[a:a + QUERY_ROWS]
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64 if exact else object))] * len(queries)
        for b in range(0, len(s_ids), STRIP):
            if exact:
                scores = (queries @ s[b:b + STRIP].T).astype(np.int64)
            else:
                whole = np.vectorize(int, otypes=[object])
                scores = whole(queries).dot(whole(s[b:b + STRIP]).T)
            ids = s_ids[b:b + STRIP]
            for i in range(len(queries)):
                own = ids != q_ids[a + i]
                c_ids, c_scores = np.r_[held[i][0], ids[own]], np.r_[held[i][1], scores[i][own]]
                best = _best(c_scores, c_ids, k)
                held[i] = c_ids[best], c_scores[best]
        for i, (ids, scores) in enumerate(held):
            yield int(q_ids[a + i]), ids, np.clip(scores, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def _multiply(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                q_ids, s_ids = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["s_ids"], np.int64)
                q = np.frombuffer(r["q_m"], np.float64).reshape(len(q_ids), r["dim"])
                s = np.frombuffer(r["s_m"], np.float64).reshape(len(s_ids), r["dim"])
                found = list(tile_hits(q_ids, q, s_ids, s, k))
                sizes = [len(x[1]) for x in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([x[0] for x in found], sizes), pa.int64()), pa.array([r["s_tile"]] * sum(sizes), pa.int32()),
                     pa.array(np.concatenate([x[1] for x in found]), pa.int64()), pa.array(np.concatenate([x[2] for x in found]), pa.int64())],
                    ["query_id", "tile", "vec_id", "score"])
    return run


def _merge(hits: DataFrame, k: int, by: list[str]) -> DataFrame:
    best = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
                scale: int = 1024, tile_rows: int = TILE_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of every query row; ``is_query`` is a condition on ``id``."""
    rows = stage(quantised(vectors, id_col, vector_col, scale), "vectors")
    queries = rows.filter(is_query)
    n, nq = rows.count(), queries.count()
    n_tiles, n_query_tiles = max(1, -(-n // tile_rows)), max(1, -(-nq // query_rows))
    shards = _tiles(rows, n_tiles, "s").withColumn("q_tile", F.explode(F.sequence(F.lit(0), F.lit(n_query_tiles - 1))))
    asked = _tiles(queries, n_query_tiles, "q").withColumn("s_tile", F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1))))
    pairs = asked.join(shards, ["q_tile", "s_tile", "dim"]).select("dim", "q_ids", "q_m", "s_ids", "s_m", "s_tile")
    hits = pairs.mapInArrow(_multiply(k), _HITS)
    while n_tiles > 1:                       # merge the lists of FAN tiles at a time
        hits = _merge(hits.withColumn("tile", F.floor(F.col("tile") / FAN).cast("int")), k, ["query_id", "tile"]).drop("rank")
        n_tiles = -(-n_tiles // FAN)
    return _merge(hits, k, ["query_id"]).select("query_id", "rank", "vec_id", "score")
