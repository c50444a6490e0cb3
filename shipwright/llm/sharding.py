"""Sharding by histogram sort: shards of near-equal bytes, found by counting and one exchange.

Rows are ordered by the key (48-bit hash of the text, doc_id), so equal texts stand together and a
group of copies is only cut where it doesn't fit its shard. The splitters are searched as in a
histogram sort: candidate boundaries (probes) are laid through the key space, one Spark job counts
the exact bytes and rows below each of them over all partitions, and the interval around every
splitter is probed again, finer, until the nearest probe is within ``tolerance`` of the wanted
byte count or no key lies between the two nearest probes. Only then rows move, once: they are
exchanged by cell (the stretch between two neighbouring probes), sorted inside the cells,
and a row's slot is its cell's known start plus its place in the cell.

Scale: the rounds read a narrow key table written once; the driver holds some thousand
probes and their counts, whatever the data's size. A group of copies holding a third of all rows
has many keys (its doc_ids), so it is split like any other stretch.

Defined cases: a null text has no bytes, like an empty one, and checksum 0; a null doc_id sorts first
and shares a key with the lowest one; rows equal in doc_id and text share a key, stay in one shard and are numbered in any order;
an empty table gives no rows; with fewer rows than shards some shards stay empty; columns
named like the outputs are replaced.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shipwright.llm.common import stage

ROW_BYTES = 8                 # added to a text's bytes
TOLERANCE = 0.001             # of a shard's bytes
PROBES_A_SPLITTER = 256
CELLS_A_SHARD = 64            # a cell holds at most this part of a shard, or
CELL_BYTES = 256 << 20        # this many bytes, whichever is more (a single row may be larger)
HASH_BITS = 48
_INTERNAL = ("_key_hash", "_key_doc", "_cell", "_in_cell", "_placed")


@dataclass(frozen=True)
class KeySpace:
    """Keys (hash, doc_id) as whole numbers in order: hash * width + doc_id - low; null doc_ids count as low."""
    low: int
    width: int

    @property
    def end(self) -> int:
        return self.width << HASH_BITS

    def split(self, keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, doc_id parts) of whole-number keys."""
        return (np.array([k // self.width for k in keys], np.int64), np.array([k % self.width for k in keys], np.uint64))


def _cells(hashes: np.ndarray, parts: np.ndarray, probe_hash: np.ndarray, probe_part: np.ndarray) -> np.ndarray:
    """Number of probes at or below each key; probes are ascending."""
    out = np.searchsorted(probe_hash, hashes, side="left")
    # keys that share their hash with probes: count those by the second part
    same = np.flatnonzero((out < len(probe_hash)) & (probe_hash[np.minimum(out, len(probe_hash) - 1)] == hashes))
    for h in np.unique(hashes[same]):
        lo, hi = np.searchsorted(probe_hash, [h, h + 1])
        rows = same[hashes[same] == h]
        out[rows] = lo + np.searchsorted(probe_part[lo:hi], parts[rows], side="right")
    return out


def _cell_column(space: KeySpace, probes: list[int]):
    """Column expression: index of the cell a row's key falls in."""
    if not probes:
        return F.lit(0)
    probe_hash, probe_part = space.split(probes)
    low = np.uint64(space.low % (1 << 64))

    @F.pandas_udf("int")
    def cell(h: pd.Series, doc: pd.Series) -> pd.Series:
        part = doc.to_numpy(np.int64).view(np.uint64) - low          # wraps, so it holds for any range
        return pd.Series(_cells(h.to_numpy(np.int64), part, probe_hash, probe_part))

    return cell(F.col("_key_hash"), F.coalesce("_key_doc", F.lit(space.low)))


def _with_key(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.withColumns({
        "_key_hash": F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 64 - HASH_BITS),
        "_key_doc": F.col("doc_id").cast("long"),
        "size": F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES})


def find_splitters(keys: DataFrame, space: KeySpace, n_shards: int, tolerance: float = TOLERANCE,
                   per_splitter: int = PROBES_A_SPLITTER) -> tuple[list[int], dict[int, tuple[int, int]]]:
    """(splitter key of each shard but the first, bytes and rows below every probe made).

    A splitter is settled when a probe is within the tolerance, or when the two probes around it
    have at most one row or no key between them. Stretches heavier than a cell are probed too.
    """
    total = keys.agg(F.sum("size").alias("b"), F.count("*").alias("n")).first()
    size, rows = int(total["b"] or 0), int(total["n"])
    below = {0: (0, 0), space.end: (size, rows)}
    wanted = [size * k / n_shards for k in range(1, n_shards)]
    slack = tolerance * size / n_shards
    cell = max(size // (n_shards * CELLS_A_SHARD), CELL_BYTES if size > CELL_BYTES * n_shards * CELLS_A_SHARD else 1)
    probes = _between(0, space.end, max(n_shards * per_splitter, 2 * size // cell)) if rows else []
    while probes:
        _count_below(keys, space, probes, below)
        known = sorted(below)
        weight = [below[k][0] for k in known]
        again: set[int] = set()
        for i in range(1, len(known)):
            if weight[i] - weight[i - 1] > cell and below[known[i]][1] - below[known[i - 1]][1] > 1:
                again.update(_between(known[i - 1], known[i], 4 * (weight[i] - weight[i - 1]) // cell))
        for want in wanted:
            i = max(1, bisect.bisect_left(weight, want))     # known[i - 1] is below the splitter, known[i] isn't
            if min(weight[i] - want, want - weight[i - 1]) > slack and below[known[i]][1] - below[known[i - 1]][1] > 1:
                again.update(_between(known[i - 1], known[i], per_splitter))
        probes = sorted(again - below.keys())
    known = sorted(below)
    weight = [below[k][0] for k in known]
    splitters = []
    for want in wanted:
        i = max(1, bisect.bisect_left(weight, want))
        splitters.append(known[i] if weight[i] - want <= want - weight[i - 1] else known[i - 1])
    return splitters, below


def _between(lo: int, hi: int, n: int) -> list[int]:
    """Up to n keys evenly between lo and hi, both left out."""
    step = max(1, (hi - lo) // (n + 1))
    return list(range(lo + step, hi, step))


def _count_below(keys: DataFrame, space: KeySpace, probes: list[int], below: dict) -> None:
    """Adds the exact bytes and rows below each probe: counts by the stretches between probes, summed up."""
    counted = {r["cell"]: (r["b"], r["n"]) for r in keys.select(_cell_column(space, probes).alias("cell"), "size")
               .groupBy("cell").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()}
    b = n = 0
    for i, k in enumerate(probes):
        more = counted.get(i, (0, 0))
        b, n = b + more[0], n + more[1]
        below[k] = (b, n)


def shard_documents(docs: DataFrame, n_shards: int, tolerance: float = TOLERANCE) -> DataFrame:
    """The rows of ``docs`` with size, shard and slot (from 0 inside the shard, by key)."""
    keyed = _with_key(docs)
    keys = stage(keyed.select("_key_hash", "_key_doc", "size"), "shardkeys")
    ends = keys.agg(F.min("_key_doc").alias("lo"), F.max("_key_doc").alias("hi")).first()
    low, high = int(ends["lo"] or 0), int(ends["hi"] or 0)
    space = KeySpace(low, high - low + 1)
    splitters, below = find_splitters(keys, space, n_shards, tolerance)
    probes = [k for k in sorted(below) if 0 < k < space.end]
    # cell i lies between probes i - 1 and i; a slot begins with the rows of the shard before the cell
    starts = [0, *probes]
    shard = np.array([bisect.bisect(splitters, k) for k in starts])
    start = np.array([below[k][1] - (below[splitters[s - 1]][1] if s else 0) for k, s in zip(starts, shard)])

    @F.pandas_udf("struct<shard: int, start: long>")
    def placed(cell: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"shard": shard[cell.to_numpy()], "start": start[cell.to_numpy()]})

    at = Window.partitionBy("_cell").orderBy("_key_hash", F.col("_key_doc").asc_nulls_first())
    out = keyed.withColumn("_cell", _cell_column(space, probes)).withColumn("_in_cell", F.row_number().over(at))
    out = out.withColumn("_placed", placed("_cell"))
    return out.withColumns({"shard": F.col("_placed.shard"), "slot": F.col("_placed.start") + F.col("_in_cell") - 1}).drop(*_INTERNAL)
