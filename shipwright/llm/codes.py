"""Product-quantiser codes with norm-of-sum bounds.

A vector's components become whole numbers (floor of a scale times each), the vector is cut into equal parts,
and every part position learns a codebook: it starts as that part of the first vectors by id; a round assigns
every part to its nearest entry (squared distance, ties to the lower index) and moves each entry to the
floored mean of its parts. The last codebooks give the codes and errors.

Bounds save most distances after the first assignment. The entries of a part position lie in groups of
similar ones. A row keeps for every (part, group) a lower bound of its distance to the group's entries other than
its own one, and the stamp of the round in which that bound was exact. All codebooks are kept, so in a later round
the bound falls by the *net* way that the entries went since the stamp, the norm of the sum of their moves, never by
the larger sum of the moves' norms. Where the bound stays above the exact distance to the row's own entry no
entry of the group can win or tie; else the group's distances are computed again and the bound gets a new stamp.

Distances are exact: float64 as long as every sum stays below 2^53, Python's whole numbers beyond; the bounds
leave room for rounding. Means are summed as 32-bit limbs, so no sum overflows either.

Scale: rows with their bounds are written once a round in the shared folder and nothing is shuffled but sums
by (part, entry, component). Codebooks (parts x entries x part length numbers, for each vector length in the table) are what the
driver holds and sends out.

Defined cases: vectors that are null or hold a null, NaN or infinite component are left out; a length that
the number of parts doesn't divide is filled up with zeros at the end; vectors of different lengths have codebooks
of their own, each with its own digest; with fewer vectors than entries there are fewer entries; rows with the same id
are rows like any other (the order of first vectors is id, nulls last, then the vector); errors beyond 64 bits are given as the
largest long; equal labels are summed with nulls together; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipwright.llm.common import stage
from shipwright.llm.ngram_join import sized

SCALE, PARTS, ENTRIES, ROUNDS = 256, 16, 64, 2
GROUPS = 8                   # groups of entries that share a bound
SLACK = 1e-9                 # relative room for rounding in the bounds
EXACT = 1 << 53
SALTS = 16                   # pieces of a label's rows where labels are joined by shuffle
LARGEST = (1 << 63) - 1
_STATE = "id long, label string, v array<{}>, code binary, error long, low binary, stamp binary, scanned long"


def whole(v: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * v): float64 where exact distances fit in it, else Python's whole numbers."""
    v = v.astype(np.float64)
    if not v.size or float(np.abs(v).max()) * scale < 2.0 ** 22:       # (2 * 2^22)^2 * 2^7 components = 2^53
        return np.floor(v * scale)
    from fractions import Fraction
    return np.array([[Fraction(x) * scale // 1 for x in row] for row in v.tolist()], dtype=object).reshape(v.shape)


def cut(v: np.ndarray, parts: int) -> np.ndarray:
    """(rows, parts, part length), filled up with zeros."""
    n, dim = v.shape
    step = -(-dim // parts)
    if step * parts != dim:
        v = np.concatenate([v, np.zeros((n, step * parts - dim), v.dtype)], axis=1)
    return v.reshape(n, parts, step)


def _exact(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as they are if distances between them are exact in float64, else as Python's whole numbers."""
    most = max((abs(a).max() for a in arrays if a.size), default=0)
    if all(a.dtype != object for a in arrays) and 4 * int(most) ** 2 * max(1, arrays[0].shape[-1]) < EXACT:
        return list(arrays)
    return [a if a.dtype == object else np.array([int(x) for x in a.ravel()], dtype=object).reshape(a.shape) for a in arrays]


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows x to entries c."""
    x, c = _exact(x, c)
    out = np.zeros((len(x), len(c)), x.dtype)
    for k in range(x.shape[1]):
        d = x[:, k, None] - c[None, :, k]
        out += d * d
    return out


def _root(squares: np.ndarray) -> np.ndarray:
    """Distances as floats; those beyond the largest float stand as a number a little below it, on both sides of a comparison."""
    if squares.dtype != object:
        return np.sqrt(squares)
    return np.array([math.sqrt(x) if x < 1 << 1000 else min(math.isqrt(x), 17 * 10 ** 307) for x in squares.ravel()], np.float64).reshape(squares.shape)


@dataclass
class History:
    """Codebooks of one vector length after each round, (parts, entries, part length) each, and the entries' groups."""
    books: list[np.ndarray]
    group: np.ndarray = field(default=None)               # (parts, entries)

    def __post_init__(self):
        if self.group is None:
            self.group = np.array([_groups(book) for book in self.books[0]])

    def fallen(self, stamp: int) -> np.ndarray:
        """(parts, groups): the longest net way of a group's entries since the round of the stamp, rounded up."""
        then, now = self.books[stamp], self.books[-1]
        out = np.zeros((len(now), GROUPS))
        for p in range(len(now)):
            way = [float(_root(distances(then[p, j:j + 1], now[p, j:j + 1]))[0, 0]) for j in range(now.shape[1])]
            np.maximum.at(out[p], self.group[p], way)
        return out * (1 + SLACK)


def _groups(book: np.ndarray) -> np.ndarray:
    """Group of each entry: runs of the entries in the order of their widest component."""
    n = len(book)
    if not n or not book.shape[1]:
        return np.zeros(n, np.int64)
    values = book.astype(np.float64)
    order = np.lexsort((np.arange(n), values[:, np.argmax(values.max(axis=0) - values.min(axis=0))]))
    out = np.empty(n, np.int64)
    out[order] = np.arange(n) * GROUPS // n
    return out


@dataclass
class State:
    """Of one part position: own entry, its distance, lower bound and stamp by group, distances computed."""
    code: np.ndarray
    error: np.ndarray
    low: np.ndarray
    stamp: np.ndarray
    scanned: np.ndarray


def first_assignment(x: np.ndarray, book: np.ndarray, group: np.ndarray) -> State:
    """Every distance; exact bounds."""
    n, at = len(x), np.arange(len(x))
    d = distances(x, book)
    code = d.argmin(axis=1) if d.dtype != object else np.array([min(range(len(r)), key=r.__getitem__) for r in d], np.int64)
    roots = _root(d)
    roots[at, code] = np.inf
    low = np.full((n, GROUPS), np.inf)
    for g in range(GROUPS):
        if (group == g).any():
            low[:, g] = roots[:, group == g].min(axis=1)
    return State(code, d[at, code], low, np.zeros((n, GROUPS), np.uint8), np.full(n, len(book), np.int64))


def next_assignment(x: np.ndarray, book: np.ndarray, group: np.ndarray, old: State, fallen: dict[int, np.ndarray], now: int) -> State:
    """Own distance first; then only the groups whose fallen bound doesn't rule them out."""
    n, at = len(x), np.arange(len(x))
    own = np.zeros(n, object if x.dtype == object or book.dtype == object else np.float64)
    xs, bs = _exact(x, book)
    for k in range(x.shape[1]):
        d = xs[:, k] - bs[old.code, k]
        own = own + d * d
    code, error, low, stamp = old.code.copy(), own.copy(), old.low.copy(), old.stamp.copy()
    scanned = np.ones(n, np.int64)
    sure = old.low - sum(np.where(old.stamp == t, way[None, :], 0.0) for t, way in fallen.items())
    open_ = sure * (1 - SLACK) <= _root(own)[:, None] * (1 + SLACK)
    for g in range(GROUPS):
        entries, rows = np.flatnonzero(group == g), np.flatnonzero(open_[:, g])
        if not len(entries) or not len(rows):
            continue
        d = distances(x[rows], book[entries])
        scanned[rows] += len(entries)
        roots = _root(d)
        roots[entries[None, :] == old.code[rows, None]] = np.inf
        low[rows, g], stamp[rows, g] = roots.min(axis=1), now
        for j, e in enumerate(entries):
            better = (d[:, j] < error[rows]) | ((d[:, j] == error[rows]) & (e < code[rows]))
            code[rows[better]], error[rows[better]] = e, d[better, j]
    # groups that gained or lost an own entry: the old entry is one of the others now, the new one isn't
    moved = np.flatnonzero(code != old.code)
    if len(moved):
        left = group[old.code[moved]]
        fresh = stamp[moved, left] == now
        then = np.where(fresh, low[moved, left], np.minimum(sure[moved, left], np.inf))
        low[moved, left], stamp[moved, left] = np.minimum(then, _root(own[moved])), now
    return State(code, error, low, stamp, scanned)


def _step(histories: dict[int, History], scale: int, parts: int):
    """Assigns the rows of a batch to the last codebooks, by the bounds if there are any yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ways = {(dim, t): h.fallen(t) for dim, h in histories.items() for t in range(len(h.books) - 1)}
        for batch in batches:
            lists = batch.column("v")
            size = np.diff(lists.offsets.to_numpy())
            flat, starts = lists.values.to_numpy(), lists.offsets.to_numpy()[:-1]
            n = len(batch)
            codes, errors, lows, stamps, scans = [None] * n, [0] * n, [None] * n, [None] * n, [0] * n
            for dim in np.unique(size).tolist():
                rows = np.flatnonzero(size == dim)
                x = cut(whole(flat[starts[rows][:, None] + np.arange(dim)[None, :]], scale), parts)
                h = histories[dim]
                now = len(h.books) - 1
                states = []
                for p in range(parts):
                    book, group = h.books[-1][p], h.group[p]
                    if not now:
                        states.append(first_assignment(x[:, p], book, group))
                        continue
                    old = _held(batch, rows, p, parts)
                    states.append(next_assignment(x[:, p], book, group, old, {t: ways[dim, t][p] for t in range(now)}, now))
                code = np.stack([s.code for s in states], axis=1).astype(np.uint8)
                low = np.stack([s.low for s in states], axis=1)
                low32 = np.nextafter(low.astype(np.float32), np.float32(-np.inf), dtype=np.float32)    # never above the bound
                stamp = np.stack([s.stamp for s in states], axis=1)
                error = sum(s.error for s in states)
                scan = sum(s.scanned for s in states)
                for i, r in enumerate(rows.tolist()):
                    codes[r], lows[r], stamps[r] = code[i].tobytes(), low32[i].tobytes(), stamp[i].tobytes()
                    errors[r], scans[r] = min(int(error[i]), LARGEST), int(scan[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), lists, pa.array(codes, pa.binary()), pa.array(errors, pa.int64()),
                 pa.array(lows, pa.binary()), pa.array(stamps, pa.binary()), pa.array(scans, pa.int64())],
                ["id", "label", "v", "code", "error", "low", "stamp", "scanned"])
    return run


def _held(batch: pa.RecordBatch, rows: np.ndarray, p: int, parts: int) -> State:
    """What the rows keep of one part position."""
    pick = pa.array(rows)

    def binary(name, kind, shape):
        return np.frombuffer(b"".join(batch.column(name).take(pick).to_pylist()), kind).reshape(len(rows), *shape)

    code = binary("code", np.uint8, (parts,))[:, p].astype(np.int64)
    low = binary("low", np.float32, (parts, GROUPS))[:, p].astype(np.float64)
    return State(code, None, low, binary("stamp", np.uint8, (parts, GROUPS))[:, p].copy(), None)


def _limbs(scale: int, parts: int):
    """(dim, part, entry, place, limb, x): a task's sums of the rows assigned to each entry, as 32-bit limbs; place -1 counts them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            lists = batch.column("v")
            size = np.diff(lists.offsets.to_numpy())
            flat, starts = lists.values.to_numpy(), lists.offsets.to_numpy()[:-1]
            for dim in np.unique(size).tolist():
                rows = np.flatnonzero(size == dim)
                x = cut(whole(flat[starts[rows][:, None] + np.arange(dim)[None, :]], scale), parts)
                code = np.frombuffer(b"".join(batch.column("code").take(pa.array(rows)).to_pylist()), np.uint8).reshape(len(rows), parts)
                at = sums.setdefault(dim, np.zeros((parts, 256, x.shape[2] + 1), object))
                for p in range(parts):
                    used = np.unique(code[:, p])
                    for e in used.tolist():
                        mine = x[code[:, p] == e, p]
                        total = mine.sum(axis=0)
                        at[p, e, :-1] += np.array([int(t) for t in total], object)
                        at[p, e, -1] += len(mine)
        out = []
        for dim, at in sums.items():
            for p, e in np.argwhere(at[:, :, -1] > 0).tolist():
                for place, value in enumerate(at[p, e].tolist()):
                    place = -1 if place == at.shape[2] - 1 else place
                    sign, left, limb = (-1 if value < 0 else 1), abs(value), 0
                    while left or not limb:
                        out.append((dim, p, e, place, limb, sign * (left & 0xFFFFFFFF)))
                        left, limb = left >> 32, limb + 1
        for at in range(0, len(out), 100_000):
            cols = list(zip(*out[at:at + 100_000]))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in cols[:5]), pa.array(cols[5], pa.int64())],
                                             ["dim", "part", "entry", "place", "limb", "x"])
    return run


def _next_books(state: DataFrame, histories: dict[int, History], scale: int, parts: int) -> None:
    """Appends the codebooks of the next round; entries without rows stay."""
    found = state.select("v", "code").mapInArrow(_limbs(scale, parts), "dim int, part int, entry int, place int, limb int, x long")
    sums: dict[tuple, int] = {}
    # as many rows as there are codebook numbers, and limbs of them
    for r in found.groupBy("dim", "part", "entry", "place", "limb").agg(F.sum("x").alias("x")).collect():
        key = r.dim, r.part, r.entry, r.place
        sums[key] = sums.get(key, 0) + (r.x << 32 * r.limb)
    for dim, h in histories.items():
        book = h.books[-1].astype(object)
        for (d, p, e, place), value in sums.items():
            if d == dim and place >= 0:
                book[p, e, place] = value // sums[d, p, e, -1]
        h.books.append(_compact(book))


def _compact(book: np.ndarray) -> np.ndarray:
    """float64 where every number and distance is exact in it."""
    small = not book.size or 4 * max(abs(int(x)) for x in book.ravel()) ** 2 * max(1, book.shape[-1]) < EXACT
    return book.astype(np.float64) if small else np.array([int(x) for x in book.ravel()], object).reshape(book.shape)


def kept_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, v) of the rows that take part; v stays in single precision where it comes so."""
    kind = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    bad = F.exists(F.col("v"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                          F.transform(F.col(vector_col), lambda x: x.cast(kind)).alias("v"))
    return rows.filter(F.col("v").isNotNull()).filter(~F.coalesce(bad, F.lit(True)))


def first_books(rows: DataFrame, scale: int, parts: int, entries: int) -> dict[int, History]:
    """Codebooks by vector length, from each length's first vectors; ``entries`` rows a length reach the driver."""
    out = {}
    for r in rows.select(F.size("v").alias("dim")).distinct().collect():
        first = rows.filter(F.size("v") == r.dim).orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
        x = cut(whole(np.array([f.v for f in first], np.float64).reshape(len(first), r.dim), scale), parts)
        out[r.dim] = History([_compact(np.swapaxes(x, 0, 1).astype(object))])
    return out


def books_digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in book.ravel()).encode()).hexdigest()


def train_and_assign(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE,
                     parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, dict[int, History], list[DataFrame]]:
    """(final state of every row, codebooks of all rounds by vector length, state after each assignment)."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    rows = stage(kept_rows(vectors, id_col, vector_col, label_col), "codevectors")
    histories = first_books(rows, scale, parts, entries)
    schema = _STATE.format(rows.schema["v"].dataType.elementType.simpleString())
    states = [stage(rows.mapInArrow(_step(histories, scale, parts), schema), "codestate")]
    for _ in range(rounds):
        _next_books(states[-1], histories, scale, parts)
        states.append(stage(states[-1].mapInArrow(_step(histories, scale, parts), schema), "codestate"))
    return states[-1], histories, states


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE,
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row that takes part."""
    state, histories, _ = train_and_assign(vectors, id_col, vector_col, label_col, scale, parts, entries, rounds)
    digests = {dim: books_digest(h.books[-1]) for dim, h in histories.items()}
    digest = F.lit(None).cast("string")
    for dim, sha in digests.items():
        digest = F.when(F.size("v") == dim, F.lit(sha)).otherwise(digest)
    coded = state.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", digest.alias("codebooks_sha256"),
                         F.struct(F.col("label").isNull().alias("none"), F.coalesce("label", F.lit("")).alias("label")).alias("by"))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("long")
    sums = stage(coded.groupBy("by").agg(total.alias("label_error")), "labelerrors")
    small = sized(sums)
    if small is sums:       # many labels: each of them in some salts, so that a popular one's rows are spread
        coded = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
        joined = coded.join(sums.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>"))), ["by", "salt"])
    else:
        joined = coded.join(small, "by")
    return joined.select("vec_id", "code", "error", "label_error", "codebooks_sha256")
