"""N-gram Jaccard self-join by universe partition and pigeonhole, exact at 0.8.

Two sets of sizes s <= l with Jaccard similarity of at least 0.8 differ in at most
H = (s + l) / 9 elements. Sizes fall into bands; band k splits the universe of shingles by a hash
into m(k) segments. A document writes one signature for each segment it has elements in (a hash of
the subset that falls there), for its own band and for the next smaller one where partners may
lie. If it has more than H such segments, a partner must agree in one of them. Costs decide
the rest:

* a document with too few non-empty segments (allocation H + 1 not reached) adds the
  one-deletion neighbourhoods of its segments (an agreement up to one element counts double),
  and where even that is short, its single shingles;
* a partner agrees in all but H of the signatures, so a document is only compared further if it shares
  more of them than it has to spare (its signatures less H + 1);
* of the signatures a partner must share some with, a document keeps only the rarest: all of its open ones less its
  spare. Two similar documents share more signatures than either has to spare, so, with all signatures in one
  order by holders, the rarest they share is among those that both keep.

Links are found in three rounds, all verified on the whole sets. A signature's hub is its smallest
id. First every document is paired with the hub it shares most signatures with: a large group of near
copies is connected by as many pairs as it has documents, not by their square. Then documents
that share a signature and are still in different components are
compared in place; documents of a signature beyond ``POPULAR`` are cut into blocks, and each pair of blocks is a
tile of its own, dealt to any task. Pairs pass a parity sketch (a lower bound of the difference, so it never loses a
link) before their sets are fetched. The second round takes of a signature's possible pairs only a forest, closest first: it
would join its components, so it has fewer pairs than documents. Its links are contracted, and
the third round takes all possible pairs of components that are still apart. The result is the connected components of all links.

Scale: signatures are (8-byte signature, id) rows, shuffled and sorted once and read as a
stream, so a signature held by a third of all documents needs no memory; equal sets leave a task
once. Sets are fetched only for documents that share a signature. Components are found by label
propagation with shortcuts over the verified pairs; every round is written to the shared folder.

Defined cases: null, empty and blank texts have the empty set and are their own component; rows
with a null doc_id are counted but not linked (component null); rows with the same doc_id are one
node (linked if any of their texts are); an empty table gives no rows; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shipwright.llm import shingles as S
from shipwright.llm import tokens
from shipwright.llm.common import lean, stage

NUM, DEN = 80, 100               # similarity as a ratio of whole numbers
BAND_RATIO = 1.5
SEGMENTS_PER_SIZE = 0.30         # segments of a band by its largest size
SPARE_SEGMENTS = 4
POPULAR = 4096                   # about so many documents of a signature are compared in a task
BROADCAST_ROWS = 500_000         # narrow rows sent to all executors at most; more are joined by shuffle
SEEN_SETS = 500_000              # sets a task remembers to write equal ones once
ROWS_OUT = 200_000               # signature rows in a batch
SLICE_BYTES = 1 << 20            # texts cut into shingles at once; their arrays take some 20 times as much
BAND_BITS = np.uint64(63)        # low bits of a signature: its band
_U = np.uint64


def bands(largest: int = 1 << 33) -> list[int]:
    """Lower bounds of the size bands, up to the first above ``largest``."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, int(out[-1] * BAND_RATIO)))
    return out


_LOW = np.array(bands())


def band_of(size) -> np.ndarray:
    return np.searchsorted(_LOW, size, side="right") - 1


def band_column():
    """The band that a signature names."""
    return F.col("sig").bitwiseAND(F.lit(int(BAND_BITS))).cast("int")


def most_different(s: int, l: int) -> int:
    """Largest symmetric difference of two sets of these sizes that are similar enough."""
    return (s + l) * (DEN - NUM) // (DEN + NUM)


def segments(band: int) -> int:
    return int(SEGMENTS_PER_SIZE * (_LOW[band + 1] - 1)) + SPARE_SEGMENTS


def plans(size: int) -> list[tuple[int, int]]:
    """(band, H) of the signatures that a set of this size writes."""
    own = int(band_of(size))
    out = []
    h_own = most_different(size, size * DEN // NUM)
    if h_own > 0:                                            # else only equal sets are similar
        out.append((own, h_own))
    if own and size > 1 and -(-size * NUM // DEN) < _LOW[own]:
        out.append((own - 1, most_different(int(_LOW[own] - 1), size)))
    return out


def _segment_sums(values: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(segments with elements, hash sum and count of each, segment of every value)."""
    spread = S.mix(values ^ _U(0xA5A5A5A5A5A5A5A5))
    seg = ((spread >> _U(32)) % _U(segments(band))).astype(np.int64)
    order = np.argsort(seg, kind="stable")
    sorted_seg = seg[order]
    first = np.flatnonzero(np.r_[True, sorted_seg[1:] != sorted_seg[:-1]])
    return sorted_seg[first], np.add.reduceat(spread[order], first), np.diff(np.r_[first, len(seg)]), seg


def _named(sums, seg, band: int, kind: int) -> np.ndarray:
    """Signature of a segment's hash sum: names the segment and the kind, holds the band in its low bits."""
    key = S.mix(sums + S.mix(np.asarray(seg).astype(_U) * _U(8) + _U(kind)) + _U(band))
    return (key & ~BAND_BITS) | _U(band)


def signatures(values: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
    """(signatures, spare by plan): spare is the number of signatures beyond H + 1; at least 0."""
    out, spare = [], []
    for band, h in plans(len(values)):
        seg, sums, count, of = _segment_sums(values, band)
        out.append(_named(sums, seg, band, 0))
        left = len(seg) - h - 1
        if left < 0:                                         # allocation is short: agreements up to one element
            out.append(_named(sums, seg, band, 1))
            spread = S.mix(values ^ _U(0xA5A5A5A5A5A5A5A5))
            place = np.searchsorted(seg, of)
            shared = count[place] > 1
            out.append(_named((sums[place] - spread)[shared], of[shared], band, 1))
            if int(np.minimum(count, 2).sum()) <= h:         # still short: any similar set shares a shingle
                out.append(_named(spread, np.zeros(len(values)), band, 2))
        spare.append(max(0, left))
    return out, spare


def sketch(values: np.ndarray) -> bytes:
    """Parity of the number of elements in each of 512, 1024, ... cells, at least two a shingle."""
    cells = 512
    while cells < 2 * len(values):
        cells *= 2
    odd = np.bincount((S.mix(values + _U(0x1234567)) & _U(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _sets(batch: pa.RecordBatch, column: int = 1) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, values, offsets) of slices of a batch."""
    texts = batch.column(column)
    for lo, hi in tokens.chunks(texts.fill_null(""), SLICE_BYTES):
        values, offsets = S.shingle_sets(texts.slice(lo, hi - lo))
        yield lo, values, offsets


def _doc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, set size, two set hashes, own band, spare signatures there and one band below, parity sketch."""
    for batch in batches:
        for lo, values, offsets in _sets(batch):
            n = np.diff(offsets)
            sums, twists = np.zeros(len(n), _U), np.zeros(len(n), _U)
            full = np.flatnonzero(n)
            if len(full):
                sums[full] = np.add.reduceat(S.mix(values), offsets[full])
                twists[full] = np.bitwise_xor.reduceat(S.mix(values + _U(77)), offsets[full])
            spare, marks = [[], []], []
            for i in range(len(n)):
                part = values[offsets[i]:offsets[i + 1]]
                got = spare_of(part) if n[i] else {}
                marks.append(sketch(part) if n[i] else b"")
                own = int(band_of(n[i])) if n[i] else 0
                spare[0].append(got.get(own, 0))
                spare[1].append(got.get(own - 1, 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, len(n)), pa.array(n, pa.int64()), pa.array(sums.view(np.int64)),
                 pa.array(twists.view(np.int64)), pa.array(band_of(n), pa.int32()), pa.array(spare[0], pa.int32()), pa.array(spare[1], pa.int32()),
                 pa.array(marks, pa.binary())],
                ["doc_id", "n", "set_a", "set_b", "band", "spare_own", "spare_low", "sketch"])


def spare_of(values: np.ndarray) -> dict[int, int]:
    """Spare signatures by band, counted without writing them."""
    out = {}
    for band, h in plans(len(values)):
        spread = S.mix(values ^ _U(0xA5A5A5A5A5A5A5A5))
        count = np.bincount(((spread >> _U(32)) % _U(segments(band))).astype(np.int64))
        out[band] = max(0, int((count > 0).sum()) - h - 1)
    return out


def _signature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sig, id); a set met before in this task is left out (its first holder stands for it)."""
    seen: set[int] = set()
    sigs, ids, held = [], [], 0
    for batch in batches:
        names = batch.column(0).to_pylist()
        for lo, values, offsets in _sets(batch):
            for i in range(len(offsets) - 1):
                part = values[offsets[i]:offsets[i + 1]]
                key = hash(part.tobytes())
                if not len(part) or key in seen:
                    continue
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add(key)
                found = signatures(part)[0]
                n = sum(map(len, found))
                sigs.extend(found)
                ids.append((names[lo + i], n))
                held += n
                if held >= ROWS_OUT:
                    yield _sig_batch(sigs, ids)
                    sigs, ids, held = [], [], 0
    if held:
        yield _sig_batch(sigs, ids)


def _sig_batch(sigs, ids) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(sigs).view(np.int64)),
         pa.array(np.repeat(np.array([i for i, _ in ids], np.int64), [n for _, n in ids]))], ["sig", "id"])


def _shared_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads (sig, id) sorted; passes on the distinct rows of signatures with two ids or more, with the hub.

    A stream: only the first id of the signature at hand is kept.
    """
    last = None                                              # (sig, hub, last id, whether the hub was written)
    for batch in batches:
        sig, ids = (c.to_numpy() for c in batch.columns)
        if not len(sig):
            continue
        if last is not None:
            sig, ids = np.r_[last[0], sig], np.r_[last[2], ids]
        new = np.r_[True, sig[1:] != sig[:-1]]
        again = np.r_[False, (~new[1:]) & (ids[1:] == ids[:-1])]
        run = np.cumsum(new) - 1
        firsts = np.flatnonzero(new)
        hubs = ids[firsts].copy()
        written = False
        if last is not None:
            hubs[0], written = last[1], last[3]
        size = np.bincount(run, weights=~again).astype(np.int64)
        keep = (size[run] > 1) & ~again
        if last is not None:
            if written:
                keep[0] = False                              # the carried row is out already
                keep[1:] |= (run[1:] == 0) & ~again[1:]
            elif size[0] == 1:
                keep[0] = False
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(sig[keep]), pa.array(ids[keep]), pa.array(hubs[run[keep]])],
                                             ["sig", "id", "hub"])
        tail = run == run[-1]
        out_already = bool(keep[tail].any()) or (run[-1] == 0 and written)
        last = (sig[-1], hubs[-1], ids[-1], out_already)


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, size and shingles of the documents asked for."""
    for batch in batches:
        for lo, values, offsets in _sets(batch):
            n = np.diff(offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, len(n)), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))],
                ["id", "n", "shingles"])


def fold(sketches: list[bytes]) -> np.ndarray:
    """Sketches brought to the shortest length of the group: halves laid on each other keep the parity."""
    shortest = min(map(len, sketches))
    rows = []
    for s in sketches:
        a = np.frombuffer(s, np.uint64)
        while a.nbytes > shortest:
            a = a[:len(a) // 2] ^ a[len(a) // 2:]
        rows.append(a)
    return np.array(rows)


def _possible(differ: np.ndarray, small: np.ndarray, large: np.ndarray) -> np.ndarray:
    """Whether sizes and a lower bound of the difference leave room for the similarity."""
    return (differ * (DEN + NUM) <= (small + large) * (DEN - NUM)) & (DEN * np.minimum(small, large) >= NUM * np.maximum(small, large))


def _close_pairs(ids, labels, sizes, sketches, split: int = 0, forest: bool = False, tile: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a group in different components that size and sketch allow; compared tile by tile.

    With ``split`` only pairs of a row before it and one from it on. With ``forest`` only pairs that join components which
    the pairs before them leave apart, the closest of a tile first: fewer pairs than rows.
    """
    marks = fold(sketches)
    n = len(ids)
    _, group = np.unique(labels, return_inverse=True)
    for a in range(0, split or n, tile):
        for b in range(split or a, n, tile):
            x, y = slice(a, min(split or n, a + tile)), slice(b, min(n, b + tile))
            good = (group[x][:, None] != group[y][None, :]) & (ids[x][:, None] != ids[y][None, :])
            if a == b:
                good = np.triu(good, 1)
            if not good.any():
                continue
            differ = np.zeros(good.shape, np.int64)
            for w in range(marks.shape[1]):
                differ += np.bitwise_count(marks[x, w][:, None] ^ marks[y, w][None, :])
            i, j = np.nonzero(good & _possible(differ, sizes[x][:, None], sizes[y][None, :]))
            if not len(i):
                continue
            if forest:
                far = differ[i, j] / (sizes[x][i] + sizes[y][j])
                kept, group = _joining(group, i + a, j + b, np.argsort(far, kind="stable"))
                i, j = i[kept], j[kept]
            p, q = ids[x][i], ids[y][j]
            yield np.minimum(p, q), np.maximum(p, q)


def _joining(group: np.ndarray, i: np.ndarray, j: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the pairs of rows that join groups, taken in ``order``; the groups after that)."""
    up = np.arange(int(group.max()) + 1)

    def root(g):
        while up[g] != g:
            up[g] = up[up[g]]
            g = up[g]
        return g

    kept, most = [], len(np.unique(np.r_[group[i], group[j]])) - 1
    for k in order:
        p, q = root(group[i[k]]), root(group[j[k]])
        if p != q:
            up[max(p, q)] = min(p, q)
            kept.append(k)
            if len(kept) == most:
                break
    while (up[up] != up).any():
        up = up[up]
    return np.array(kept, np.int64), up[group]


def _allowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads (a, b, na, nb, ka, kb); passes on the pairs that sizes and sketches allow."""
    for batch in batches:
        na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
        differ = np.array([int(np.bitwise_count(m[0] ^ m[1]).sum()) for m in map(fold, zip(
            batch.column("ka").to_pylist(), batch.column("kb").to_pylist()))], np.int64)
        yield batch.select(["a", "b"]).filter(pa.array(_possible(differ, na, nb)))


def dealt(rest: DataFrame) -> DataFrame:
    """Rows (sig, id, ...) with the tiles (low, high) of blocks that they are compared in, and their block.

    Signatures whose rows are all of one component have no pair and are left out. One with at most ``POPULAR`` rows is one tile. The rows of a larger one fall into blocks by a hash, and
    each goes to the tiles of its own block with every block.
    """
    many = stage(rest.groupBy("sig").agg(F.count("*").alias("c"), F.min("label").alias("lo"), F.max("label").alias("hi"))
                 .filter(F.col("lo") != F.col("hi")).select("sig", F.when(
                     F.col("c") > POPULAR, F.ceil(2 * F.col("c") / F.lit(POPULAR))).otherwise(1).cast("int").alias("blocks")), "tiles")
    rows = rest.join(sized(many), "sig")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "sig"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumns({"low": F.least("block", "_with"), "high": F.greatest("block", "_with")}).drop("blocks", "_with")


def _open_pairs(batches: Iterator[pa.RecordBatch], forest: bool = False) -> Iterator[pa.RecordBatch]:
    """Reads (sig, low, high, block, id, label, n, sketch) sorted so; pairs still to be verified."""
    held, current = [], None

    def flush():
        if len(held) > 1:
            blocks, ids, labels, sizes, sketches = zip(*held)
            _, low, high = current
            split = blocks.count(low) if low < high else 0
            if low < high and split in (0, len(held)):      # one of the blocks has no row
                return
            for a, b in _close_pairs(np.array(ids), np.array(labels), np.array(sizes), list(sketches), split, forest):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        for sig, low, high, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if (sig, low, high) != current:
                yield from flush()
                held, current = [], (sig, low, high)
            held.append(row)
    yield from flush()


def _forest_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """As `_open_pairs`, only pairs that join components of a signature: fewer than its documents."""
    return _open_pairs(batches, forest=True)


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    return (pairs.join(left, "a").join(right, "b")
            .filter(DEN * both >= NUM * (F.col("na") + F.col("nb") - both)).select("a", "b"))


def components(edges: DataFrame) -> DataFrame:
    """(id, label): the smallest id of the connected component, for every id that has an edge.

    Labels go along the edges and then to the label's own label, until nothing changes.
    """
    both = stage(edges.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(edges.select("b", "a")), "edges")
    labels = stage(both.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("low"))
                   .select("id", F.least("id", "low").alias("label")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("id", "src"), "src").groupBy(F.col("dst").alias("id")).agg(
            F.min("label").alias("near"))
        step = labels.join(seen, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = step.select(F.col("id").alias("label"), F.col("label").alias("far"))
        new = stage(step.join(jump, "label", "left").select(
            "id", "old", F.least("label", F.coalesce("far", "label")).alias("label")), "labels")
        labels = new.select("id", "label")
        if new.filter(F.col("old") != F.col("label")).isEmpty():
            return labels


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after some more links: components of the links between labels, put on top of the labels."""
    a, b = (labels.select(F.col("id").alias(c), F.col("label").alias(f"label_{c}")) for c in ("a", "b"))
    between = links.join(a, "a", "left").join(b, "b", "left").select(
        F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b")).filter("a <> b").distinct()
    top = components(between)
    before = labels.union(top.join(labels, "id", "left_anti").select("id", F.col("id").alias("label")))
    return stage(before.join(top.select(F.col("id").alias("label"), F.col("label").alias("new")), "label", "left").select(
        "id", F.coalesce("new", "label").alias("label")), "merged")


def open_rows(marked: DataFrame) -> DataFrame:
    """The rows (sig, id, label) of signatures whose documents are not all in one component, with the number of their holders."""
    open_sigs = stage(marked.groupBy("sig").agg(F.count("*").alias("holders"), F.min("label").alias("lo"),
                                                F.max("label").alias("hi"))
                      .filter(F.col("lo") != F.col("hi")).select("sig", "holders"), "open")
    return stage(marked.join(sized(open_sigs), "sig"), "marked")


def rarest(left: DataFrame, spare: DataFrame) -> DataFrame:
    """(sig, id, label) of the signatures that documents are compared in.

    A partner shares more signatures than there are to spare, all of them open; the rarest of them are enough.
    """
    each = Window.partitionBy("id", "band")
    rest = left.withColumn("band", band_column()).withColumns({
        "c": F.count("*").over(each), "place": F.row_number().over(each.orderBy("holders", "sig"))})
    rest = rest.join(spare, ["id", "band"]).filter(F.col("place") <= F.col("c") - F.col("spare"))
    return stage(rest.select("sig", "id", "label"), "rest")


def sized(df: DataFrame) -> DataFrame:
    """A staged narrow table with a broadcast hint where its row count allows one; else it is joined by shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _verified(pairs: DataFrame, named: DataFrame, tag: str) -> DataFrame:
    """The similar ones of staged pairs; fetches the whole sets of their documents only."""
    ids = stage(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), f"{tag}ids")
    sets = stage(named.join(sized(ids), named.doc_id == F.col("id"), "left_semi").mapInArrow(
        lean(_set_rows), "id long, n long, shingles array<long>"), f"{tag}sets")
    return stage(_similar(pairs, sets), f"{tag}links")


def named_spares(rows: DataFrame) -> DataFrame:
    """(id, band, spare) of both bands a document writes signatures for; the least of rows with the same id."""
    two = F.inline(F.array(F.struct(F.col("band").alias("band"), F.col("spare_own").alias("spare")),
                           F.struct((F.col("band") - 1).alias("band"), F.col("spare_low").alias("spare"))))
    named = rows.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    return named.select(F.col("doc_id").alias("id"), two).groupBy("id", "band").agg(F.min("spare").alias("spare"))


def near_duplicate_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stage(texts.mapInArrow(
        lean(_doc_rows), "doc_id long, n long, set_a long, set_b long, band int, spare_own int, spare_low int, sketch binary"), "docsets")
    named = texts.filter(F.col("doc_id").isNotNull())
    shared = stage(named.mapInArrow(lean(_signature_rows), "sig long, id long").repartition("sig")
                   .sortWithinPartitions("sig", "id").mapInArrow(_shared_only, "sig long, id long, hub long"), "shared")

    spare = named_spares(rows)
    # first round: each document with the hub it shares most signatures with
    marks = rows.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0)).select(F.col("doc_id").alias("id"), "n", "sketch")
    ties = shared.filter(F.col("id") != F.col("hub")).groupBy("id", "hub", band_column().alias("band")).agg(F.count("*").alias("c"))
    ties = ties.join(spare, ["id", "band"]).filter(F.col("c") > F.col("spare"))
    best = ties.groupBy("id").agg(F.max(F.struct("c", (-F.col("hub")).alias("minus"))).alias("m")).select(
        (-F.col("m.minus")).alias("a"), F.col("id").alias("b"))
    left = marks.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka"))
    right = marks.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb"))
    near = stage(best.join(right, "b").join(left, "a").select("a", "b", "na", "nb", "ka", "kb").mapInArrow(
        _allowed, "a long, b long").distinct(), "near")
    links = _verified(near, named, "first")
    labels = components(links)

    # then the signatures whose documents are not all in one component: pairs that would join the components of a
    # signature first, and once those are verified and contracted, all pairs of components still apart
    left = shared
    for pairs_of, tag in ((_forest_pairs, "forest"), (_open_pairs, "rest")):
        left = open_rows(left.select("sig", "id").join(sized(labels), "id", "left").select(
            "sig", "id", F.coalesce("label", "id").alias("label")))
        rest = dealt(rarest(left, spare)).join(marks, "id")
        order = ["sig", "low", "high", "block"]
        pairs = stage(rest.select(*order, "id", "label", "n", "sketch").repartition("sig", "low", "high").sortWithinPartitions(*order)
                      .mapInArrow(lean(pairs_of), "a long, b long").distinct(), f"{tag}pairs")
        labels = merged(labels, _verified(pairs, named, tag))

    # copies of a set share a label; the smallest doc_id of the whole component names it
    key = ["n", "set_a", "set_b"]
    known = rows.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0)).join(
        labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    classes = known.groupBy(*key).agg(F.min("doc_id").alias("low"), F.min("label").alias("label")).withColumn(
        "label", F.coalesce("label", "low"))
    named_components = classes.groupBy("label").agg(F.min("low").alias("component_id"))
    by_class = stage(classes.join(named_components, "label").select(*key, "component_id"), "classes")
    return rows.join(by_class, key, "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
