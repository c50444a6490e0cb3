"""Packing: hierarchical multi-length packing of token sequences.

Documents are routed to context-size tiers (4096, 2048, 1024, 512) by length, every tier is
packed, gaps of long windows are filled from shorter tiers, and what is left of a gap is filled
by cutting one short document. Window sizes are powers of two and the last open window of a
block is cut along the binary digits of its length, so nothing is padded. Sequences are dealt
to step groups of equal token budgets, longest first to the emptiest group, so each group mixes
the tiers.

One pass, no shuffle: a task tokenises its rows in order, collects blocks of about
``block_tokens`` ids and packs each block on its own (padding is nil at any block size, so
a wider scope would gain nothing). Memory is bounded by the block plus one document.
Sequence ids hold the task's partition number and a running number; a repeated task
(lost executor) gives the same ids again.

Defined cases: a null text counts as empty and an empty document is the single id ``end_id``;
null doc_ids pass through; equal rows are separate documents; a document longer than the
longest window fills whole windows, its rest is routed like a document; an empty table gives
no pieces; other columns of the input are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipwright.llm import tokens
from shipwright.llm.common import give_back

TIERS = (4096, 2048, 1024, 512)
BLOCK_TOKENS = 4 << 20
STEP_TOKENS = 64 * 4096
END_ID = 2
MAX_BATCH_BYTES = 2 << 20    # ids in one output batch
CHUNK_BYTES = 1 << 20        # text encoded at once: its words, their places and ids take about twenty times as much

PIECES = "doc_id long, start long, ids binary, length long, doc_tokens long, sequence_id long, offset long, " \
         "sequence_length long, tier long, step_group long"
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())]
                   + [(c, pa.int64()) for c in ("length", "doc_tokens", "sequence_id", "offset",
                                                "sequence_length", "tier", "step_group")])


class _Pool:
    """Items (document, start, length) by length, with the set of lengths as bits of one integer."""

    def __init__(self, items):
        self.by_length: dict[int, list] = {}
        self.bits = 0
        for doc, start, length in items:
            self.add(doc, start, length)

    def add(self, doc, start, length):
        self.by_length.setdefault(length, []).append((doc, start))
        self.bits |= 1 << length

    def take(self, length):
        left = self.by_length[length]
        doc, start = left.pop()
        if not left:
            self.bits ^= 1 << length
        return doc, start

    def longest(self, limit):
        """Largest length of at most ``limit``; 0 if there is none."""
        return max(0, (self.bits & ((1 << (limit + 1)) - 1)).bit_length() - 1)

    def shortest_over(self, limit):
        """Smallest length above ``limit``; 0 if there is none."""
        above = self.bits >> (limit + 1)
        return limit + (above & -above).bit_length() if above else 0


def pack_lengths(lengths, tiers=TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences as (tier, pieces); a piece is (document, start, length). Total length is kept exactly."""
    top = tiers[0]
    sequences, items = [], []
    for doc, n in enumerate(lengths):
        whole = n // top
        sequences.extend((top, [(doc, k * top, top)]) for k in range(whole))
        if n % top:
            items.append((doc, whole * top, n % top))
    pool = _Pool(items)
    for tier in tiers:
        while True:
            length = pool.longest(tier)
            if not length or (length <= tier // 2 and tier != tiers[-1]):
                break                       # what is left belongs to shorter tiers
            window, gap = [], tier
            while gap and pool.bits:
                fit = pool.longest(gap)
                if fit:
                    doc, start = pool.take(fit)
                else:                       # cut the shortest item left: its head closes the gap
                    whole_length = pool.shortest_over(gap)
                    doc, start = pool.take(whole_length)
                    pool.add(doc, start + gap, whole_length - gap)
                    fit = gap
                window.append((doc, start, fit))
                gap -= fit
            if gap:
                sequences.extend(_binary_cut(window, tier - gap))
            else:
                sequences.append((tier, window))
    return sequences


def _binary_cut(window, used):
    """The last, unfilled window as sequences of power-of-two lengths."""
    out, queue = [], list(reversed(window))
    for bit in reversed(range(used.bit_length())):
        room, pieces = used & (1 << bit), []
        if not room:
            continue
        while room:
            doc, start, length = queue.pop()
            part = min(room, length)
            pieces.append((doc, start, part))
            if part < length:
                queue.append((doc, start + part, length - part))
            room -= part
        out.append((1 << bit, pieces))
    return out


def step_groups(sizes, budget=STEP_TOKENS) -> list[int]:
    """Group of each sequence: longest first, each to the group with the fewest tokens so far."""
    total = sum(sizes)
    heap = [(0, g) for g in range(max(1, -(-total // budget)))]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, g = heapq.heappop(heap)
        out[i] = g
        heapq.heappush(heap, (load + sizes[i], g))
    return out


def _pack_block(doc_ids, parts, base, step_base, tiers, step_tokens):
    lengths = [len(p) for p in parts]
    sequences = pack_lengths(lengths, tiers)
    groups = step_groups([sum(p[2] for p in pieces) for _, pieces in sequences], step_tokens)
    rows, held = [], 0
    for k, (tier, pieces) in enumerate(sequences):
        offset, whole = 0, sum(p[2] for p in pieces)
        for doc, start, length in pieces:
            blob = parts[doc][start:start + length].tobytes()
            rows.append((doc_ids[doc], start, blob, length, lengths[doc], base + k, offset, whole, tier,
                         step_base + groups[k]))
            offset += length
            held += len(blob)
        if held > MAX_BATCH_BYTES:
            yield _batch(rows)
            rows, held = [], 0
    if rows:
        yield _batch(rows)
    return len(sequences), max(groups, default=-1) + 1


def _batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", tiers=TIERS, end_id: int = END_ID,
                   block_tokens: int = BLOCK_TOKENS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece, with its ids (little-endian unsigned 32-bit), sequence, place, tier and step group."""
    path = tokens.tokenizer_path(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(path, "spaces_dropped")
        partition = TaskContext.get().partitionId()
        base = step_base = partition << 36
        doc_ids, parts, held = [], [], 0
        end = np.array([end_id], dtype=np.uint32)
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            for lo, hi in tokens.chunks(texts.fill_null(""), CHUNK_BYTES):
                ids, offsets = enc.ids(texts.slice(lo, hi - lo))
                for i in range(lo, hi):
                    doc_ids.append(names[i])
                    parts.append(np.concatenate([ids[offsets[i - lo]:offsets[i - lo + 1]], end]))
                    held += len(parts[-1])
                    if held >= block_tokens:
                        n, g = yield from _pack_block(doc_ids, parts, base, step_base, tiers, step_tokens)
                        base, step_base = base + n, step_base + g
                        doc_ids, parts, held = [], [], 0
                        give_back()
        if parts:
            yield from _pack_block(doc_ids, parts, base, step_base, tiers, step_tokens)
        parts = doc_ids = None
        enc.forget()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of the ids."""
    return pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32")
