import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shipwright.llm import packing, token_counts, tokens
from shipwright.llm.common import shared_path

TEXTS = ["", "a", " a", "a ", "a  b", "a\n\nb", "x\ty", "é.è", "I'm it's don't. A.'s", "<|endoftext|> hi <|startoftext|>", "\x01a b",
         "漢字 かな。テスト", "a b  c", "a.́b", "1.2 3,4 a.b.c", "#a$b%c&d!!?", None, "foo\x1cbar baz", "ﬁ ﬂ ½ ①", "x" * 5000,
         "Ein Text. Noch einer, mit Wörtern;\nneue Zeile | Ende", "tab  em space", "K Å é. É."]


@pytest.mark.parametrize("name, style", [("word_bpe_49k.json", "spaces_dropped"), ("byte_bpe_50k.json", "space_prefixed")])
def test_pieces_give_the_librarys_ids(name, style):
    enc = tokens.PieceEncoder(tokens.tokenizer_path(name), style)
    texts = TEXTS + [" ".join(t or "" for t in TEXTS)] * 2
    ids, offsets = enc.ids(pa.array(texts))
    for i, t in enumerate(texts):
        assert list(ids[offsets[i]:offsets[i + 1]]) == list(enc.whole(t or "")), t
    assert list(enc.counts(pa.array(texts).slice(5, 7))) == [len(enc.whole(t or "")) for t in texts[5:12]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab'sé.,! \n\t \x01<|1́İ", max_size=30), max_size=6))
def test_any_text_encodes_as_a_whole(texts):
    for name, style in [("word_bpe_49k.json", "spaces_dropped"), ("byte_bpe_50k.json", "space_prefixed")]:
        enc = tokens.encoder(tokens.tokenizer_path(name), style)
        ids, offsets = enc.ids(pa.array(texts, pa.string()))
        assert [list(ids[a:b]) for a, b in zip(offsets, offsets[1:])] == [list(enc.whole(t)) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 9000), max_size=60))
def test_packed_lengths_keep_every_token_and_pad_nothing(lengths):
    sequences = packing.pack_lengths(lengths)
    covered = {d: [] for d in range(len(lengths))}
    for tier, pieces in sequences:
        used = sum(p[2] for p in pieces)
        assert used == tier and used & (used - 1) == 0 and used <= 4096
        for d, start, n in pieces:
            covered[d].append((start, n))
    for d, n in enumerate(lengths):
        at = 0
        for start, size in sorted(covered[d]):
            assert start == at
            at += size
        assert at == n


def test_long_gaps_take_shorter_documents():
    sequences = packing.pack_lengths([4000, 3000, 96, 1096, 600, 424])
    assert (4096, [(0, 0, 4000), (2, 0, 96)]) in sequences
    assert (4096, [(1, 0, 3000), (3, 0, 1096)]) in sequences
    assert (1024, [(4, 0, 600), (5, 0, 424)]) in sequences


def test_step_groups_are_balanced():
    sizes = [4096] * 40 + [2048] * 30 + [512] * 100
    groups = packing.step_groups(sizes, 16384)
    loads = np.bincount(groups, weights=sizes)
    assert loads.max() - loads.min() <= 512 and loads.max() <= 16384 + 512
    assert all(len({s for s, g in zip(sizes, groups) if g == k}) > 1 for k in range(len(loads)))


def test_pieces_round_trip(spark, odd_docs):
    enc = tokens.encoder(tokens.tokenizer_path("word_bpe_49k.json"), "spaces_dropped")
    rows = packing.pack_documents(odd_docs.coalesce(1), block_tokens=3000).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
        assert len(r.ids) == 4 * r.length
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == seq[0].sequence_length and at & (at - 1) == 0
    for d in odd_docs.filter("doc_id <> 6").collect():
        want = np.r_[enc.whole(d.text or ""), 2].astype(np.uint32)
        got = b"".join(r.ids for r in sorted(by_doc[d.doc_id], key=lambda r: r.start))
        assert got == want.tobytes() and all(r.doc_tokens == len(want) for r in by_doc[d.doc_id])
    assert sum(r.length for r in by_doc[6]) == 2 * by_doc[6][0].doc_tokens
    first = packing.piece_digests(packing.pack_documents(odd_docs.coalesce(1), block_tokens=3000)).collect()
    assert [r.ids_crc32 for r in first] == [zlib.crc32(r.ids) for r in rows]
    assert packing.pack_documents(odd_docs.limit(0)).count() == 0


def test_counts_come_from_the_cache(spark, odd_docs):
    enc = tokens.encoder(tokens.tokenizer_path("byte_bpe_50k.json"), "space_prefixed")
    cache = shared_path(spark, "testcache")
    rows = token_counts.count_tokens(odd_docs, cache, over=5).collect()
    want = sorted((str(d.doc_id), len((d.text or "").encode()), len(enc.whole(d.text or ""))) for d in odd_docs.collect())
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 5) for r in rows)
    stored = spark.read.parquet(cache)
    assert stored.count() == odd_docs.select(F.coalesce("text", F.lit(""))).distinct().count()   # each text once
    more = odd_docs.union(odd_docs.limit(1).withColumn("text", F.lit("a new text")))
    token_counts.count_tokens(more, cache).collect()
    assert spark.read.parquet(cache).count() == stored.count() + 1                              # only the miss
    forged = stored.limit(1).withColumns({"tokenizer_digest": F.lit("other"), "n_tokens": F.lit(99).cast("long")})
    forged.write.mode("append").parquet(cache)
    assert sorted(r.n_tokens for r in token_counts.count_tokens(odd_docs, cache).collect()) == sorted(r.n_tokens for r in rows)
    assert token_counts.count_tokens(odd_docs.limit(0), cache).count() == 0


def test_packed_blocks_leave_in_small_batches():
    import numpy as np

    from shipwright.llm import packing
    parts = [np.arange(700 + i % 900, dtype=np.uint32) for i in range(3000)]
    batches = list(packing._pack_block(list(range(len(parts))), parts, 0, 0, packing.TIERS, packing.STEP_TOKENS))
    sizes = [sum(len(b) for b in batch.column(2).to_pylist()) for batch in batches]
    assert sum(sizes) == 4 * sum(len(p) for p in parts) and max(sizes) < 3 << 20 < sum(sizes)
