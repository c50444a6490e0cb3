import zlib

import numpy as np
from pyspark.sql import functions as F

from shipwright.llm import sharding


def shards(df, n, **kw):
    rows = sharding.shard_documents(df, n, **kw).collect()
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    return rows


def test_bytes_are_near_equal_though_a_third_are_copies(spark, rnd):
    texts = ["the very same text " * 5] * 700 + ["x" * rnd.randrange(0, 300) + str(i) for i in range(1400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = shards(df, 12)
    assert len(rows) == 2100
    size = np.bincount([r.shard for r in rows], weights=[r["size"] for r in rows], minlength=12)
    assert size.max() - size.min() <= 2 * 320
    assert all(r["size"] == len(r.text.encode()) + 8 for r in rows)
    # the copies fill whole neighbouring shards and share only their first and last
    held = sorted({r.shard for r in rows if r.text == texts[0]})
    assert held == list(range(held[0], held[-1] + 1)) and len(held) <= 6


def test_small_groups_stay_together(spark, rnd):
    texts = [f"text number {i % 500} " * 3 for i in range(2000)]
    rows = shards(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 8)
    spread = {}
    for r in rows:
        spread.setdefault(r.text, set()).add(r.shard)
    assert sum(len(s) > 1 for s in spread.values()) <= 7          # at most one group a splitter


def test_same_answer_for_any_partitioning(spark, odd_docs):
    a = {(r.doc_id, r.text, r.shard, r.slot) for r in shards(odd_docs.repartition(1), 4)}
    assert a == {(r.doc_id, r.text, r.shard, r.slot) for r in shards(odd_docs.repartition(6), 4)}


def test_odd_rows_and_clashing_columns(spark, odd_docs):
    rows = shards(odd_docs.withColumn("_cell", F.lit(1)).drop("_cell"), 4)
    assert len(rows) == 9 and {r.n_chars for r in rows} == {r.n_chars for r in odd_docs.collect()}
    assert all(isinstance(r.shard, int) and r["size"] >= 8 for r in rows)
    assert {r["size"] for r in rows if r.text is None} == {8}
    assert shards(odd_docs.limit(0), 4) == []
    assert len(shards(odd_docs.limit(1), 24)) == 1
    far = spark.createDataFrame([(-(1 << 62), "a"), (1 << 62, "a"), (0, "b")] * 2, "doc_id long, text string")
    assert len(shards(far, 3)) == 6


def test_splitters_meet_the_tolerance_with_bounded_probes(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    rows = shards(df, 10, tolerance=0.01)
    size = np.bincount([r.shard for r in rows], weights=[r["size"] for r in rows])
    assert abs(size / size.mean() - 1).max() <= 0.02 + 20 / size.mean()


def test_query_digest(spark):
    from shipwright.llm.queries import QUERIES
    rows = QUERIES["op1_histogram_shards"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert {r.doc_id: r.text_crc32 for r in rows} == {i: zlib.crc32(t.encode()) for i, t in texts.items()}
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
