import pytest

from shipwright.llm import tokens
from tests.llm.test_ngram_join import brute_components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    """Every stage's input and output, written and read like the pipeline does."""
    import corpus_pipeline as P
    from shipwright.llm.common import stage, table
    docs, out = table(spark, SF, "documents"), []
    for name, fn in P.STAGES:
        after = stage(fn(spark, docs, SF), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return out


def test_stages_keep_the_columns(outputs):
    assert [n for n, _, _ in outputs] == ["language_id", "ngram_jaccard_join", "mix_sources", "packing"]
    for _, before, after in outputs[:-1]:
        assert after.columns == before.columns


def test_language_stage_keeps_clean_documents(outputs):
    _, before, after = outputs[0]
    lost = before.join(after, "doc_id", "left_anti").collect()
    assert all(not any(c.isalpha() for c in r.text or "") for r in lost)


def test_one_document_of_each_group_stays(outputs):
    _, before, after = outputs[1]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    want = sorted({c for _, c in brute_components(rows).values()})
    assert sorted(r.doc_id for r in after.collect()) == want


def test_repeated_and_null_doc_ids_lose_copies_only(spark):
    import corpus_pipeline as P
    text, other, third = ("one two three four five six seven", "quite another text of eight words it is", "a third text that nobody else has here")
    rows = [(1, text), (1, text), (2, text), (None, other), (None, other), (None, text), (1, third), (None, ""), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in P.ngram_jaccard_join(spark, docs, SF).collect()), key=str)
    assert got == sorted([(1, text), (None, other), (1, third), (None, ""), (9, "")], key=str)


def test_mix_repeats_whole_documents(outputs):
    _, before, after = outputs[2]
    texts = {r.doc_id: r.text for r in before.collect()}
    got = after.collect()
    assert {r.doc_id for r in got} == set(texts) and all(r.text == texts[r.doc_id] for r in got)


def test_mix_is_in_the_order_of_the_stream(outputs):
    from shipwright.llm import mixing
    _, before, _ = outputs[2]
    before = before.limit(150).cache()
    want = [r.doc_id for r in mixing.mixed_stream(before, block_tokens=5000).orderBy("block", "slot").collect()]
    got = [r.doc_id for r in mixing.mixed_documents(before, block_tokens=5000).collect()]
    assert got == want and got != sorted(got)


def test_pieces_cover_the_mix(outputs):
    _, before, after = outputs[3]
    enc = tokens.encoder(tokens.tokenizer_path("word_bpe_49k.json"), "spaces_dropped")
    want = sum(len(enc.whole(r.text or "")) + 1 for r in before.collect())
    assert after.agg({"length": "sum"}).first()[0] == want


def test_registered_and_guarded(spark):
    import __spark_entry__ as E
    names = E.queries()
    assert "pipeline" in names and all(sum(k.startswith(f"op{n}_") for k in names) == 1 for n in range(1, 11))
    assert {"op2_warc_salvage", "op4_exact_top_k"} <= set(E.oracle_sql())


@pytest.fixture()
def clashing(spark):
    """Documents with the names that stages use inside."""
    from pyspark.sql import functions as F
    rows = [(i, f"The quick brown fox number {i // 2} jumps over the lazy dog and the river bank", "en", "a", 60) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    return docs.select("*", *[F.lit(7).alias(c) for c in ("_row", "_copy", "_lang_pred", "_lang_score", "component_id", "_id")])


def test_clashing_columns_come_through(spark, clashing):
    import corpus_pipeline as P
    for fn, left in ((P.language_id, 12), (P.ngram_jaccard_join, 6)):
        out = fn(spark, clashing, SF)
        assert out.columns == clashing.columns
        rows = out.collect()
        assert len(rows) == left and {(r._row, r._copy, r._lang_pred, r._lang_score) for r in rows} == {(7, 7, 7, 7)}


def test_empty_and_wordless_tables(spark, clashing):
    import corpus_pipeline as P
    from pyspark.sql import functions as F
    empty, blank = clashing.limit(0), clashing.withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(None).cast("long"))
    assert P.language_id(spark, empty, SF).count() == 0 and P.language_id(spark, blank, SF).count() == 0
    assert P.ngram_jaccard_join(spark, empty, SF).count() == 0 and P.ngram_jaccard_join(spark, blank, SF).count() == 12
    assert P.pack(spark, P.mix_sources(spark, empty, SF), SF).count() == 0


def test_copies_of_texts_are_written_with_zstd(spark, tmp_path, monkeypatch):
    """Row numbers are written beside whole texts by the join and by the mix; both copies lie on disk until their reader ends."""
    import glob

    import corpus_pipeline as P
    import pyarrow.parquet as pq
    from shipwright.llm import common, mixing
    monkeypatch.setattr(common, "scratch_root", lambda _, name: str(tmp_path / name))
    words = [f"w{(i * 7919 + j * j) % 9973}" for i in range(40) for j in range(30)]
    rows = [(i, " ".join(words[i * 30:(i + 1) * 30]), "en", f"s{i % 3}", 200) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    assert sorted(r.text for r in P.ngram_jaccard_join(spark, docs, SF).collect()) == sorted(r[1] for r in rows)
    assert {r.text for r in mixing.mixed_documents(docs).collect()} == {r[1] for r in rows}
    for tag in ("joinrows", "mixdocs"):
        files = glob.glob(str(tmp_path / f"llm-{tag}-*" / "*.parquet"))
        found = {pq.ParquetFile(f).metadata.row_group(g).column(c).compression
                 for f in files for g in range(pq.ParquetFile(f).num_row_groups) for c in range(pq.ParquetFile(f).metadata.num_columns)}
        assert found == {"ZSTD"}, tag
