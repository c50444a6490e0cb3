import gzip
import hashlib
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shipwright.llm import warc
from shipwright.llm.common import shared_path


def record(i, size=50):
    payload = bytes([65 + i % 26]) * size
    return warc.record_bytes(i, f"http://x/{i}", hashlib.sha1(payload).hexdigest(), size, payload)


def parts(data, read_bytes=64):
    stream = io.BytesIO(data)
    found = list(warc.salvage(stream.read, read_bytes))
    return [x[2]["page_id"] for x in found if x[0] == "record"], [(x[1], x[2][0]) for x in found if x[0] == "gap"]


@pytest.mark.parametrize("read_bytes", [16, 100, 1 << 20])
@pytest.mark.parametrize("packed", [True, False])
def test_damaged_record_is_skipped_and_logged(packed, read_bytes):
    form = warc.gzip_member if packed else bytes
    chunks = [form(record(i, 40 + i)) for i in range(6)]
    at = [sum(map(len, chunks[:i])) for i in range(7)]
    assert parts(b"".join(chunks), read_bytes) == ([0, 1, 2, 3, 4, 5], [])
    # a flipped byte inside record 2
    bad = bytearray(chunks[2])
    bad[len(bad) - 15] ^= 0xFF
    assert parts(b"".join([*chunks[:2], bytes(bad), *chunks[3:]]), read_bytes) == ([0, 1, 3, 4, 5], [(at[2], at[3])])
    # bytes cut out of record 3, junk in front, an end that is missing
    cut = chunks[3][:200] + chunks[3][220:]
    ids, gaps = parts(b"junk" + b"".join([*chunks[:3], cut, *chunks[4:]]), read_bytes)
    assert ids == [0, 1, 2, 4, 5] and gaps == [(0, 4), (4 + at[3], 4 + at[4] - 20)]
    ids, gaps = parts(b"".join(chunks)[:-7], read_bytes)
    assert ids == [0, 1, 2, 3, 4] and gaps == [(at[5], at[6] - 7)]


def test_version_line_inside_a_payload_is_not_a_record():
    inner = record(9)
    outer = warc.record_bytes(1, None, hashlib.sha1(inner).hexdigest(), len(inner), inner)
    assert parts(outer + record(2)) == ([1, 2], [])


def test_wrong_digest_and_mixed_forms():
    wrong = warc.record_bytes(7, None, "0" * 40, 3, b"abc")
    data = record(1) + warc.gzip_member(record(2)) + wrong + warc.gzip_member(record(3) + record(4))
    ids, gaps = parts(data)
    assert ids == [1, 2, 3, 4] and len(gaps) == 1 and gaps[0][1] - gaps[0][0] == len(wrong)


@settings(max_examples=80, deadline=None)
@given(st.binary(max_size=200), st.integers(0, 400), st.booleans())
def test_any_damage_keeps_the_records_around_it(junk, where, packed):
    form = warc.gzip_member if packed else bytes
    good = [form(record(i)) for i in range(3)]
    middle = form(record(8))
    data = good[0] + middle[:where % len(middle)] + junk + good[1] + good[2]
    ids, gaps = parts(data, 128)
    assert ids[0] == 0 and ids[-1] == 2
    covered = sum(b - a for a, b in gaps)
    assert covered <= len(data) - len(good[0]) - len(good[2])


@pytest.mark.parametrize("read_bytes", [16, 100, 1 << 20])
@pytest.mark.parametrize("level", [0, 4])
def test_one_bad_record_of_a_member_costs_only_itself(read_bytes, level, monkeypatch):
    wrong = warc.record_bytes(7, None, "0" * 40, 3, b"abc")
    member = warc.gzip_member(record(1) + record(2) + wrong + record(3) + b"junk" + record(4), level)
    data = warc.gzip_member(record(0), level) + member + record(5)
    ids, gaps = parts(data, read_bytes)
    first = len(warc.gzip_member(record(0), level))
    assert ids == [0, 1, 2, 3, 4, 5] and gaps == [(first, first + len(member))] * 2
    # a tail that is missing: the last record goes with it
    many = warc.gzip_member(b"".join(record(i, 300 + i) for i in range(10, 30)), level)
    ids, gaps = parts(many[:-9] + warc.gzip_member(record(5), level), read_bytes)
    assert ids[:-1] == list(range(10, 10 + len(ids) - 1)) and len(ids) >= 18 and ids[-1] == 5 and gaps == [(0, len(many) - 9)]
    # the limit holds for a record, not for a member of many
    stream = io.BytesIO(many)
    found = list(warc.salvage(stream.read, read_bytes, max_record=1000))
    assert [x[2]["page_id"] for x in found] == list(range(10, 30))


@pytest.mark.parametrize("packed", [True, False])
def test_long_headers_and_large_records(packed):
    form = warc.gzip_member if packed else bytes
    url = "data:text/html;base64," + "QUJD" * 100_000                      # 400,000 characters
    payload = b"page"
    long = warc.record_bytes(2, url, hashlib.sha1(payload).hexdigest(), len(payload), payload)
    large = record(3, 5 << 20)
    data = form(record(1)) + form(long) + form(large) + form(record(4))
    for read_bytes in (1000, 1 << 20):
        found = list(warc.salvage(io.BytesIO(data).read, read_bytes))
        assert [x[0] for x in found] == ["record"] * 4 and found[1][2]["url"] == url and found[2][2]["payload_bytes"] == 5 << 20
    # a length that no value can have is damage; one of more than a gigabyte isn't
    head = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\nabc"
    with pytest.raises(warc.More):
        warc.parse_record(head % ((1 << 30) + 5))
    with pytest.raises(warc.BadRecord):
        warc.parse_record(head % ((1 << 31) + 1))
    assert [x[0] for x in warc.salvage(io.BytesIO(data).read, 1000, max_record=100_000)] == ["record", "gap", "record"]


def test_every_archive_is_a_task_of_its_own(spark):
    pages = spark.range(64).selectExpr("id as page_id", "'u' as url", "repeat(cast(id as string), 600) as html").repartition(8)
    manifest = warc.write_archives(pages, shared_path(spark, "warctasks"), archive_bytes=1)
    n = manifest.count()
    read = warc.read_archives(manifest)
    assert n == 64 and read.rdd.getNumPartitions() == 64
    from pyspark.sql import functions as F
    assert {r["count"] for r in read.groupBy(F.spark_partition_id().alias("p")).count().collect()} == {1}


def test_pages_with_long_urls_and_clashing_columns(spark):
    from pyspark.sql import functions as F
    rows = [(1, "u", "one"), (2, "data:" + "x" * 300_000, "two" * 500), (3, "v", "two" * 500), (4, "w", "y" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    clash = pages.select("*", *[F.lit("z").alias(c) for c in ("digest", "payload", "member", "n", "salt", "answer", "path", "top")])
    want = {(i, len(h), hashlib.sha1(h.encode()).hexdigest(), "revisit" if i == 2 else "response", 3 if i == 2 else None) for i, _, h in rows}
    for df in (pages, clash):
        got = warc.round_trip(df).collect()
        assert {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == want and len(got) == 4


def test_other_tools_read_the_members():
    data = b"".join(warc.gzip_member(record(i)) for i in range(3))
    assert gzip.decompress(data) == b"".join(record(i) for i in range(3))


def test_round_trip(spark):
    big, small = "é" * 600, "s" * 999
    rows = [(1, "http://a b/", big), (5, None, big), (3, "u", big), (2, "u", small), (4, "u", small), (6, "u", None), (7, "u", ""),
            (None, "u", big), (8, "u", "q" * 1000), (8, "u", "q" * 1000), (9, "u", "WARC/1.0\r\n" * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    manifest = warc.write_archives(pages, shared_path(spark, "warctest"), archive_bytes=300)
    got = warc.read_archives(manifest).collect()
    assert len(got) == len(rows) and warc.quarantined(manifest).count() == 0
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in got)
    assert kinds == sorted([("1", "revisit", 5), ("5", "response", None), ("3", "revisit", 5), ("2", "response", None), ("4", "response", None),
                            ("6", "response", None), ("7", "response", None), ("None", "response", None), ("8", "response", None),
                            ("8", "response", None), ("9", "response", None)], key=str)
    html = {p: (h or "").encode() for p, _, h in rows}
    for r in got:
        assert r.payload_digest == hashlib.sha1(html[r.page_id]).hexdigest() and r.payload_bytes == len(html[r.page_id])
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == html[r.page_id]
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_archives_of_other_stores(spark, tmp_path):
    data = [warc.gzip_member(record(i)) for i in range(4)]
    (tmp_path / "a.warc.gz").write_bytes(data[0] + b"\x1f\x8b\x08broken" + data[1])
    (tmp_path / "b.warc").write_bytes(record(2) + record(3))
    records, gaps = warc.read_files(spark, f"{tmp_path}/*")
    assert sorted(r.page_id for r in records.collect()) == [0, 1, 2, 3]
    (gap,) = gaps.collect()
    assert (gap.gap_start, gap.gap_end) == (len(data[0]), len(data[0]) + 9) and gap.path.endswith("a.warc.gz")
