"""Registered queries of the training-data operators: thin wrappers with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipwright.llm import (
    codes, langid, licenses, minhash, mixing, ngram_join, packing, secret_scan, sharding, spelling, token_counts, topk, warc)
from shipwright.llm.common import shared_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


@query("op1_histogram_shards")
def _op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    checked = docs.select("doc_id", "text", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    out = sharding.shard_documents(checked, 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query("op2_warc_salvage")
def _op2(spark, sf_dir):
    records = warc.round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op2_warc_salvage"] = """
with p as (
    select page_id, encode(coalesce(html, '')) as payload from pages
), d as (
    select page_id, octet_length(payload) as payload_bytes, sha1(payload) as payload_digest from p
), r as (
    select *, max(page_id) over (partition by payload_digest, payload_bytes) as top from d
)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
    case when payload_bytes >= 1000 and page_id <> top then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 1000 and page_id <> top then top end as refers_to
from r
"""


@query("op3_temperature_mix")
def _op3(spark, sf_dir):
    return mixing.mixed_stream(table(spark, sf_dir, "documents"))


@query("op4_exact_top_k")
def _op4(spark, sf_dir):
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


ORACLE["op4_exact_top_k"] = """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as q from embeddings
    where embedding is not null and vec_id is not null
      and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(cast(x as double)), false)))
), s as (
    select a.vec_id as query_id, b.vec_id, cast(list_dot_product(a.q, b.q) as bigint) as score
    from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q)
    where a.vec_id % 100 = 0
), r as (
    select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score from s
)
select query_id, rank, vec_id, score from r where rank <= 10
"""


@query("op5_pack_documents")
def _op5(spark, sf_dir):
    return packing.piece_digests(packing.pack_documents(table(spark, sf_dir, "documents")))


@query("op6_token_counts")
def _op6(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), shared_path(spark, "tokencache"))


@query("op7_ngram_jaccard_join")
def _op7(spark, sf_dir):
    return ngram_join.near_duplicate_components(table(spark, sf_dir, "documents"))


ORACLE["op7_ngram_jaccard_join"] = """
with recursive w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x20\\x09-\\x0D]+') as ws from documents
), s as (
    select doc_id, case when len(ws) >= 5 then list_distinct([array_to_string(ws[i:i + 4], ' ') for i in range(1, len(ws) - 3)])
                        when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end as grams from w
), x as (
    select doc_id, len(grams) as n, unnest(grams) as gram from s
), shared as (
    select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as common
    from x a join x b on a.gram = b.gram and a.doc_id < b.doc_id group by a.doc_id, b.doc_id
), links as (
    select a, b from shared where 100 * common >= 80 * (na + nb - common)
), ways as (
    select a, b from links union all select b, a from links
), reach as (
    select doc_id as start, doc_id as goal from documents
    union select r.start, w.b from reach r join ways w on w.a = r.goal
)
select s.doc_id, cast(len(s.grams) as bigint) as n_shingles, r.component_id
from s join (select start, min(goal) as component_id from reach group by start) r on r.start = s.doc_id
"""


@query("op8_license_scan")
def _op8(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op9_one_permutation_minhash")
def _op9(spark, sf_dir):
    return minhash.edited_fingerprints(table(spark, sf_dir, "documents"))


@query("op10_language_id")
def _op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out()))
    rows = docs.select(F.col("doc_id").cast("long"), "text", langid.held_out().alias("held_out"))
    return langid.predict(rows, model, ["doc_id", "held_out"])


@query("op11_trigram_secret_scan")
def _op11(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query("op12_bounded_vector_codes")
def _op12(spark, sf_dir):
    return codes.compress(table(spark, sf_dir, "embeddings"))


ORACLE["op12_bounded_vector_codes"] = """
with kept as (
    select vec_id, label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v from embeddings
    where embedding is not null and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(cast(x as double)), false)))
), parts as materialized (
    select vec_id, u.p, v[u.p * (len(v) // 16) + 1:(u.p + 1) * (len(v) // 16)] as part from kept, unnest(range(0, 16)) u(p)
), firsts as (
    select vec_id, row_number() over (order by vec_id) - 1 as e from kept qualify e < 64
), book0 as materialized (
    select x.p, f.e, x.part from firsts f join parts x on x.vec_id = f.vec_id
), near0 as materialized (
    select x.vec_id, x.p, first(b.e order by list_sum(list_transform(list_zip(x.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), b.e) as e, min(list_sum(list_transform(list_zip(x.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) as d
    from parts x join book0 b on b.p = x.p group by x.vec_id, x.p
), mean0 as (
    select p, e, list(m order by i) as part from (
        select n.p, n.e, u.i, floor(sum(x.part[u.i]) / count(*)) as m
        from near0 n join parts x on x.vec_id = n.vec_id and x.p = n.p, unnest(range(1, len(x.part) + 1)) u(i) group by n.p, n.e, u.i) group by p, e
), book1 as materialized (
    select b.p, b.e, coalesce(m.part, b.part) as part from book0 b left join mean0 m on m.p = b.p and m.e = b.e
), near1 as materialized (
    select x.vec_id, x.p, first(b.e order by list_sum(list_transform(list_zip(x.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), b.e) as e, min(list_sum(list_transform(list_zip(x.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) as d
    from parts x join book1 b on b.p = x.p group by x.vec_id, x.p
), mean1 as (
    select p, e, list(m order by i) as part from (
        select n.p, n.e, u.i, floor(sum(x.part[u.i]) / count(*)) as m
        from near1 n join parts x on x.vec_id = n.vec_id and x.p = n.p, unnest(range(1, len(x.part) + 1)) u(i) group by n.p, n.e, u.i) group by p, e
), book2 as materialized (
    select b.p, b.e, coalesce(m.part, b.part) as part from book1 b left join mean1 m on m.p = b.p and m.e = b.e
), near2 as materialized (
    select x.vec_id, x.p, first(b.e order by list_sum(list_transform(list_zip(x.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), b.e) as e, min(list_sum(list_transform(list_zip(x.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) as d
    from parts x join book2 b on b.p = x.p group by x.vec_id, x.p
), digest as (
    select sha256(string_agg(array_to_string(list_transform(part, lambda x: cast(x as bigint)), ','), ',' order by p, e)) as sha from book2
), coded as (
    select vec_id, string_agg(format('{:02x}', e), '' order by p) as code, cast(sum(d) as bigint) as error from near2 group by vec_id
)
select c.vec_id, c.code, c.error, cast(sum(c.error) over (partition by k.label) as bigint) as label_error, digest.sha as codebooks_sha256
from coded c join kept k on k.vec_id = c.vec_id, digest
"""


@query("op13_bitsliced_spelling")
def _op13(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


ORACLE["op13_bitsliced_spelling"] = """
with recursive bits as (
    select cast(r.range as bigint) as b, cast(r.range as bigint) as c, 0 as k from range(256) r
    union all select b, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8
), crc as (
    select list(c order by b) as t from bits where k = 8
), runs as (
    select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[a-z\\x{00C0}-\\x{00FF}]+')) as run from documents
), seen as (
    select doc_id, run, count(*) as n from runs group by doc_id, run
), hexed as (
    select run, n, hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || run)) as x from seen
), hashed as (
    select run, n, xor(4294967295, list_reduce(
        list_prepend(cast(4294967295 as bigint), list_transform(range(1, length(x), 2), lambda i: cast('0x' || substr(x, i, 2) as bigint))),
        lambda a, b: xor(a >> 8, crc.t[1 + xor(a & 255, b)]))) as h
    from hexed, crc
), edited as (
    select case when h % 199 = 0 then substr(run, 1, cast(h % length(run) as bigint)) || substr(run, cast(h % length(run) as bigint) + 2)
                else run end as word, n from hashed
), words as (
    select word, cast(sum(n) as bigint) as n from edited where length(word) >= 6 group by word having sum(n) >= 5
), cuts as (
    select word, n, i, substr(word, 1, i) || substr(word, i + 2) as rest from words, unnest(range(0, length(word))) u(i)
), pairs as (
    select a.word, b.word as other, b.n from cuts a join cuts b on a.rest = b.rest and a.i = b.i and a.word <> b.word
    union select a.word, b.word, b.n from cuts a join words b on a.rest = b.word
    union select b.word, a.word, a.n from cuts a join words b on a.rest = b.word
), near as (
    select word, count(*) as n_near, first(other order by n desc, encode(other)) as other, max(n) as best from pairs group by word
), forms as (
    select w.word, w.n, cast(coalesce(n_near, 0) as bigint) as n_near, case when best >= 5 * w.n then other end as form,
        case when best >= 5 * w.n then best end as form_n
    from words w left join near on near.word = w.word
), chain as (
    select word, word as at, form as ahead from forms
    union all select c.word, f.word, f.form from chain c join forms f on f.word = c.ahead
)
select f.word, f.form, c.at as root, f.n, f.n_near, f.form_n from forms f join chain c on c.word = f.word where c.ahead is null
"""
