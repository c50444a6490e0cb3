"""Secret scan through a trigram inverted index, in built-in functions.

Every rule's expression gives a Boolean trigram query (``trigrams.query``, on the driver, from the rules
alone). The index has a posting list for each trigram that some query asks for: bitmaps of row numbers, one a
block of 32768 rows, built by an aggregation that starts in the map tasks. A clause intersects its trigrams' bitmaps, a
rule unites its clauses'; the bits left are its candidate rows, and only they are verified by the expression. Rules
without a mandatory trigram scan every row.

Scale: rows get a number once, in a table in the shared folder, so bitmaps stay right whatever is computed again;
bitmaps are shuffled, texts aren't, as long as the candidates (row number and rules) are few enough to be broadcast; beyond
``BROADCAST_ROWS`` rows the join is by row number. All matches of a text are found in its own row.

A span is kind:start:end in code points, of the whole match, end exclusive. Matches are leftmost and don't overlap inside a
kind; a match whose guarded group is too short is dropped after matching.

Defined cases: null and empty texts have no spans (the digest is that of the empty string); null doc_ids pass
through; equal rows are scanned each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipwright.llm import trigrams
from shipwright.llm.common import ascii_lower, stage
from shipwright.llm.ngram_join import sized

BITS = 32768                 # rows of a bitmap
COMMON_MARKS = " ."          # other marks are looked for before the trigrams that hold them
BLOCK = 256                  # matches whose spans are put together at once


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str
    group: int = 0           # the guarded group
    least: int = 0           # letters it needs


# The base kinds, in this order. The two bounded repeats stand for "the whole run, dropped if shorter".
BASE = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
]

# Published forms of credentials.
FORMS = [
    Rule("git_token", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("git_scoped", r"github_pat_[A-Za-z0-9_]{22,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("chat_hook", r"hooks\.slack\.com/services/[A-Za-z0-9/]{20,}"),
    Rule("payment", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("map_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("oauth", r"ya29\.[A-Za-z0-9_-]{20,}"),
    Rule("mail_key", r"SG\.[A-Za-z0-9_-]{16,}\.[A-Za-z0-9_-]{16,}"),
    Rule("mail_gun", r"key-[0-9a-f]{32}"),
    Rule("npm", r"npm_[A-Za-z0-9]{36}"),
    Rule("pypi", r"pypi-[A-Za-z0-9_-]{50,}"),
    Rule("model_hub", r"hf_[A-Za-z0-9]{34,}"),
    Rule("shop", r"shp(?:at|ca|pa|ss)_[0-9A-Fa-f]{32}"),
    Rule("droplet", r"do[opr]_v1_[0-9a-f]{64}"),
    Rule("vault", r"hvs\.[A-Za-z0-9_-]{24,}"),
    Rule("monitor", r"NRAK-[A-Z0-9]{27}"),
    Rule("bot", r"[0-9]{8,10}:AA[A-Za-z0-9_-]{33}"),
    Rule("age_key", r"AGE-SECRET-KEY-1[0-9A-Z]{58}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |ENCRYPTED |PGP )?PRIVATE KEY(?: BLOCK)?-----"),
    Rule("cloud_secret", r"""(?i:aws_secret_access_key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9/+=]{40}"""),
    Rule("account_key", r"AccountKey=[A-Za-z0-9+/]{86}=="),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9_.=-]{20,}"),
    Rule("basic", r"(?i:authorization):\x20*(?i:basic)\x20+[A-Za-z0-9+/=]{8,}"),
    Rule("url_login", r"(?:https?|ftp|ssh|mysql|postgres|postgresql|mongodb|redis|amqp)://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{1,64}@"),
]
RULES = BASE + FORMS


def numbered(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): every row with a number from 1 on, written once."""
    return stage(docs.select((F.monotonically_increasing_id() + 1).alias("row"), F.col("doc_id").cast("long"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), "secretrows")


def postings(rows: DataFrame, wanted: list[str]) -> DataFrame:
    """(trigram, bucket, bits): the rows that hold each wanted trigram, by its place in ``wanted``."""
    marks: dict[str, list] = {}
    for i, t in enumerate(wanted):
        marks.setdefault(next((c for c in t if not c.isalnum() and c not in COMMON_MARKS), ""), []).append(F.struct(F.lit(i).alias("i"), F.lit(t).alias("t")))
    table = F.array(*[F.struct(F.lit(m).alias("mark"), F.array(*ts).alias("ts")) for m, ts in marks.items()])
    # the folded text is bound by an outer lambda, so it is made once a row and not once a trigram
    held = F.transform(F.array(ascii_lower(F.col("text"))), lambda folded: F.flatten(F.transform(
        F.filter(table, lambda m: F.contains(folded, m["mark"])), lambda m: F.filter(m["ts"], lambda x: F.contains(folded, x["t"])))))
    found = rows.select("row", F.explode_outer(held[0]).alias("x")).filter("x is not null")      # explode() would make the lists twice
    return found.groupBy(F.col("x.i").alias("trigram"), F.bitmap_bucket_number("row").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("row")).alias("bits"))


def candidates(rows: DataFrame, queries: dict[int, frozenset]) -> DataFrame:
    """(row, rules): the rows that each rule's query leaves, as an array of rule numbers a row."""
    clauses = [(rule, sorted(c)) for rule, q in queries.items() for c in sorted(q, key=sorted)]
    wanted = sorted({t for _, c in clauses for t in c})
    uses = F.array(*[F.array(*[F.lit(k) for k, (_, c) in enumerate(clauses) if t in c]) for t in wanted])
    size = F.array(*[F.lit(len(c)) for _, c in clauses])
    rule = F.array(*[F.lit(r) for r, _ in clauses])
    lists = postings(rows, wanted).select("bucket", "bits", F.explode(F.get(uses, F.col("trigram"))).alias("clause"))
    hit = lists.groupBy("clause", "bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("n"))
    hit = hit.filter(F.col("n") == F.get(size, F.col("clause"))).withColumn("rule", F.get(rule, F.col("clause")))
    left = hit.groupBy("rule", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    # the set bits of a bitmap: its bytes that aren't zero, then their bits
    full = left.select("rule", "bucket", F.explode(F.expr(
        f"filter(transform(sequence(0, {BITS // 8 - 1}), i -> struct(i as i, substring(bits, i + 1, 1) as b)), x -> x.b <> X'00')")).alias("x"))
    byte = full.select("rule", "bucket", "x.i", F.conv(F.hex("x.b"), 16, 10).cast("int").alias("byte"))
    bits = byte.select("rule", "bucket", "i", F.explode(F.expr("filter(sequence(0, 7), k -> (byte & shiftleft(1, k)) <> 0)")).alias("k"))
    return bits.groupBy(((F.col("bucket") - 1) * BITS + F.col("i") * 8 + F.col("k") + 1).alias("row")).agg(
        F.collect_list("rule").alias("rules"))


def _spans() -> str:
    """SQL for the spans (s, kind, e) of one rule's matches ``h.m``, found between the pieces ``h.p``; ``h.g`` are the guarded groups.

    Blocks of matches are put together first, so that a text with many matches isn't copied for each of them.
    """
    return f"""flatten(aggregate(
        sequence(0, (size(h.m) - 1) div {BLOCK}),
        struct(cast(0 as int) as at, cast(array() as array<array<struct<s: int, kind: int, e: int>>>) as blocks),
        (all, b) -> transform(array(aggregate(
            sequence(b * {BLOCK}, least(size(h.m), (b + 1) * {BLOCK}) - 1),
            struct(all.at as at, cast(array() as array<struct<s: int, kind: int, e: int>>) as found),
            (acc, i) -> struct(
                cast(acc.at + char_length(h.p[i]) + char_length(h.m[i]) as int) as at,
                if(char_length(h.g[i]) < h.least, acc.found, concat(acc.found, array(struct(
                    cast(acc.at + char_length(h.p[i]) as int) as s, h.kind as kind,
                    cast(acc.at + char_length(h.p[i]) + char_length(h.m[i]) as int) as e)))) as found))),
            x -> struct(x.at as at, concat(all.blocks, array(x.found)) as blocks))[0],
        all -> all.blocks))"""


def with_spans(rows: DataFrame, rules: list[Rule], full: list[int]) -> DataFrame:
    """Adds the spans of every rule that is a candidate of the row (column ``rules``) or scans fully, by start and kind."""
    tried = []
    for i, r in enumerate(rules):
        due = F.lit(True) if i in full else F.array_contains("rules", i)
        found = [F.when(due, F.regexp_extract_all("text", F.lit(r.regex), F.lit(g))) for g in sorted({0, r.group})]
        tried.append(F.struct(F.lit(i).alias("kind"), F.lit(r.regex).alias("re"), F.lit(r.least).alias("least"),
                              found[0].alias("m"), found[-1].alias("g")))
    rows = rows.withColumn("hits", F.filter(F.array(*tried), lambda h: F.size(h["m"]) > 0))
    cut = F.expr("transform(hits, h -> struct(h.kind as kind, h.least as least, h.m as m, h.g as g, split(text, h.re, -1) as p))")
    rows = rows.withColumn("cut", cut).drop("hits")
    return rows.withColumn("spans", F.expr(f"array_sort(flatten(transform(cut, h -> {_spans()})))")).drop("cut")


def as_text(spans: Column | str, rules: list[Rule]) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"], x["e"])), ",")


def find_secrets(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(row, doc_id, text, spans): all spans of every row, as (s, kind, e) with the rule's number as kind."""
    queries = {i: trigrams.query(r.regex) for i, r in enumerate(rules)}
    full = [i for i, q in queries.items() if q == trigrams.ANY]
    rows = numbered(docs)
    indexed = {i: q for i, q in queries.items() if i not in full}
    if indexed:
        found = stage(candidates(rows, indexed), "secretcandidates")
        rows = rows.join(sized(found), "row", "left")
    else:
        rows = rows.withColumn("rules", F.lit(None).cast("array<int>"))
    return with_spans(rows, rules, full)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row."""
    found = find_secrets(docs)
    base = F.filter("spans", lambda x: x["kind"] < len(BASE))
    counts = [F.expr(f"cast(size(filter(spans, x -> x.kind = {k})) as long)").alias(f"n_{r.kind}") for k, r in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(as_text(base, RULES), 256).alias("base_sha256"), as_text("spans", RULES).alias("spans"))
