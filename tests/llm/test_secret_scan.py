import hashlib
import re

import pytest
from pyspark.sql import functions as F

from shipwright.llm import secret_scan as S
from shipwright.llm import trigrams
from shipwright.llm.queries import QUERIES

ALNUM = "ABCDEFabcdef0123456789ghiXYZ"


def brute_spans(text, rules=S.RULES):
    """Every rule tried on the whole text, without an index."""
    found = [(m.start(), k, m.end()) for k, r in enumerate(rules) for m in re.finditer(r.regex, text or "", re.ASCII)
             if len(m[r.group]) >= r.least]
    return sorted(found)


def brute_row(doc, text):
    spans = brute_spans(text)

    def joined(some):
        return ",".join(f"{S.RULES[k].kind}:{a}:{b}" for a, k, b in some)
    base = [x for x in spans if x[1] < 3]
    return (doc, *[sum(x[1] == k for x in base) for k in range(3)], hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))


def example(regex, rnd):
    """A text that the expression matches."""
    from re import _constants as ops
    from re import _parser

    def walk(items):
        out = ""
        for op, v in items:
            if op is ops.LITERAL:
                out += chr(v)
            elif op is ops.IN:
                choices = [chr(c) for o, x in v if o is not ops.NEGATE for c in ([x] if o is ops.LITERAL else range(x[0], x[1] + 1))]
                negated = any(o is ops.NEGATE for o, _ in v)
                out += rnd.choice([c for c in ALNUM if c not in choices]) if negated else rnd.choice(choices)
            elif op is ops.SUBPATTERN:
                out += walk(v[-1])
            elif op is ops.BRANCH:
                out += walk(rnd.choice(v[1]))
            else:
                low, high, inner = v
                out += "".join(walk(inner) for _ in range(rnd.randint(low, min(high, low + 9))))
        return out
    return walk(_parser.parse(regex))


def test_every_match_holds_a_clause_of_its_query(rnd):
    for rule in S.RULES:
        q = trigrams.query(rule.regex)
        for _ in range(60):
            text = example(rule.regex, rnd)
            assert re.search(rule.regex, text, re.ASCII), (rule.kind, text)
            folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            assert any(all(t in folded for t in clause) for clause in q), (rule.kind, text)
    assert trigrams.query(S.BASE[2].regex) == trigrams.ANY and trigrams.query(S.BASE[1].regex) == {frozenset({"aki", "kia"})}


@pytest.mark.parametrize("regex, want", [
    ("abcd", {("abc", "bcd")}), ("ab(?:cd|ef)gh", {("bcd", "cdg", "dgh"), ("bef", "efg", "fgh")}), ("a?bcd", {("bcd",)}),
    ("abc|xy", {()}), ("(?:abc)+", {("abc",)}), ("(?:abc)*", {()}), ("ab.cd", {()}), ("abc.cde", {("abc", "cde")}), ("x[0-9]+yzw", {("yzw",)}),
    ("A[bB]C", {("abc",)}), ("ab{3}c", {("abb", "bbb", "bbc")}), ("(?=abc)q", {()}), ("^abc$", {("abc",)}), ("[^a]bcd", {("bcd",)})])
def test_queries_of_expressions(regex, want):
    assert {tuple(sorted(c)) for c in trigrams.query(regex)} == {tuple(sorted(c)) for c in want}


def test_scan_as_by_trying_every_rule(spark, rnd):
    rows = []
    for i in range(300):
        bits = [rnd.choice(["el paso", "Passwort é", "key", "漢字", "tok", "en", "=", " "]) for _ in range(rnd.randint(0, 12))]
        for rule in rnd.sample(S.RULES, rnd.choice([0, 0, 1, 2, 5])):
            bits.insert(rnd.randint(0, len(bits)), example(rule.regex, rnd))
        rows.append((i, rnd.choice([" ", "", "\n"]).join(bits)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, S.scan(df).collect()))
    assert got == sorted(brute_row(*r) for r in rows)
    assert {k.split(":")[0] for r in got for k in r[5].split(",") if k} == {r.kind for r in S.RULES}


def test_only_candidates_are_tried(spark, rnd):
    rows = [(i, "wholly plain prose about nothing") for i in range(100)] + [(200, 'Token = "abc123" AKIA' + "Q" * 16)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    numbered = S.numbered(df)
    queries = {i: trigrams.query(r.regex) for i, r in enumerate(S.RULES)}
    found = S.candidates(numbered, {i: q for i, q in queries.items() if q != trigrams.ANY}).join(numbered, "row").collect()
    assert [(r.doc_id, sorted(r.rules)) for r in found] == [(200, [0, 1])]


def test_bitmaps_over_many_blocks(spark):
    n = 3 * S.BITS + 17
    rows = spark.range(1, n).select(F.col("id").alias("row"), F.when(F.col("id") % 1009 == 0, F.lit("xabcx")).otherwise(F.lit("x")).alias("text"))
    found = S.candidates(rows, {5: trigrams.query("abc"), 6: trigrams.query("abc|xyz"), 7: trigrams.query("abcz")})
    assert {r.row: sorted(r.rules) for r in found.collect()} == {k: [5, 6] for k in range(1009, n, 1009)}


def test_dropped_matches_still_take_their_text(spark):
    texts = ["token:token = abcdef", "password=12345 secret: 123456", "API_KEY='a.b/c=d'", "tokens = abcdefg", "apikey=", "toKen\"  :  \"abcdef\"",
             "AKIA" + "A" * 15 + "a" + "AKIA" + "B" * 16, "0" * 23 + "g" + "0" * 24 + "G", "tokenK=abcdef", "x" * 40_000 + " secret=abcdef " * 900]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(map(tuple, S.scan(df).collect())) == sorted(brute_row(*r) for r in enumerate(texts))


def test_odd_rows(spark, odd_docs):
    want = sorted((brute_row(r.doc_id, r.text) for r in odd_docs.collect()), key=str)
    assert sorted(map(tuple, S.scan(odd_docs).collect()), key=str) == want
    assert S.scan(odd_docs.filter("doc_id < 0")).count() == 0
    clash = odd_docs.select("doc_id", "text", *[F.lit("z").alias(c) for c in ("row", "rules", "hits", "spans", "cut")])
    assert sorted(map(tuple, S.scan(clash).collect()), key=str) == want
    none = S.find_secrets(odd_docs, [S.Rule("long", "[0-9]{40,}")])           # nothing to index
    assert none.count() == odd_docs.count()


def test_plan_is_native(spark):
    plan = QUERIES["op11_trigram_secret_scan"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
