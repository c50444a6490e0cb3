"""License scan with ordered signature rules, in built-in functions.

A text becomes its words (A-Z lower-cased, marks as blanks) with one blank between them. The rules'
distinct keywords are looked up once a text; a text with none of them is done after that. For the others
each rule whose keyword the text holds is tried; its matches are intervals of words. An interval that lies inside another one of a higher or equal
priority (of equal ones: the longer, then the earlier rule) is suppressed; the rest give the labels.
Base phrases are counted at all their places and are never suppressed.

One narrow shuffle: every text gives a row for itself and one for each detection; a window over the
detections of a text finds the suppressed ones, and a text's rows are bounded by its words.
Texts themselves are never shuffled.

Defined cases: null, empty and wordless texts have 0 words and no labels; null doc_ids pass through;
equal rows are scanned each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipwright.llm.common import ascii_lower
from shipwright.llm.license_rules import BASE, Rule, rules

CONFIDENCE = {3: 0.95, 2: 0.8, 1: 0.5}      # of a detection, by the rule's priority
_PRIORITIES = sorted(CONFIDENCE)
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def with_canonical(df: DataFrame, text: str, out: str = "canon") -> DataFrame:
    """Adds the text's words with one blank before, between and after them; a single blank without words.

    In two steps, so that the replacement runs once for its three uses.
    """
    words = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, " "))
    padded = F.when(F.col("_words") == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), "_words", F.lit(" ")))
    return df.withColumn("_words", words).withColumn(out, padded).drop("_words")


def _blanks(c: str) -> str:
    return f"(octet_length({c}) - octet_length(replace({c}, ' ', '')))"


def _places(pieces: str, matches: str) -> str:
    """SQL for the intervals (s, e: first and last word) of a regex's matches, from the text cut at them."""
    return f"""aggregate(
        sequence(0, size({matches}) - 1),
        struct(cast(0 as int) as seen, cast(array() as array<struct<s: int, e: int>>) as found),
        (acc, i) -> struct(
            cast(acc.seen + {_blanks(f'get({pieces}, i)')} + {_blanks(f'get({matches}, i)')} as int) as seen,
            concat(acc.found, array(struct(
                cast(acc.seen + {_blanks(f'get({pieces}, i)')} - 1 as int) as s,
                cast(acc.seen + {_blanks(f'get({pieces}, i)')} - 1 + {_blanks(f'get({matches}, i)')} as int) as e))) as found),
        acc -> acc.found)"""


def _bounded(regex: str) -> str:
    return f"(?<= )(?:{regex})(?= )"


def _rule_table(found: list[Rule]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(r.priority).alias("prio"), F.lit(r.label).alias("label"),
                              F.lit(r.keyword).alias("kw"), F.lit(_bounded(r.regex)).alias("re"))
                     for i, r in enumerate(found)])


def detections(docs: DataFrame, found: list[Rule] | None = None) -> DataFrame:
    """Per row: words, base places and all detections with their suppression, as a row for each detection.

    Rows with rule null stand for the texts themselves. ``text_row`` tells texts apart.
    """
    found = rules() if found is None else found
    df = with_canonical(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "text").drop("text")
    df = df.withColumn("text_row", F.monotonically_increasing_id())
    df = df.withColumn("n_words", F.expr(_blanks("canon") + " - 1").cast("long"))
    keywords = F.array(*[F.lit(k) for k in sorted({r.keyword for r in found})])
    df = df.withColumn("keywords", F.filter(keywords, lambda k: F.contains("canon", k)))
    base = F.array(*[F.struct(F.lit(label).alias("label"), F.lit(_bounded(phrase)).alias("re")) for phrase, label in BASE])
    df = df.withColumn("base_rules", F.when(F.contains("canon", F.lit("license ")), base))
    df = df.withColumn("base", F.expr(f"""
        transform(transform(base_rules,
                            r -> struct(r.label as label, split(canon, r.re, -1) as p, regexp_extract_all(canon, r.re, 0) as m)),
                  c -> struct(c.label as label, if(size(c.m) = 0, cast(array() as array<struct<s: int, e: int>>),
                                                   {_places('c.p', 'c.m')}) as at))""")).drop("base_rules")
    df = df.withColumn("rules", F.when(F.size("keywords") > 0, _rule_table(found)))
    df = df.withColumn("hits", F.expr("""
        filter(transform(filter(rules, r -> array_contains(keywords, r.kw)),
                         r -> struct(r.rule as rule, r.prio as prio, r.label as label, r.re as re,
                                     regexp_extract_all(canon, r.re, 0) as m)), c -> size(c.m) > 0)""")).drop("rules")
    df = df.withColumn("hits", F.expr("""
        transform(hits, c -> struct(c.rule as rule, c.prio as prio, c.label as label, c.m as m,
                                    split(canon, c.re, -1) as p))"""))
    df = df.withColumn("intervals", F.expr(f"""
        concat(array(struct(cast(null as int) as rule, cast(null as int) as prio, cast(null as string) as label,
                            cast(null as int) as s, cast(null as int) as e)),
               coalesce(flatten(transform(hits, c -> transform({_places('c.p', 'c.m')},
                   x -> struct(c.rule as rule, c.prio as prio, c.label as label, x.s as s, x.e as e)))), array()))"""))
    df = df.withColumn("base_at", F.expr("coalesce(flatten(transform(base, b -> transform(b.at, x -> x.s))), cast(array() as array<int>))"))
    df = df.withColumn("base_names", F.expr("coalesce(transform(filter(base, b -> size(b.at) > 0), b -> b.label), cast(array() as array<string>))"))
    df = df.select("text_row", "doc_id", "n_words", F.size("base_at").cast("long").alias("n_base"),
                   F.array_min("base_at").cast("long").alias("first_word"), F.array_max("base_at").cast("long").alias("last_word"),
                   "base_names", F.inline_outer("intervals"))   # never empty; inline() would add a filter that computes it twice
    before = (Window.partitionBy("text_row").orderBy("s", F.col("e").desc(), F.col("prio").desc(), "rule")
              .rowsBetween(Window.unboundedPreceding, -1))
    covered = F.lit(False)
    for p in _PRIORITIES:
        reach = F.max(F.when(F.col("prio") >= p, F.col("e"))).over(before)
        covered = covered | ((F.col("prio") == p) & F.coalesce(reach >= F.col("e"), F.lit(False)))
    return df.withColumn("suppressed", covered)


def scan(docs: DataFrame, found: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row."""
    rows = detections(docs, found)
    confidence = F.lit(0.0)
    for p, c in CONFIDENCE.items():
        confidence = F.when(F.col("prio") == p, F.lit(c)).otherwise(confidence)
    live = F.col("rule").isNotNull() & ~F.col("suppressed")
    per_text = rows.groupBy("text_row").agg(
        *[F.max(F.when(F.col("rule").isNull(), F.col(c))).alias(c) for c in ("doc_id", "n_words", "n_base", "first_word", "last_word")],
        F.max(F.when(F.col("rule").isNull(), F.col("base_names"))).alias("base_names"),
        F.collect_set(F.when(live, F.col("label"))).alias("names"), F.max(F.when(live, confidence)).alias("best"))
    base = F.array_sort(F.array_distinct("base_names"))
    return per_text.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_names", "names")), ",").alias("labels"),
        F.coalesce("best", F.when(F.col("n_base") > 0, F.lit(CONFIDENCE[1])), F.lit(0.0)).alias("score"))
