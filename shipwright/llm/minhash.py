"""Document fingerprints: one-permutation MinHash with optimal densification, in built-in functions.

Each five-word shingle is hashed once; the top bits of the hash name one of ``BINS`` bins and a
bin keeps its smallest hash. An empty bin takes the value of a non-empty one chosen by a hash of
the (empty, non-empty) pair, the same choice in every document (every non-empty bin is equally
likely and two documents with equal sets choose alike). The fingerprint stores the low
``BITS`` bits of each bin's value, hashed with the bin's number, as hexadecimal text. The likeness of two fingerprints is the share of equal
bins, corrected for equality by chance: (m - c) / (1 - c) with c = 2^-BITS, cut to 0..1.

``edited_fingerprints`` also edits every text: its last quarter is replaced by the head of the
next document in doc_id order. The order comes from a range partitioning of the (doc_id, text
hash) keys alone; texts are shuffled once, by key, and a document sends the document before it only
the head that one needs.

Words are the lower-cased runs of characters other than blank and 0x09-0x0D; one to four words are a
single shingle. Defined cases: null text counts as empty; a text without words has an
empty fingerprint, whose likeness is 1 to another empty one and else 0; rows with equal doc_id
and text are one document with one next document; a null doc_id sorts first; the only
document of a table is its own next one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipwright.llm.common import stage

BINS = 128                    # a power of two
BITS = 8
WIDTH = 5
_SHIFT = 63 - (BINS.bit_length() - 1)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the fingerprint of a text column; the steps are columns of their own, computed once each."""
    hashes, low = f"_{out}_h", f"_{out}_low"
    words = F.filter(F.split(F.lower(text), "[ \t-\r]+"), lambda w: w != "")
    df = df.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    shingles = (
        F.when(F.size(hashes) >= WIDTH, F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WIDTH),
            lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(hashes, i + k) for k in range(WIDTH)]), 1)))
        .when(F.size(hashes) > 0, F.array(F.shiftrightunsigned(F.xxhash64(F.col(hashes)), 1)))
        .otherwise(F.expr("cast(array() as array<bigint>)")))
    df = df.withColumn(hashes, F.sort_array(shingles))
    # ascending, so the first hash of a bin is its smallest
    first = F.filter(F.col(hashes), lambda x, i: (i == 0) | (
        F.shiftright(x, _SHIFT) != F.shiftright(F.get(F.col(hashes), i - 1), _SHIFT)))
    df = df.withColumn(low, first)

    def bin_of(x: Column) -> Column:
        return F.shiftright(x, _SHIFT).cast("int")

    def borrowed(b: Column) -> Column:
        """Value of the non-empty bin with the smallest hash together with bin b."""
        ranked = F.transform(F.col(low), lambda x: F.struct(F.xxhash64(b, bin_of(x)).alias("rank"), x.alias("x")))
        return F.array_min(ranked)["x"]

    def filled(start: Column, stop: Column) -> Column:
        """Values of the empty bins start..stop."""
        none = F.expr("cast(array() as array<bigint>)")
        return F.when(start <= stop, F.transform(F.sequence(start, stop), borrowed)).otherwise(none)

    # the bins in order: before each non-empty one the empty ones since its forerunner
    upto = F.transform(F.col(low), lambda x, i: F.concat(
        filled(F.when(i == 0, 0).otherwise(bin_of(F.get(F.col(low), i - 1)) + 1), bin_of(x) - 1), F.array(x)))
    after = filled(bin_of(F.element_at(F.col(low), -1)) + 1, F.lit(BINS - 1))
    dense = F.when(F.size(low) == BINS, F.col(low)).otherwise(F.concat(F.flatten(upto), after))
    # bits of (value, bin), so values borrowed by many bins don't agree by chance in all of them at once
    packed = F.array_join(F.transform(dense, lambda x, b: F.substring(
        F.hex(F.xxhash64(x, b).bitwiseAND(F.lit((1 << BITS) - 1)) + F.lit(1 << BITS)), 2, BITS // 4)), "")
    return df.withColumn(out, F.when(F.size(low) == 0, F.lit("")).otherwise(F.lower(packed))).drop(hashes, low)


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of the shingle sets of two fingerprints."""
    digits = BITS // 4
    same = F.size(F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.substr(
        F.col(a), i * digits + 1, F.lit(digits)) == F.substr(F.col(b), i * digits + 1, F.lit(digits))))
    chance = 2.0 ** -BITS
    value = F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1 - chance))
    return (F.when(F.col(a) == F.col(b), F.lit(1.0)).when((F.col(a) == "") | (F.col(b) == ""), F.lit(0.0))
            .otherwise(value))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row."""
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return with_fingerprint(texts, "text", "fingerprint").drop("text")


def neighbours(keys: DataFrame) -> DataFrame:
    """Distinct (doc_id, th, n_chars) with the key after (next_*) and before (prev_*, prev_chars), going round.

    Rows are dealt to cells by ranges of the key; neighbours inside a cell come from a window over
    that cell, those across cells from the (few) cells' first and last keys.
    """
    cells = stage(keys.distinct().repartitionByRange("doc_id", "th").withColumn("cell", F.spark_partition_id()), "cells")
    key = F.struct("doc_id", "th", "n_chars")
    inside = Window.partitionBy("cell").orderBy(F.col("doc_id").asc_nulls_first(), "th")
    across = Window.orderBy("cell")              # one row a cell, as many as shuffle partitions
    whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = cells.groupBy("cell").agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    ends = ends.select("cell", F.coalesce(F.lead("lo").over(across), F.first("lo").over(whole)).alias("after"),
                       F.coalesce(F.lag("hi").over(across), F.last("hi").over(whole)).alias("before"))
    near = cells.select("cell", "doc_id", "th", F.lead(key).over(inside).alias("next"), F.lag(key).over(inside).alias("prev"))
    near = near.join(ends, "cell").select("doc_id", "th", F.coalesce("next", "after").alias("next"),
                                          F.coalesce("prev", "before").alias("prev"))
    return near.select("doc_id", "th", F.col("next.doc_id").alias("next_id"), F.col("next.th").alias("next_th"),
                       F.col("prev.doc_id").alias("prev_id"), F.col("prev.th").alias("prev_th"),
                       F.col("prev.n_chars").alias("prev_chars"))



def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.withColumn("th", F.xxhash64("text"))
    near = stage(neighbours(texts.select("doc_id", "th", F.char_length("text").cast("long").alias("n_chars"))), "next")
    placed = texts.join(near.select(F.col("doc_id").alias("k"), F.col("th").alias("kt"), "next_id", "next_th", "prev_id",
                                    "prev_th", "prev_chars"),
                        [F.col("doc_id").eqNullSafe(F.col("k")), F.col("th") == F.col("kt")]).drop("k", "kt")
    heads = placed.select(F.col("prev_id").alias("k"), F.col("prev_th").alias("kt"), F.expr(
        "left(text, cast(prev_chars div 4 as int))").alias("head")).dropDuplicates(["k", "kt"])
    both = placed.join(heads, [F.col("doc_id").eqNullSafe(F.col("k")), F.col("th") == F.col("kt")])
    both = both.select("doc_id", "th", "next_id", "next_th", F.char_length("text").cast("long").alias("n_chars"), "text", "head")
    both = both.withColumn("edited", F.concat(F.expr("left(text, cast(n_chars - n_chars div 4 as int))"), "head"))
    both = both.withColumn("edited_sha256", F.sha2("edited", 256))
    both = with_fingerprint(with_fingerprint(both, "text", "fingerprint"), "edited", "edited_fingerprint")
    rows = stage(both.drop("text", "edited", "head"), "fingerprints")
    after = rows.select(F.col("doc_id").alias("k"), F.col("th").alias("kt"),
                        F.col("fingerprint").alias("next_fingerprint")).dropDuplicates(["k", "kt"])
    out = rows.join(after, [F.col("next_id").eqNullSafe(F.col("k")), F.col("next_th") == F.col("kt")])
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
                      likeness("fingerprint", "next_fingerprint").alias("near_next"))
