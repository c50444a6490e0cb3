"""Temperature mixing of sources, in built-in functions.

Sources get weights p^a / sum p^a from their token shares p. The exponent a is bisected between 1 (as they
are) and 0 (all alike): the largest a whose weights reach the target entropy (a part of ln of
the number of sources), or, where some source would then be repeated more often than
``max_epochs``, the smallest a that keeps to that limit. One job evaluates the inner points of several
bisection levels at once. The weights are then realised within a token budget: a source's
documents are laid out as a row of permutations (epochs), each by its own hash order, and cut where the
source's share of the budget is used up; each copy falls into the block of the mixed stream that its
place in the source's row gives, so that every block holds the sources in their weights, and
blocks are permuted inside.

Scale: a table of sources (one row each) is written first and its measured size decides on a broadcast.
Running sums never go over a whole source: hash order is cut into cells of about
``CELL_TOKENS`` tokens, sums run over the cells and inside each cell, so a source with a third of all
rows is spread like any other. The default budget is the smallest at which every document
is read at least once; a given budget cuts large sources.

Native: DataFrame and SQL functions only; the driver holds the exponent and counts.

Defined cases: a null source is a source of its own; null and blank texts have no tokens, weigh nothing and are
copied as often as their place gives; rows with equal doc_id are ordered by a hash of the text; a
table without tokens is returned once, all in epoch 0; an empty table gives no rows; columns
named like the outputs are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shipwright.llm.common import TEXT_CODEC, stage

TARGET_ENTROPY = 0.9          # of ln(number of sources)
MAX_EPOCHS = 4.0
BLOCK_TOKENS = 1_000_000
CELL_TOKENS = 2_000_000
LEVELS = 8                    # bisection levels a job
ROUNDS = 5                    # 8 * 5 levels: the exponent to 2^-40
PLACES_SENT = 500_000         # narrow rows sent to all executors at most
SEED = 17


def word_tokens(text):
    """Tokens of a text: runs of non-blank characters."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long")


def _measures(sources: DataFrame, points: list[float]) -> dict[float, tuple[float, float, float, float]]:
    """At each exponent: entropy of the weights, their norm z, and the largest and smallest share^(a - 1)."""
    rows = sources.filter("share > 0").select("share", F.explode(F.array(*[F.lit(x) for x in points])).alias("a"))
    power, rate = F.pow("share", F.col("a")), F.pow("share", F.col("a") - 1)
    sums = rows.groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.ln("share")).alias("s"),
                                 F.max(rate).alias("top"), F.min(rate).alias("least"))
    return {r["a"]: (math.log(r["z"]) - r["a"] * r["s"] / r["z"], r["z"], r["top"], r["least"]) for r in sums.collect()}


def _bisect(sources: DataFrame, holds, to_exponent) -> float:
    """Largest x in [0, 1] where ``holds`` for the measures at ``to_exponent(x)``; it holds below and fails above."""
    lo, hi = 0.0, 1.0
    if holds(next(iter(_measures(sources, [to_exponent(hi)]).values()))):
        return hi
    for _ in range(ROUNDS):
        points = [lo + (hi - lo) * i / (1 << LEVELS) for i in range(1, 1 << LEVELS)]
        measured = _measures(sources, [to_exponent(x) for x in points])
        good = [x for x in points if holds(measured[to_exponent(x)])]
        lo, hi = max(good, default=lo), min((x for x in points if x > max(good, default=lo)), default=hi)
    return lo


def exponent(sources: DataFrame, target_entropy: float = TARGET_ENTROPY, max_epochs: float = MAX_EPOCHS,
             budget_over_total: float | None = None) -> float:
    """The exponent for a table with the token ``share`` of each source."""
    n = sources.filter("share > 0").count()
    if n < 2:
        return 1.0

    def epochs(m):                           # of the most repeated source, at the budget in use
        _, z, top, least = m
        return top / least if budget_over_total is None else budget_over_total * top / z

    a = _bisect(sources, lambda m: m[0] >= target_entropy * math.log(n), lambda x: x)
    if epochs(_measures(sources, [a])[a]) <= max_epochs:
        return a
    return 1.0 - _bisect(sources, lambda m: epochs(m) <= max_epochs, lambda x: 1.0 - x)


def keyed(docs: DataFrame) -> DataFrame:
    """The rows with what mixing needs of the text: its hash and its tokens."""
    text = F.col("text").cast("string")
    return docs.withColumns({"th": F.xxhash64(text), "n_tokens": word_tokens(text)})


def _unit(epoch, seed: int):
    """A row's place in [0, 1) in its source's permutation of an epoch."""
    h = F.xxhash64(F.lit(seed), epoch.cast("int"), F.col("doc_id"), F.col("th"))
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def _with_source(rows: DataFrame, sources: DataFrame, columns: list[str]) -> DataFrame:
    of = sources.select(F.col("source").alias("_s"), *[F.col(c).alias(f"_{c}") for c in columns])
    return rows.join(of, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")


def _before(rows: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``_before``: tokens ahead of a row in its permutation, from sums over cells and inside the row's cell."""
    rows = rows.withColumn("_cell", F.floor(F.col("_u") * F.col("_cells")).cast("int"))
    along = Window.partitionBy(*by).orderBy("_cell")
    sums = rows.groupBy(*by, "_cell").agg(F.sum("n_tokens").alias("_sum"))
    sums = sums.withColumn("_ahead", F.sum("_sum").over(along) - F.col("_sum")).drop("_sum")
    same = F.lit(True)
    for c in [*by, "_cell"]:
        sums = sums.withColumnRenamed(c, f"_k{c}")
        same = same & F.col(c).eqNullSafe(F.col(f"_k{c}"))
    rows = rows.join(sums, same).drop(*[f"_k{c}" for c in [*by, "_cell"]])
    inside = Window.partitionBy(*by, "_cell").orderBy("_u", "doc_id", "th").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_before", F.col("_ahead") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).drop("_ahead", "_cell")


def source_plan(rows: DataFrame, target_entropy: float = TARGET_ENTROPY, max_epochs: float = MAX_EPOCHS,
                budget: int | None = None, seed: int = SEED) -> DataFrame:
    """One row a source: tokens, share, exponent, weight, budget, whole epochs and, of the last permutation,
    the first row (u, doc_id, th) that the rest of the budget has no room for (null: all fit)."""
    shares = stage(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "mixsources")
    total = shares.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    shares = shares.withColumn("share", F.col("tokens") / F.lit(float(max(1, total))))
    a = exponent(shares, target_entropy, max_epochs, None if budget is None else budget / max(1, total))
    _, z, _, least = _measures(shares, [a]).get(a, (0.0, 1.0, 1.0, 1.0))
    # without a given budget: the smallest at which each source is read once in whole
    full = total * z / least if budget is None else float(budget)
    has = F.col("tokens") > 0
    weighted = shares.withColumn("exponent", F.lit(a)).withColumn(
        "weight", F.when(has, F.round(F.pow("share", F.lit(a)) / F.lit(z), 12)).otherwise(F.lit(0.0)))
    wanted = F.round(F.col("weight") * F.lit(full)).cast("long")
    weighted = weighted.withColumn("budget", F.greatest(wanted, F.col("tokens")) if budget is None else wanted)
    weighted = weighted.withColumn("whole", F.when(has, F.expr("cast(budget div greatest(tokens, 1) as int)")).otherwise(F.lit(1)))
    weighted = stage(weighted.withColumns({
        "rest": F.col("budget") - F.col("whole") * F.col("tokens"),
        "cells": F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(CELL_TOKENS))).cast("int")}), "mixweights")
    last = _with_source(rows.select("doc_id", "source", "th", "n_tokens"), weighted.filter("rest > 0"), ["whole", "rest", "cells"])
    last = _before(last.withColumn("_u", _unit(F.col("_whole"), seed)), ["source"])
    cut = last.filter(F.col("_before") + F.col("n_tokens") > F.col("_rest")).groupBy("source").agg(
        F.min(F.struct(F.col("_u").alias("u"), "doc_id", "th")).alias("cut"))
    out = weighted.join(cut.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    return stage(out, "mixplan")


def with_copies(rows: DataFrame, sources: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds ``copies`` to rows that have doc_id, source and th; nothing but the source table is joined."""
    rows = _with_source(rows, sources, ["whole", "rest", "cut"])
    place = F.struct(_unit(F.col("_whole"), seed).alias("u"), F.col("doc_id").alias("doc_id"), F.col("th").alias("th"))
    extra = (F.col("_rest") > 0) & (F.col("_cut").isNull() | (place < F.col("_cut")))
    return rows.withColumn("copies", F.col("_whole") + F.when(extra, 1).otherwise(0)).drop("_whole", "_rest", "_cut")


def arrange(rows: DataFrame, sources: DataFrame, block_tokens: int = BLOCK_TOKENS, seed: int = SEED,
            keep: tuple[str, ...] = ()) -> DataFrame:
    """One row a copy: epoch, block and slot in the mixed stream. ``rows`` are narrow, with copies; ``keep``: columns passed on."""
    copies = rows.filter("copies > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    copies = _with_source(copies, sources, ["tokens", "budget", "cells", "weight"])
    # of the last epoch only the head is there, so the sums ahead of it are the same
    copies = _before(copies.withColumn("_u", _unit(F.col("epoch"), seed)), ["source", "epoch"])
    at = F.col("epoch") * F.col("_tokens") + F.col("_before")
    total = sources.agg(F.sum("budget").alias("b")).first()["b"] or 0
    blocks = max(1, -(-int(total) // block_tokens))
    block = F.least(F.lit(blocks - 1), F.floor(at / F.greatest("_budget", F.lit(1)) * blocks)).cast("int")
    order = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id", "epoch", "th"), "doc_id", "epoch", "th")
    return copies.withColumn("block", block).withColumn("slot", (F.row_number().over(order) - 1).cast("long")).select(
        "doc_id", "source", "n_tokens", "epoch", "copies", "block", "slot", F.col("_weight").alias("weight"), *keep)


def mixed_stream(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, max_epochs: float = MAX_EPOCHS,
                 budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """doc_id, source, n_tokens, epoch, copies, block, slot, weight: one row for each copy in the mixed stream."""
    rows = stage(keyed(docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text")).drop("text"), "mixrows")
    sources = source_plan(rows, target_entropy, max_epochs, budget, seed)
    return arrange(with_copies(rows, sources, seed), sources, block_tokens, seed)


def mixed_documents(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, max_epochs: float = MAX_EPOCHS,
                    budget: int | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` themselves, each as often as the mix takes it, in the order of the mixed stream.

    Rows get a number, written once with their texts; the stream is arranged on narrow rows, and the
    copies are exchanged by ranges of (block, slot). The places are joined to the texts by broadcast, or
    beyond ``PLACES_SENT`` of them by a shuffle.
    """
    names = docs.columns
    held = stage(docs.select(F.struct(*names).alias("_row"), F.monotonically_increasing_id().alias("_at")), "mixdocs", codec=TEXT_CODEC)
    narrow = stage(keyed(held.select("_at", F.col("_row.doc_id").cast("long").alias("doc_id"), F.col("_row.source").cast("string").alias("source"),
                                     F.col("_row.text").alias("text"))).drop("text"), "mixrows")
    sources = source_plan(narrow, target_entropy, max_epochs, budget, seed)
    places = stage(arrange(with_copies(narrow, sources, seed), sources, block_tokens, seed, ("_at",)).select("_at", "block", "slot"), "mixplaces")
    if places.count() <= PLACES_SENT:
        places = F.broadcast(places)
    return (held.join(places, "_at").repartitionByRange("block", "slot").sortWithinPartitions("block", "slot")
            .select("_row.*"))
