"""Spelling variants: groups of words one edit apart, by a bit-sliced position index.

Words are counted over all texts, whole; a map task sums its own counts before anything is shuffled.
The kept words meet in groups, and a group's words are indexed by bitsets: for each (position, letter) the
words with that letter there, and for each length the words of that length. A word w asks the index with
four bitsets that go along its letters, all words of the group in parallel:

    exact      words equal to w so far
    replaced   one error so far, letters still in step
    shorter    one error so far, w has a letter more: its letters stand one place earlier
    longer     one error so far, w has a letter less: its letters stand one place later

Grouping (what Spark shuffles by) uses that an edit lies somewhere: of two words one edit apart, the longer
having L letters, either the part before the middle agrees or the part from it on. A window [lo, hi) of the
longer word's places stands for "the edit is in here"; its group is named by L, the window and the letters outside
it. A group of more than ``GROUP_LETTERS`` letters is cut into its windows' halves, down to a single place, where a
group has at most as many words as the alphabet has letters, plus one. So no popular stem gathers many words
in a task, none are compared twice, and no pair is lost. A pair is reported in the window that holds the
first place in which its words differ.

Forms point to words with at least ``RATIO`` times the count, so chains are short; roots are found
by pointer jumping.

Defined cases: null and empty texts have no words; a null doc_id is written as the empty text in the hashed
key; rows with the same doc_id count each; an empty table or one without a kept word gives no rows; other
columns of the input are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipwright.llm.common import stage
from shipwright.llm.ngram_join import sized

DELETE_EVERY = 199           # a run whose hash this divides loses a letter
MIN_LETTERS, MIN_COUNT = 6, 5
RATIO = 5                    # how much more often than the word its form occurs
GROUP_LETTERS = 1 << 16      # words x letters of a group that is indexed as one
HELD_WORDS = 200_000         # distinct words a task sums up before it writes them
TEXT_PART = 1 << 20          # characters of a text that are split at once

# one byte a code point up to 255: letters stay (A-Z as a-z), all else becomes a blank
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str) -> Iterator[list[bytes]]:
    """The lower-cased letter runs of a text, a part of it at a time; a byte stands for a code point."""
    tail = b""
    for at in range(0, len(text), TEXT_PART):
        part = tail + text[at:at + TEXT_PART].encode("latin-1", "replace").translate(_LETTERS)
        cut = len(part) if at + TEXT_PART >= len(text) else part.rfind(b" ") + 1   # a run may go on in the next part
        yield part[:cut].split()
        tail = part[cut:]


def edited(run: bytes, seed: int) -> bytes:
    """The run, without one letter where its hash says so; ``seed`` is the crc32 of ``<doc_id>:``."""
    h = crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % DELETE_EVERY:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n): counts of a task's words of enough letters, written whenever many are held."""
    held: Counter[bytes] = Counter()

    def out():
        rows = pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return rows

    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1)):
            seed = crc32(f"{doc.as_py() or ''}:".encode())
            for words in runs(text.as_py() or ""):
                for run, n in Counter(words).items():
                    word = edited(run, seed)
                    if len(word) >= MIN_LETTERS:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield out()
    if held:
        yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the words that occur often enough."""
    texts = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return (texts.mapInArrow(_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= MIN_COUNT))


class PositionIndex:
    """Bitsets over the words of a group, by (position, letter) and by length."""

    def __init__(self, words: list[str]):
        self.words = words
        self.at: dict[tuple[int, str], int] = {}
        self.long: dict[int, int] = {}
        for i, w in enumerate(words):
            bit = 1 << i
            self.long[len(w)] = self.long.get(len(w), 0) | bit
            for place in enumerate(w):
                self.at[place] = self.at.get(place, 0) | bit

    def near(self, w: str) -> Iterator[int]:
        """Numbers of the words that differ from ``w`` by one inserted, deleted or replaced letter."""
        at, m = self.at.get, len(w)
        exact, replaced, shorter, longer = (1 << len(self.words)) - 1, 0, 0, 0
        for i, c in enumerate(w):
            here = at((i, c), 0)
            shorter = (shorter & at((i - 1, c), 0)) | exact                # w's letter is the one too many
            longer = (longer | exact) & at((i + 1, c), 0)                   # a letter was skipped before this one
            replaced = (replaced & here) | (exact & ~here)
            exact &= here
            if not (exact | replaced | shorter | longer):
                return
        longer |= exact                                                     # the last letter is the one skipped
        found = (replaced & self.long.get(m, 0)) | (shorter & self.long.get(m - 1, 0)) | (longer & self.long.get(m + 1, 0))
        while found:
            low = found & -found
            yield low.bit_length() - 1
            found ^= low


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads (key, top, lo, hi, word, n) with a group's rows together; (word, n_near, best_n, best) inside the group.

    Only pairs whose longer word has ``top`` letters and that first differ in the window are counted, so each pair is
    counted in one group.
    """
    group, current, out = [], None, []

    def flush():
        if len(group) < 2:
            return
        _, top, lo, hi = current
        words = [w for w, _ in group]
        index = PositionIndex(words)
        for w, _ in group:
            n_near, best = 0, None
            for j in index.near(w):
                other, n = group[j]
                if max(len(w), len(other)) == top and lo <= len(commonprefix((w, other))) < hi:
                    n_near += 1
                    best = min(best or (-n, other), (-n, other))
            if n_near:
                out.append((w, n_near, -best[0], best[1]))

    def rows():
        cols = list(zip(*out))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                           pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())], ["word", "n_near", "best_n", "best"])

    for batch in batches:
        for key, top, lo, hi, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            if (key, top, lo, hi) != current:
                flush()
                group, current = [], (key, top, lo, hi)
                if len(out) >= 10_000:
                    yield rows()
            group.append((word, n))
    flush()
    if out:
        yield rows()


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds the group's name: a hash of the letters outside the window. A collision only makes a group larger."""
    outside = F.concat(F.expr("substring(word, 1, lo)"), F.lit("\x00"), F.expr("right(word, top - hi)"))
    return rows.withColumn("key", F.xxhash64("top", "lo", "hi", outside))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row in both halves of its window."""
    middle = "cast((lo + hi) div 2 as int)"
    return _keyed(rows.select("word", "n", "top", F.expr(
        f"inline(array(struct(lo, {middle} as hi), struct({middle} as lo, hi)))")))


def groups(words: DataFrame, group_letters: int = GROUP_LETTERS) -> DataFrame:
    """(key, top, lo, hi, word, n): every word in the groups in which its neighbours meet it, all of bounded size."""
    rows = words.withColumn("top", F.explode(F.array(F.char_length("word"), F.char_length("word") + 1)))
    level = stage(_halves(rows.withColumns({"lo": F.lit(0), "hi": F.col("top")})), "spellgroups")
    done = None
    while True:
        size = level.groupBy("key", "top", "lo", "hi").agg(F.count("*").alias("c"))
        large = stage(size.filter((F.col("c") * F.col("top") > group_letters) & (F.col("hi") - F.col("lo") > 1)).select(
            "key", "top", "lo", "hi"), "spelllarge")
        if large.isEmpty():
            return level if done is None else done.unionByName(level)
        by = ["key", "top", "lo", "hi"]
        small = level.join(sized(large), by, "left_anti")
        done = small if done is None else done.unionByName(small)
        level = stage(_halves(level.join(sized(large), by, "left_semi").drop("key")), "spellgroups")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: pointers jump to their target's target until none moves."""
    to = stage(forms.select("word", F.col("form").alias("root")), "spellroots")
    while True:
        ahead = to.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = stage(to.join(ahead, "root", "left").select("word", F.coalesce("far", "root").alias("root"),
                                                           F.col("far").isNotNull().alias("moved")), "spellroots")
        to = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return to


def spelling_variants(docs: DataFrame, group_letters: int = GROUP_LETTERS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every kept word."""
    words = stage(word_counts(docs), "words")
    by = ["key", "top", "lo", "hi"]
    met = groups(words, group_letters).select(*by, "word", "n")
    near = met.repartition("key").sortWithinPartitions(*by).mapInArrow(
        _neighbours, "word string, n_near long, best_n long, best string")
    best = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("minus"), "best")).alias("m"))
    best = best.select("word", "n_near", (-F.col("m.minus")).alias("best_n"), "m.best")
    enough = F.col("best_n") >= RATIO * F.col("n")
    held = stage(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best")).alias("form"),
        F.when(enough, F.col("best_n")).alias("form_n")), "spellforms")
    roots = _roots(held.filter(F.col("form").isNotNull()))
    return held.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
