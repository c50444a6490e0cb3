"""Language ID by segmentation-marginalised unigram models.

Pieces come from a fixed public vocabulary (a sentencepiece model file; it is not trained). Every
language has a probability for each piece, and a word's likelihood is the sum over all ways to
cut it into pieces, found by the forward algorithm:

    a[0] = 1,   a[j] = sum over pieces p ending at j of a[j - len(p)] * P(p | language)

A text's score is the sum of its words' log likelihoods plus the log prior of the language; the
confidence is the posterior of the best one. Probabilities are fitted by expectation
maximisation: the E-step runs forward and backward over each distinct training word in
parallel, the M-step sums expected piece counts per language in Spark. Only the
(language, piece) table, bounded by vocabulary size times languages, reaches the driver.

Training reads at most about ``sample_rows`` labelled rows, taken by a hash of doc_id, a
documented bound on fitting. Scoring covers every row and whole texts. Words are runs of letters,
lower-cased; a distinct word is scored once per batch and kept in a bounded cache.

Defined cases: a null text or one without a letter is ``und`` with score 0; rows without label take
no part in training; without any labelled row all rows are ``und`` with score 0; ties go to the
language that sorts first; null doc_ids pass through; equal rows are predicted each; other
columns of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from shipwright.llm import tokens
from shipwright.llm.common import lean, stage

VOCABULARY = "piece_bpe_32k.model"
SAMPLE_ROWS = 20_000     # labelled rows used for fitting, about
EM_ROUNDS = 3
SMOOTHING = 0.05         # added to each expected piece count
UNKNOWN_CHAR = 1e-8      # probability of a character that no piece covers
MAX_PIECE = 16           # letters; longer pieces of the vocabulary are not used
PLAIN_LETTERS = 32       # a longer word's probability may be too small for a float
TOGETHER = 4096          # words of a length whose sums are found side by side
MAX_CACHED_WORDS = 400_000
SLICE_BYTES = 2 << 20    # texts split into words at once
MARK = "▁"          # start of word in the vocabulary
UND = "und"


def letter_pieces(path: str) -> list[str]:
    """Lower-case pieces made of letters, with or without the word mark."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
    good = {p for p in pieces if p.lstrip(MARK).isalpha() and p == p.lower() and p.count(MARK) == p.startswith(MARK)
            and len(p.lstrip(MARK)) <= MAX_PIECE}
    return sorted(good | {MARK})


@dataclass
class Model:
    """Piece probabilities by language; ``log_prior`` in the order of ``langs``."""
    langs: list[str]
    log_prior: list[float]
    pieces: list[str]
    probs: np.ndarray                       # languages x pieces


class Scorer:
    """A model with the log likelihoods of the words met so far (bounded)."""

    def __init__(self, model: Model):
        self.langs, self.prior = model.langs, np.array(model.log_prior)
        self.index = {piece: i for i, piece in enumerate(model.pieces, 1)}
        self.probs = np.concatenate([np.zeros((1, len(self.langs))), model.probs.T])
        self.rows: dict[str, int] = {}
        self.known = np.zeros((0, len(self.langs)))

    def words(self, words: list[str]) -> np.ndarray:
        """Log likelihood of each word in each language, all segmentations summed."""
        if len(self.rows) + len(words) > MAX_CACHED_WORDS:
            self.rows, self.known = {}, self.known[:0]
        new = [w for w in words if w not in self.rows]
        if new:
            self.rows.update((w, len(self.rows)) for w in new)
            self.known = np.concatenate([self.known, self.likelihoods([MARK + w for w in new])])
        return self.known[[self.rows[w] for w in words]] if words else self.known[:0]

    def likelihoods(self, strings: list[str]) -> np.ndarray:
        """Log likelihoods of marked words: those of one length together, long ones one by one with rescaling."""
        out = np.empty((len(strings), len(self.langs)))
        length = np.array(list(map(len, strings)))
        for n in np.unique(length[length <= PLAIN_LETTERS + 1]):
            at = np.flatnonzero(length == n)
            for part in np.array_split(at, -(-len(at) // TOGETHER)):
                out[part] = forward_of_many([strings[k] for k in part], self.index, self.probs)
        for k in np.flatnonzero(length > PLAIN_LETTERS + 1):
            out[k] = log_likelihood(strings[k], self, len(self.langs))
        return out

    def get(self, piece: str):
        """Probabilities of a piece by language, None if it isn't in the vocabulary."""
        row = self.index.get(piece)
        return None if row is None else self.probs[row]

    def score(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """(language, posterior) of each text."""
        n = len(texts)
        if not self.langs:
            return [UND] * n, np.zeros(n)
        lists = split_words(texts)
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        by_word = self.words(coded.dictionary.to_pylist())
        total = np.tile(self.prior, (n, 1))
        full = np.flatnonzero(np.diff(bounds))
        if len(full):
            total[full] += np.add.reduceat(by_word[coded.indices.to_numpy()], bounds[full], axis=0)
        best = total.argmax(axis=1)
        score = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        empty = np.diff(bounds) == 0
        score[empty] = 0.0
        return [UND if e else self.langs[k] for k, e in zip(best, empty)], score


def split_words(texts: pa.Array):
    """Lower-cased runs of letters of each text."""
    whole = pc.fill_null(texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts)))), "")
    letters = pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(whole), r"\PL+", " "), " ")
    lists = pc.split_pattern(letters, " ")
    # a text without a letter gives one empty word: leave it out
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False) * (pc.binary_length(letters).to_numpy(zero_copy_only=False) > 0)
    keep = pc.not_equal(lists.flatten(), "")
    return pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)], pa.int64()), lists.flatten().filter(keep))


def log_likelihood(string: str, table, n_langs: int) -> list[float]:
    """Forward algorithm in all languages at once; rescaled now and then, so any length works."""
    langs = range(n_langs)
    alpha = [[1.0] * n_langs]
    logs = [0.0] * n_langs
    for j in range(1, len(string) + 1):
        total = [a * UNKNOWN_CHAR for a in alpha[j - 1]]
        for i in range(max(0, j - MAX_PIECE - 1), j):
            p = table.get(string[i:j])
            if p is not None:
                a = alpha[i]
                for k in langs:
                    total[k] += a[k] * p[k]
        alpha.append(total)
        if j % 16 == 0:
            for k in langs:
                by = total[k]
                logs[k] += math.log(by)
                for i in range(max(0, j - MAX_PIECE - 1), j + 1):
                    alpha[i][k] /= by
    return [x + math.log(y) for x, y in zip(logs, alpha[-1])]


def forward_of_many(strings: list[str], index: dict[str, int], probs: np.ndarray) -> np.ndarray:
    """The same for strings of one length of at most ``PLAIN_LETTERS`` + 1, side by side.

    ``index`` names the row of ``probs`` (pieces x languages) of a piece; row 0 is all zeros.
    """
    n = len(strings[0])
    alpha = np.zeros((n + 1, len(strings), probs.shape[1]))
    alpha[0] = 1.0
    for j in range(1, n + 1):
        alpha[j] = alpha[j - 1] * UNKNOWN_CHAR
        for i in range(max(0, j - MAX_PIECE - 1), j):
            rows = np.fromiter([index.get(s[i:j], 0) for s in strings], np.int64, len(strings))
            hit = np.flatnonzero(rows)
            alpha[j, hit] += alpha[i, hit] * probs[rows[hit]]
    return np.log(alpha[n])


def expected_counts(string: str, probs: dict[str, float], weight: float, out: dict[str, float]) -> None:
    """Adds the expected number of uses of each piece in ``string`` under one language's model."""
    n = len(string)
    if n > PLAIN_LETTERS:
        return _expected_counts_of_long(string, probs, weight, out)
    arcs = []
    alpha = [1.0] + [0.0] * n
    for j in range(1, n + 1):
        for i in range(max(0, j - MAX_PIECE - 1), j):
            p = probs.get(string[i:j])
            if p is not None:
                alpha[j] += alpha[i] * p
                arcs.append((i, j, p))
        alpha[j] += alpha[j - 1] * UNKNOWN_CHAR
    if not alpha[n] > 0:
        return
    beta = [0.0] * n + [1.0]
    at = len(arcs) - 1
    for j in range(n, 0, -1):
        while at >= 0 and arcs[at][1] == j:
            i, _, p = arcs[at]
            beta[i] += p * beta[j]
            share = alpha[i] * p * beta[j] / alpha[n]
            if share > 0:
                piece = string[i:j]
                out[piece] = out.get(piece, 0.0) + weight * share
            at -= 1
        beta[j - 1] += UNKNOWN_CHAR * beta[j]


def _log_sum(terms: list[float]) -> float:
    top = max(terms)
    return top + math.log(sum(math.exp(x - top) for x in terms))


def _expected_counts_of_long(string: str, probs: dict[str, float], weight: float, out: dict[str, float]) -> None:
    """The same by logarithms, for words whose probability is too small for a float."""
    n = len(string)
    skip = math.log(UNKNOWN_CHAR)
    arcs: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]       # by end: (start, log probability)
    alpha = [0.0] * (n + 1)
    for j in range(1, n + 1):
        for i in range(max(0, j - MAX_PIECE - 1), j):
            p = probs.get(string[i:j], 0.0)
            if p > 0:
                arcs[j].append((i, math.log(p)))
        alpha[j] = _log_sum([alpha[i] + p for i, p in arcs[j]] + [alpha[j - 1] + skip])
    onward: list[list[float]] = [[] for _ in range(n + 1)]
    beta = 0.0
    for j in range(n, 0, -1):
        if j < n:
            beta = _log_sum(onward[j])
        for i, p in arcs[j]:
            onward[i].append(p + beta)
            share = math.exp(alpha[i] + p + beta - alpha[n])
            if share > 0:
                piece = string[i:j]
                out[piece] = out.get(piece, 0.0) + weight * share
        onward[j - 1].append(skip + beta)


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, count) of the training texts, summed inside a part of a batch."""
    for batch in batches:
        for lo, hi in tokens.chunks(batch.column(1), SLICE_BYTES):
            lists = split_words(batch.column(1).slice(lo, hi - lo))
            size = np.diff(lists.offsets.to_numpy())
            langs = batch.column(0).slice(lo, hi - lo).take(pa.array(np.repeat(np.arange(hi - lo), size)))
            t = pa.table({"lang": langs, "word": lists.flatten().cast(pa.string())})
            t = t.group_by(["lang", "word"]).aggregate([([], "count_all")]).select([0, 1, 2]).rename_columns(["lang", "word", "n"])
            yield from t.combine_chunks().to_batches()


def train(docs: DataFrame, vocabulary: str = VOCABULARY, sample_rows: int = SAMPLE_ROWS,
          rounds: int = EM_ROUNDS) -> Model:
    """Fit on the rows of ``docs`` that have a text and a lang; about ``sample_rows`` of them."""
    spark = docs.sparkSession
    labelled = docs.select("doc_id", F.col("lang").cast("string"), F.col("text").cast("string")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    pieces = letter_pieces(tokens.tokenizer_path(vocabulary))
    if not langs:
        return Model([], [], pieces, np.zeros((0, len(pieces))))
    total = sum(sizes.values())
    kept = 1.0 if total <= sample_rows else sample_rows / total
    sample = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < F.lit(int(kept * 1_000_003) + 1))
    words = stage(sample.select("lang", "text").mapInArrow(lean(_words_of), "lang string, word string, n long")
                  .groupBy("lang", "word").agg(F.sum("n").alias("n")), "langwords")
    # start: every piece as likely as its length is short, the same in all languages
    start = np.array([0.1 ** len(p.lstrip(MARK)) for p in pieces])
    probs = np.tile(start / start.sum(), (len(langs), 1))
    index = {p: i for i, p in enumerate(pieces)}
    for _ in range(rounds):
        held = spark.sparkContext.broadcast({l: dict(zip(pieces, row.tolist())) for l, row in zip(langs, probs)})

        def expect(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            sums: dict[str, dict[str, float]] = {}
            for batch in batches:
                for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                    expected_counts(MARK + word, held.value[lang], n, sums.setdefault(lang, {}))
            rows = [(l, p, x) for l, s in sums.items() for p, x in s.items()]
            if rows:
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()),
                                                  pa.array(cols[2], pa.float64())], ["lang", "piece", "x"])

        counts = np.full((len(langs), len(pieces)), SMOOTHING)
        row_of = {l: i for i, l in enumerate(langs)}
        summed = words.mapInArrow(lean(expect), "lang string, piece string, x double").groupBy("lang", "piece").agg(
            F.sum("x").alias("x"))
        for r in summed.collect():          # at most vocabulary size x languages rows
            counts[row_of[r["lang"]], index[r["piece"]]] += r["x"]
        probs = counts / counts.sum(axis=1, keepdims=True)
        held.destroy()
    return Model(langs, [math.log(sizes[l] / total) for l in langs], pieces, probs)


def predict(docs: DataFrame, model: Model, keep: list[str], pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """The ``keep`` columns with the predicted language and its posterior. Reads no column but text."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.select(*keep, *([] if "text" in keep else ["text"]))
    at = base.columns.index("text")
    schema = StructType([base.schema[c] for c in keep] + [StructField(pred, StringType()), StructField(score, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        for batch in batches:
            for lo, hi in tokens.chunks(batch.column(at).fill_null(""), SLICE_BYTES):
                part = batch.slice(lo, hi - lo)
                p, s = scorer.score(part.column(at))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(keep)], pa.array(p, pa.string()), pa.array(s, pa.float64())], [*keep, pred, score])

    return base.mapInArrow(lean(run), schema)


def held_out(doc_id="doc_id"):
    """Rows kept from training: crc32 of the id as text leaves remainder 2 by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
