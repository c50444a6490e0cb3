import itertools
import math

import numpy as np
import pyarrow as pa

from shipwright.llm import langid
from shipwright.llm.common import table


def segmentations(string):
    for cuts in itertools.product([0, 1], repeat=len(string) - 1):
        part, out = string[0], []
        for c, ch in zip(cuts, string[1:]):
            if c:
                out.append(part)
                part = ch
            else:
                part += ch
        yield [*out, part]


def test_forward_sums_all_segmentations():
    pieces = {langid.MARK + "a": [.2, .1], "a": [.1, .3], "ab": [.3, .05], "b": [.05, .2], "bab": [.1, .1], langid.MARK: [.25, .25]}
    word = langid.MARK + "abab"
    got = langid.log_likelihood(word, pieces, 2)
    for k in range(2):
        total = sum(math.prod(pieces[p][k] if p in pieces else 0 for p in s) for s in segmentations(word))
        assert abs(math.exp(got[k]) / total - 1) < 1e-4      # the unknown-character arcs add a little


def test_long_words_keep_their_numbers():
    table_ = {langid.MARK: [.5], "a": [.25]}
    n = 5000
    assert abs(langid.log_likelihood(langid.MARK + "a" * n, table_, 1)[0] - (math.log(.5) + n * math.log(.25))) < 1e-2


def test_words_side_by_side_have_the_same_sums():
    pieces = sorted(["a", "ab", "abc", "ba", "b", "c", langid.MARK, langid.MARK + "ab", langid.MARK + "c", "cab", "bcab"])
    probs = np.random.default_rng(1).random((3, len(pieces)))
    probs /= probs.sum(axis=1, keepdims=True)
    scorer = langid.Scorer(langid.Model(["x", "y", "z"], [0, 0, 0], pieces, probs))
    words = ["".join(w) for n in range(1, 6) for w in itertools.product("abcq", repeat=n)] + ["q" * 32, "q" * 33, "ab" * 40, "abq" * 11, "c"]
    words = list(dict.fromkeys(words))
    table_ = dict(zip(pieces, probs.T.tolist()))
    want = np.array([langid.log_likelihood(langid.MARK + w, table_, 3) for w in words])
    assert np.allclose(scorer.words(words), want, rtol=1e-12, atol=1e-9)
    assert np.array_equal(scorer.words(words[::-1]), scorer.words(words)[::-1])


def test_expected_counts_match_enumeration():
    probs = {langid.MARK: .3, "a": .2, "ab": .1, "b": .2, "ba": .15}
    word, found = langid.MARK + "abab", {}
    langid.expected_counts(word, probs, 2.0, found)
    weights = [(s, math.prod(probs.get(p, 0) for p in s)) for s in segmentations(word)]
    total = sum(w for _, w in weights)
    for piece in probs:
        want = 2 * sum(w * s.count(piece) for s, w in weights) / total
        assert abs(found.get(piece, 0) - want) < 1e-5


def test_expected_counts_of_long_words():
    probs = {langid.MARK: .3, "a": .2, "ab": .1, "b": .2, "ba": .15}
    for word in ("ab" * 12, "aab" * 7 + "x", "xyab"):                    # both ways over words that both can take
        plain, long = {}, {}
        langid.expected_counts(langid.MARK + word, probs, 1.0, plain)
        langid._expected_counts_of_long(langid.MARK + word, probs, 1.0, long)
        assert set(plain) == set(long) and all(abs(plain[p] - long[p]) < 1e-9 for p in plain)
    for word, letter in (("x" * 60 + "a", "a"), ("a" * 20_000, "a"), ("漢" * 500 + "b", "b")):
        found = {}
        langid.expected_counts(langid.MARK + word, probs, 1.0, found)
        assert abs(found[letter] - word.count(letter)) < 1e-3 * word.count(letter)


def test_words_are_runs_of_letters():
    lists = langid.split_words(pa.array(["Ab, c1d!", None, "", "123", "É ß"]).slice(0, 5))
    assert lists.to_pylist() == [["ab", "c", "d"], [], [], [], ["é", "ß"]]


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = langid.train(docs.filter(~langid.held_out()))
    rows = langid.predict(docs.withColumn("held_out", langid.held_out()), model, ["doc_id", "lang", "held_out"]).filter("held_out").collect()
    assert len(rows) > 20 and np.mean([r.lang == r.lang_pred for r in rows]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark, odd_docs):
    model = langid.train(odd_docs)
    assert model.langs == ["de", "en", "fr"]
    got = {(r.doc_id, r.lang_pred) for r in langid.predict(odd_docs, model, ["doc_id"]).collect()}
    assert {(2, "und"), (3, "und"), (4, "und"), (1, "en"), (None, "en")} <= got
    empty = langid.train(odd_docs.limit(0))
    assert {r.lang_pred for r in langid.predict(odd_docs, empty, ["doc_id", "text"]).collect()} == {"und"}
    assert langid.predict(odd_docs.limit(0), model, ["doc_id"]).count() == 0


def test_prediction_reads_nothing_but_text(spark, odd_docs):
    model = langid.train(odd_docs)
    changed = odd_docs.selectExpr("size as row", "text", "'xx' as lang", "'yy' as source", "doc_id + 50 as doc_id")
    a = {r.size: (r.lang_pred, r.score) for r in langid.predict(odd_docs, model, ["size"]).collect()}
    b = {r.row: (r.lang_pred, r.score) for r in langid.predict(changed, model, ["row"]).collect()}
    assert a == b
