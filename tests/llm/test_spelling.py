import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shipwright.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def words_of(doc, text):
    for run in RUN.findall(text or ""):
        run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
        h = crc32(f"{'' if doc is None else doc}:{run}".encode())
        yield run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run


def one_edit(a, b):
    """By definition: some insertion, deletion or replacement of one letter turns a into b."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = Counter(w for doc, text in rows for w in words_of(doc, text))
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best and n[best] >= 5 * n[w]:
            form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def variants(df, **kw):
    return set(map(tuple, spelling.spelling_variants(df, **kw).collect()))


def vocabulary(rnd, stems, alphabet, length=(6, 12)):
    """Words and their neighbours, so that many are one edit apart."""
    words = set()
    for _ in range(stems):
        w = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(*length)))
        words.add(w)
        for _ in range(4):
            i, c = rnd.randrange(len(w) + 1), rnd.choice(alphabet)
            words |= {w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]}
    return sorted(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=9), min_size=1, max_size=12, unique=True))
def test_index_finds_exactly_the_words_one_edit_away(words):
    index = spelling.PositionIndex(words)
    for w in words:
        assert {words[j] for j in index.near(w)} == {v for v in words if one_edit(w, v)}


@pytest.mark.parametrize("letters", [1 << 16, 200, 1])
def test_variants_as_by_brute_force_at_any_group_size(spark, rnd, letters):
    words = vocabulary(rnd, 40, "abcdeé")
    rows = []
    for i, w in enumerate(words):
        rows += [(i * 7 + k, f"{w.upper() if k % 2 else w}, {w};" + w * (k == 3)) for k in range(rnd.choice([1, 2, 3, 15, 80]))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert variants(df, group_letters=letters) == brute(rows)


def test_a_hot_group_is_cut_until_it_is_small(spark):
    # all words share their first half, and most of the rest
    words = [f"commonstem{a}{b}{c}x" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"]
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    met = spelling.groups(df, group_letters=1000)
    sizes = met.groupBy("key", "top", "lo", "hi").agg(F.count("*").alias("c")).filter("c * top > 1000 and hi - lo > 1")
    assert sizes.isEmpty()
    assert not met.filter("hi - lo < top / 4").isEmpty()             # halves were cut again
    single = spelling.groups(df, group_letters=1).filter("hi - lo = 1")
    # in a window of a single place nothing is left to cut: at most the alphabet, once
    assert single.groupBy("key", "top", "lo").count().agg(F.max("count")).first()[0] == 8
    rows = [(i, f"{w} " * 5) for i, w in enumerate(words)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert variants(docs, group_letters=1000) == brute(rows)


def test_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert variants(odd_docs) == brute(rows)
    assert variants(odd_docs.filter("doc_id < 0")) == set()
    clash = spark.createDataFrame([(i % 3, "chateau " * 4 + "chateaux", "w", 9, "f") for i in range(9)] + [(None, "chateau", "w", 9, "f")] * 2,
                                  "doc_id long, text string, word string, n int, key string")
    assert variants(clash) == brute([(r.doc_id, r.text) for r in clash.collect()])
    assert clash.columns == ["doc_id", "text", "word", "n", "key"]


def test_runs_of_long_texts_and_foreign_letters(monkeypatch):
    text = "Ünïted ÄÖ×÷ naïve-Łódź kelvinK ﬁnal Ābcdefg" + " longer" * 50 + "x" * 500
    whole = [r.encode("latin-1") for r in ("".join(c.lower() if "A" <= c <= "Z" else c for c in m) for m in RUN.findall(text))]
    for part in (1, 3, 7, 64, 1 << 20):
        monkeypatch.setattr(spelling, "TEXT_PART", part)
        assert [r for p in spelling.runs(text) for r in p] == whole
    assert list(spelling.runs("")) == []


def test_chains_end_at_the_root(spark):
    counts = {"kleinest": 5, "kleinesta": 25, "kleinestab": 125, "kleinestabc": 625}
    forms = spark.createDataFrame([(a, b) for a, b in zip(list(counts), list(counts)[1:])], "word string, form string")
    assert {r.word: r.root for r in spelling._roots(forms).collect()} == {w: "kleinestabc" for w in list(counts)[:-1]}
