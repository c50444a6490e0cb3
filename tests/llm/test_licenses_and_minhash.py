import hashlib
import re

import numpy as np

from shipwright.llm import licenses, minhash
from shipwright.llm.license_rules import BASE, GATE, rules
from tests.llm.conftest import lower_ascii, shingle_set

LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RULES = rules()
COMPILED = [re.compile(rf"(?<= )(?:{r.regex})(?= )") for r in RULES]      # more than re keeps by itself


def brute_scan(text):
    words = LICENSE_WORD.findall(lower_ascii(text))
    canon = " " + " ".join(words) + " " if words else " "
    base, names = [], set()
    for phrase, label in BASE:
        p = phrase.split()
        hits = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        base += hits
        names |= {label} if hits else set()
    found = []
    for n, r in enumerate(RULES):
        for m in COMPILED[n].finditer(canon):                                     # every rule, whatever its keyword
            start = canon[:m.start()].count(" ") - 1
            found.append((start, start + m[0].count(" "), r.priority, n, r.label))
    assert not found or any(g in canon for g in GATE)
    rank = lambda d: (d[0], -d[1], -d[2], d[3])
    live = [d for d in found if not any(o[0] <= d[0] and o[1] >= d[1] and o[2] >= d[2] and rank(o) < rank(d) for o in found)]
    score = max((licenses.CONFIDENCE[d[2]] for d in live), default=0.5 if base else 0.0)
    return (len(words), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(names)),
            ",".join(sorted(names | {d[4] for d in live})), score)


LICENSED = [
    "MIT License", "mit license mit-license. The Apache License, version 2.0 GENERAL PUBLIC LICENSE",
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
    "Copyright (c) 2020 Foo. See the LICENSE file",
    "This work is licensed under the GNU General Public License, version 3. Or GNU Lesser General Public License version 2.1 or later. "
    "SPDX-License-Identifier: GPL-2.0-only",
    "CC BY-NC 4.0 and Creative Commons Attribution-ShareAlike 3.0 license", "é mit license ü", " ".join(["mit license"] * 300),
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "GNU General Public License",
    "BSD 3-Clause License and new BSD license, Mozilla Public License v 2.0", "Dual licensed under the MIT and GPL v2 licenses",
    "the apache\nlicense", "mitlicense mit  license MIT\tLicense 0mit license", "no licence here"]


def test_scan_matches_brute_force(spark, odd_docs):
    texts = [*LICENSED, *[r.text for r in odd_docs.collect()]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute_scan(t), t
    assert got[0][-2] == "mit" and got[2][-2].split(",")[:2] == ["apache", "apache-2.0"] and got[4][-2] == "cc-by-nc-4.0,cc-by-sa-3.0"
    assert licenses.scan(odd_docs).count() == 9 and licenses.scan(odd_docs.limit(0)).count() == 0


def generated(tree, rnd):
    """A text that the parsed regex matches, with what its lookahead asks for."""
    out = ""
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            out += chr(arg)
        elif name == "IN":
            kind, v = arg[0]
            out += chr(v[0] if str(kind) == "RANGE" else v)
        elif name == "BRANCH":
            out += generated(rnd.choice(arg[1]), rnd)
        elif name == "SUBPATTERN":
            out += generated(arg[3], rnd)
        elif name == "MAX_REPEAT":
            out += "".join(generated(arg[2], rnd) for _ in range(rnd.randint(arg[0], min(arg[1], 4))))
        else:
            assert name == "ASSERT", name
            out += generated(arg[1], rnd)
    return out


def test_every_rule_form_passes_the_gate(spark, rnd):
    from re import _parser
    texts = ["This program is distributed under the terms of the GNU GPL version 2", "released under the MIT", "this code is GPL v2 only"]
    for r in RULES:
        tree = _parser.parse(r.regex)
        for text in [generated(tree, rnd) for _ in range(3)]:
            texts.append(f"a {text} b")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(df).collect()}
    for i, t in enumerate(texts):
        assert got[i] == brute_scan(t) and got[i][-2], t
    assert [got[i][-2] for i in range(3)] == ["gpl-2.0", "mit", "gpl-2.0"]


def test_every_match_holds_its_rules_keyword(rnd):
    from re import _parser
    for r in RULES:
        tree = _parser.parse(r.regex)
        for _ in range(25):
            assert r.keyword in generated(tree, rnd), r


def test_rules_are_many_and_compile():
    assert len(RULES) > 300 and all(re.compile(r.regex) for r in RULES)


def test_native_operators_run_no_python(spark, odd_docs):
    for df in (licenses.scan(odd_docs), minhash.edited_fingerprints(odd_docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_suppression_by_containment(spark):
    df = spark.createDataFrame([(1, "licensed under the apache license version 2 0")], "doc_id long, text string")
    rows = [r for r in licenses.detections(df).collect() if r.rule is not None]
    live = {r.label for r in rows if not r.suppressed}
    assert live == {"apache-2.0"} and {r.label for r in rows if r.suppressed} >= {"apache", "license-reference"}


def words(rnd, n):
    return " ".join(f"w{rnd.randrange(5000)}" for _ in range(n))


def test_edited_fingerprints(spark, rnd):
    texts = [words(rnd, rnd.choice([1, 3, 5, 8, 30, 200, 900])) for _ in range(120)] + ["", "", "a", "the same text of six words", "the same text of six words"]
    df = spark.createDataFrame([(i * 3 - 50, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in minhash.edited_fingerprints(df).collect()}
    off = []
    for i, t in enumerate(texts):
        r, nxt = got[i * 3 - 50], texts[(i + 1) % len(texts)]
        k = len(t) // 4
        edited = t[:len(t) - k] + nxt[:k]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = shingle_set(t), shingle_set(edited)
        if a and b:
            off.append(r.near_edited - len(a & b) / len(a | b))
        assert (r.near_edited == 1.0) == (r.fingerprint == r.edited_fingerprint)
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.08 and np.abs(off).max() < 0.3
    prints = {}
    for i, t in enumerate(texts):
        prints.setdefault(t, set()).add(got[i * 3 - 50].fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert len({p for s in prints.values() for p in s}) == len(prints)


def test_estimate_is_unbiased_over_the_range(spark, rnd):
    pairs = []
    for same in (0, 40, 100, 160, 200):
        for _ in range(25):
            head = [f"h{rnd.randrange(10 ** 6)}" for _ in range(same)]
            tail = lambda: [f"t{rnd.randrange(10 ** 6)}" for _ in range(200 - same)]
            pairs.append((same, " ".join(head + tail()), " ".join(head + tail())))
    df = spark.createDataFrame([(i, s, a, b) for i, (s, a, b) in enumerate(pairs)], "i long, same int, a string, b string")
    df = minhash.with_fingerprint(minhash.with_fingerprint(df, "a", "fa"), "b", "fb").select("i", "same", minhash.likeness("fa", "fb").alias("e"))
    for same in (0, 40, 100, 160, 200):
        est = [r.e for r in df.filter(f"same = {same}").collect()]
        a, b = next((shingle_set(x), shingle_set(y)) for s, x, y in pairs if s == same)
        assert abs(np.mean(est) - len(a & b) / len(a | b)) < 0.03


def test_neighbours_across_cells_and_odd_rows(spark, odd_docs):
    df = spark.range(0, 5000, 7).selectExpr("id as doc_id", "id * 31 as th", "id as n_chars").repartition(9)
    rows = {r.doc_id: r for r in minhash.neighbours(df).collect()}
    ids = sorted(rows)
    for a, b in zip(ids, ids[1:] + ids[:1]):
        assert rows[a].next_id == b and rows[b].prev_id == a and rows[b].prev_chars == a
    got = minhash.edited_fingerprints(odd_docs).collect()
    assert len(got) == 9
    (alone,) = minhash.edited_fingerprints(odd_docs.filter("doc_id = 1")).collect()
    text = "One two three four five six seven."
    assert alone.edited_sha256 == hashlib.sha256((text[:-8] + text[:8]).encode()).hexdigest()
    assert minhash.edited_fingerprints(odd_docs.limit(0)).count() == 0 and minhash.fingerprints(odd_docs).count() == 9
