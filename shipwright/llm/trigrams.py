"""Boolean trigram queries of regular expressions.

A query is a set of clauses, a clause a set of trigrams: a text that the expression matches holds all
trigrams of at least one clause. ``ANY`` (one clause without trigrams) says nothing: such a rule has to scan fully.
Trigrams are of A-Z lower-cased text, so flags for case don't matter. Everything that isn't understood
(look-around, large classes, open repeats) asks for nothing, so a query may be weaker than its expression, never stronger.
"""

from __future__ import annotations

from itertools import product
from re import _constants as ops
from re import _parser as parser

ANY = frozenset([frozenset()])
MAX_CLASS = 8                # members of a class that are told apart
MAX_STRINGS = 64             # strings followed side by side
MAX_CLAUSES = 64
MAX_TRIGRAMS = 3             # of a clause: its rarest
COMMON_FIRST = "etaoinshrdlucmfwypvbgkqjxz"      # letters by how common they are; anything else is rarer


def _fold(code: int) -> str:
    return chr(code + 32) if 65 <= code <= 90 else chr(code)


def _trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _minimal(clauses) -> frozenset:
    """Without clauses that ask for more than another one does."""
    return frozenset(c for c in clauses if not any(o < c for o in clauses))


def _of_strings(strings: set[str]) -> frozenset:
    return _minimal({_trigrams(s) for s in strings})


def both(a: frozenset, b: frozenset) -> frozenset:
    joined = _minimal({x | y for x, y in product(a, b)})
    if len(joined) <= MAX_CLAUSES:
        return joined
    return min(a, b, key=len)                              # weaker, so still right


def either(queries: list[frozenset]) -> frozenset:
    clauses = _minimal(set().union(*queries))
    return clauses if len(clauses) <= MAX_CLAUSES else ANY


class _Run:
    """Follows a sequence: what must hold so far, and the strings that the last part can be."""

    def __init__(self):
        self.query, self.strings = ANY, {""}

    def close(self, left: set[str] | None = None) -> None:
        self.query = both(self.query, _of_strings(self.strings))
        self.strings = left or {""}

    def append(self, choices: set[str]) -> None:
        if len(self.strings) * len(choices) > MAX_STRINGS:
            tails = {s[-2:] for s in self.strings}
            self.close(tails if len(tails) * len(choices) <= MAX_STRINGS else None)
            if len(choices) > MAX_STRINGS:
                return
        self.strings = {s + c for s in self.strings for c in choices}

    def walk(self, items) -> None:
        for op, value in items:
            if op is ops.LITERAL:
                self.append({_fold(value)})
            elif op is ops.IN:
                members = _members(value)
                self.append(members) if members else self.close()
            elif op is ops.SUBPATTERN:
                self.walk(value[-1])
            elif op is ops.BRANCH:
                self._branch([_analyse(x) for x in value[1]])
            elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT, ops.POSSESSIVE_REPEAT):
                self._repeat(*value)
            elif op is not ops.AT:
                self.close()

    def _branch(self, parts: list[_Run]) -> None:
        if all(p.query == ANY for p in parts) and sum(len(p.strings) for p in parts) <= MAX_STRINGS and all(p.whole for p in parts):
            self.append(set().union(*(p.strings for p in parts)))
            return
        self.close()
        for p in parts:
            p.close()
        self.query = both(self.query, either([p.query for p in parts]))

    def _repeat(self, low: int, high: int, items) -> None:
        inner = _analyse(items)
        if (low, high) == (0, 1) and inner.whole:
            self.append(inner.strings | {""})
            return
        for _ in range(min(int(low), 8)):
            self.walk(items)
        if high != low or low > 8:
            self.close()


def _analyse(items) -> _Run:
    run = _Run()
    run.walk(items)
    run.whole = run.query == ANY and _enumerable(items)
    return run


def _members(items) -> set[str] | None:
    """Letters of a small class; None if it is large or negated."""
    out: set[str] = set()
    for op, value in items:
        if op is ops.LITERAL:
            out.add(_fold(value))
        elif op is ops.RANGE and value[1] - value[0] < 64:
            out |= {_fold(c) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= MAX_CLASS else None


def _enumerable(items) -> bool:
    """Whether the strings that were followed are all that the items can match."""
    for op, value in items:
        if op is ops.IN and not _members(value) or op is ops.SUBPATTERN and not _enumerable(value[-1]):
            return False
        if op is ops.BRANCH and not all(_enumerable(x) for x in value[1]):
            return False
        if op in (ops.MAX_REPEAT, ops.MIN_REPEAT, ops.POSSESSIVE_REPEAT):
            if (value[0] != value[1] or value[0] > 8) and tuple(value[:2]) != (0, 1) or not _enumerable(value[2]):
                return False
        elif op not in (ops.LITERAL, ops.IN, ops.SUBPATTERN, ops.BRANCH, ops.AT):
            return False
    return True


def _rarest(clause: frozenset[str]) -> frozenset[str]:
    def common(trigram):
        return sum(COMMON_FIRST.find(c) if c in COMMON_FIRST else 40 for c in trigram), trigram
    return frozenset(sorted(clause, key=common, reverse=True)[:MAX_TRIGRAMS])


def query(regex: str) -> frozenset[frozenset[str]]:
    """The clauses of an expression; ``ANY`` if it has no mandatory trigram."""
    run = _analyse(parser.parse(regex))
    run.close()
    return _minimal({_rarest(c) for c in run.query})
