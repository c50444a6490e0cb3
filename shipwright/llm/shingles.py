"""Word shingles of whole texts as sorted distinct 64-bit hashes, vectorised over a batch.

Words are maximal runs of bytes other than blank and 0x09-0x0D after A-Z is lower-cased. A text's
set holds its distinct five-word shingles; with one to four words the whole sequence is the
single shingle; without words the set is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WIDTH = 5
LONG_WORD = 48            # bytes; longer words are hashed one by one
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_PRIME, _BASIS, _STEP = _U(0x100000001B3), _U(0xCBF29CE484222325), _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = pc.fill_null(texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts)))), "")
    _, ends, data = pc.ascii_lower(texts).buffers()
    offsets = np.frombuffer(ends, np.int64)[:len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, number of words of each text)."""
    raw, offsets = _bytes_of(texts)
    if not len(raw):
        return np.zeros(0, _U), np.zeros(len(texts), np.int64)
    inside = ~_SPACE[raw]
    border = np.zeros(len(raw) + 1, bool)
    border[offsets] = True
    starts = np.flatnonzero(inside & (np.r_[True, ~inside[:-1]] | border[:-1]))
    ends = np.flatnonzero(inside & (np.r_[~inside[1:], True] | border[1:])) + 1
    length = ends - starts
    h = np.full(len(starts), _BASIS)
    live = np.flatnonzero(length <= LONG_WORD)
    order = live[np.argsort(length[live], kind="stable")[::-1]]
    sizes = -np.sort(-length[order])
    for k in range(int(sizes[0]) if len(sizes) else 0):
        n = int(np.searchsorted(-sizes, -k, side="left"))      # words longer than k
        at = order[:n]
        h[at] = (h[at] ^ raw[starts[at] + k].astype(_U)) * _PRIME
    for i in np.flatnonzero(length > LONG_WORD):
        h[i] = xxhash.xxh64_intdigest(raw[starts[i]:ends[i]].tobytes())
    per_text = np.diff(np.searchsorted(starts, offsets))
    return mix(h ^ length.astype(_U)), per_text


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets): text i's set is values[offsets[i]:offsets[i+1]], ascending and distinct."""
    words, per_text = word_hashes(texts)
    last = np.cumsum(per_text)
    first = last - per_text
    joined = words
    if len(words) >= WIDTH:
        joined = words[:len(words) - WIDTH + 1].copy()
        with np.errstate(over="ignore"):
            for k in range(1, WIDTH):
                joined = joined * _STEP + words[k:len(words) - WIDTH + 1 + k]
        joined = mix(joined)
    parts, sizes = [], np.zeros(len(per_text), np.int64)
    for i, n in enumerate(per_text):
        if n >= WIDTH:
            part = np.sort(joined[first[i]:last[i] - WIDTH + 1])
            if len(part) > 1:
                part = part[np.r_[True, part[1:] != part[:-1]]]
        elif n:
            x = _U(n)
            with np.errstate(over="ignore"):
                for w in words[first[i]:last[i]]:
                    x = mix(x * _STEP + w)
            part = np.array([x], dtype=_U)
        else:
            continue
        parts.append(part)
        sizes[i] = len(part)
    return (np.concatenate(parts) if parts else np.zeros(0, _U)), np.r_[0, np.cumsum(sizes)]
