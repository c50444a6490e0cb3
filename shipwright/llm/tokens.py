"""Exact, vectorised tokenizer calls: split into independent pieces, encode distinct ones once.

Byte-pair encoders work inside pre-tokens, so a text may be cut at any place that is certainly
a pre-token boundary and the parts encoded apart. ``PieceEncoder`` cuts a batch of texts with
Arrow kernels, dictionary-encodes the pieces, asks the library for each distinct piece once
(kept in a bounded cache while a task runs) and gathers the ids back with numpy. Texts with
anything the cutting rule doesn't cover go to the library whole, so the ids are always those
of ``Tokenizer.encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shipwright.llm.common import give_back

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # Spark runs the tasks; no threads inside one

MAX_CACHED_PIECES = 400_000   # entries; the cache is emptied when it is full
CHUNK_BYTES = 6 << 20         # texts handled at once
JOINED = 64                   # distinct pieces given to the library in one string

# A letter followed by one of these marks is a pre-token boundary in both vocabularies.
_LETTER_MARK = r"([A-Za-zß-öø-ÿ])([.,;:!?|*$#%&])"
_CUT = "\x01"                # marks a cut that isn't at a space
_ANY_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_UNEVEN_SPACE = rf"^[ \n]|[ \n]$|{_ANY_SPACE}[ \n]|[ \n]{_ANY_SPACE}"
_ENCODERS: dict[tuple, "PieceEncoder"] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encoder(path: str, style: str) -> "PieceEncoder":
    """The worker's encoder for a tokenizer file; ``style`` is ``spaces_dropped`` or ``space_prefixed``."""
    key = (path, style)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, style)
    return _ENCODERS[key]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES):
    """Slices of a string array of about ``limit`` bytes each (one text at least)."""
    if len(texts) == 0:
        return
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(texts)]):
        yield int(lo), int(hi)


class PieceEncoder:
    def __init__(self, path: str, style: str):
        from tokenizers import Tokenizer
        assert style in ("spaces_dropped", "space_prefixed")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.style = style
        self.cache: dict[str, bytes] = {}

    def forget(self) -> None:
        """Empties the cache: a reused worker must not carry it into the tasks of other stages."""
        self.cache.clear()
        give_back()

    def whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offsets): text i has ids[offsets[i]:offsets[i+1]]. Nulls count as empty."""
        # ascii_lower reads a sliced array from a wrong place, so a slice is copied first
        texts = pc.fill_null(texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts)))), "")
        odd = self._odd(texts)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        pieces = self._pieces(plain)
        flat, bounds = pieces.flatten(), pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        coded = flat.dictionary_encode()
        blobs = self._encode(coded.dictionary.to_pylist())
        width = np.fromiter((len(b) >> 2 for b in blobs), np.int64, len(blobs))
        store = np.frombuffer(b"".join(blobs), dtype=np.uint32)
        first = np.cumsum(width) - width
        which = coded.indices.to_numpy(zero_copy_only=False)
        lengths = width[which] if len(which) else np.zeros(0, np.int64)
        ends = np.r_[0, np.cumsum(lengths)]
        out = store[np.repeat(first[which] - ends[:-1], lengths) + np.arange(ends[-1])] if ends[-1] else store[:0]
        offsets = ends[bounds]
        if odd.any():
            parts = [out[offsets[i]:offsets[i + 1]] for i in range(len(texts))]
            for i in np.flatnonzero(odd):
                parts[i] = self.whole(texts[int(i)].as_py())
            out, offsets = np.concatenate(parts), np.r_[0, np.cumsum([len(p) for p in parts])]
        return out, offsets

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text."""
        return np.diff(self.ids(texts)[1])

    def _odd(self, texts: pa.Array) -> np.ndarray:
        """Texts the cutting rule doesn't cover: special strings, the cutting mark, runs of white space."""
        odd = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring(texts, _CUT))
        if self.style == "space_prefixed":
            odd = pc.or_(odd, pc.match_substring_regex(texts, _UNEVEN_SPACE))
        return odd.to_numpy(zero_copy_only=False).astype(bool)

    def _pieces(self, texts: pa.Array):
        if self.style == "spaces_dropped":
            low = pc.ascii_lower(texts)
            return pc.ascii_split_whitespace(pc.replace_substring_regex(low, _LETTER_MARK, r"\1 \2"))
        marked = pc.replace_substring_regex(texts, _LETTER_MARK, "\\1 " + _CUT + "\\2")
        marked = pc.binary_join_element_wise(pa.scalar(_CUT, pa.large_string()), marked, pa.scalar("", pa.large_string()))
        return pc.split_pattern(pc.replace_substring(marked, "\n", " \n"), " ")

    def _string(self, piece: str) -> str:
        """The part of the text that a piece stands for."""
        if self.style == "spaces_dropped" or piece[:1] == "\n":
            return piece
        return piece[1:] if piece[:1] == _CUT else " " + piece

    def _joinable(self, string: str) -> bool:
        if self.style == "spaces_dropped":
            return True
        return string[:1] in (" ", "\n") and not string[-1:].isspace()

    def _encode(self, pieces: list[str]) -> list[bytes]:
        cache = self.cache
        out = [cache.get(p) for p in pieces]
        missing = [i for i, b in enumerate(out) if b is None]
        if not missing:
            return out
        if len(cache) + len(missing) > MAX_CACHED_PIECES:
            cache.clear()
        keep = len(missing) <= MAX_CACHED_PIECES
        strings = {i: self._string(pieces[i]) for i in missing}
        together = [i for i in missing if self._joinable(strings[i])]
        alone = [i for i in missing if not self._joinable(strings[i])]
        for i, e in zip(alone, self.tokenizer.encode_batch_fast([strings[i] for i in alone], add_special_tokens=False)):
            out[i] = np.asarray(e.ids, dtype=np.uint32).tobytes()
        glue = " " if self.style == "spaces_dropped" else ""
        groups = [together[k:k + JOINED] for k in range(0, len(together), JOINED)]
        joined = [glue.join(strings[i] for i in g) for g in groups]
        for g, e in zip(groups, self.tokenizer.encode_batch(joined, add_special_tokens=False)):
            ids = np.asarray(e.ids, dtype=np.uint32)
            at = np.fromiter((o[0] for o in e.offsets), np.int64, len(ids))
            starts = np.cumsum([0] + [len(strings[i]) + len(glue) for i in g])
            cuts = np.searchsorted(at, starts)
            for k, i in enumerate(g):
                out[i] = ids[cuts[k]:cuts[k + 1]].tobytes()
        if keep:
            cache.update((pieces[i], out[i]) for i in missing)
        return out
