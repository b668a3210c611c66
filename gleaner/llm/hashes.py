"""Vectorised 64-bit hashes: of single values, and of any stretch of a sequence from prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_BASE = 0x9E3779B97F4A7C15 | 3


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    with np.errstate(over="ignore"):
        while done < n:
            m = min(done, n - done)
            out[done : done + m] = out[:m] * np.uint64(pow(base, done, 1 << 64))
            done += m
    return out


_POWER: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWER.get("up", ())) < n:
        _POWER["up"], _POWER["down"] = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
    return _POWER["up"], _POWER["down"]


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefixes:
    """Hashes of any stretches of a sequence of 64-bit codes."""

    def __init__(self, codes: np.ndarray):
        up, self.down = _power(len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * up[: len(codes)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of width values, the place of its smallest (by the upper 32 bits; leftmost of equals)."""
    low = (values & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(values), dtype=np.uint64)
    done = 1
    while done * 2 <= width:
        low = np.minimum(low[:-done], low[done:])
        done *= 2
    if done < width:
        low = np.minimum(low[: len(low) - (width - done)], low[width - done :])
    return (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


class Codes(dict):
    """Codes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 16:
            self.clear()
        self[word] = code = xxhash.xxh3_64_intdigest(word)
        return code


def codes(text: str | None, memory: Codes) -> np.ndarray:
    """A code for each lower-cased word."""
    words = (text or "").encode().lower().split()
    return np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))


def word_places(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The codes of the different lower-cased words of a column of texts (null: none), for each word in order the place of its code, and words in each text. The codes are those of codes()."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    sizes, words = pc.list_value_length(found).to_numpy().astype(np.int64), found.flatten()
    bare = pc.equal(pc.binary_length(words), 0)  # before a text's first word and behind its last
    if bare.true_count:
        bare = bare.to_numpy(zero_copy_only=False)
        sizes -= np.bincount(np.repeat(np.arange(len(sizes)), sizes)[bare], minlength=len(sizes))
        words = words.filter(pa.array(~bare))
    words = words.dictionary_encode()
    own = words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own)), words.indices.to_numpy(), sizes


#: Bytes of text that are coded at once.
CODED = 8 << 20


def coded_parts(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """word_places() of stretches of a column, each of about CODED bytes or of one text."""
    if not len(texts):
        return
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
    cut = np.flatnonzero(np.diff(np.cumsum(size) // CODED, prepend=-1)).tolist()
    for s, e in zip(cut, [*cut[1:], len(texts)], strict=True):
        yield word_places(texts.slice(s, e - s))


def coded(texts: pa.Array) -> Iterator[np.ndarray]:
    """codes() of each text of a column, many texts at once."""
    for own, place, sizes in coded_parts(texts):
        yield from np.split(own[place], np.cumsum(sizes)[:-1])
