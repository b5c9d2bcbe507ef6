"""Words of many texts at once, in array operations: where they lie, and a 64-bit hash of their letters."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

_LETTER, _MARK, _SPACE = 1, 2, 0
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Characters whose sums are taken at once: few, as each takes some 60 bytes meanwhile and its powers 32 for good.
SEGMENT = 1 << 16
#: Characters of the texts that are cut at once.
PIECE = 1 << 20


@cache
def _kinds() -> np.ndarray:
    """Of each code point: white space, a letter of a word (as \\w has it), or a mark that is a token alone."""
    out = np.full(0x110000, _MARK, dtype=np.uint8)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalnum() or c == "_":
            out[cp] = _LETTER
        elif c.isspace():
            out[cp] = _SPACE
    return out


_KEPT: list = []


def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse, 2 ** bits or more of them; the largest made are kept."""
    if _KEPT and len(_KEPT[0][0]) >= 1 << bits:
        return _KEPT[0]
    both = [np.full(1 << bits, x, dtype=np.uint64) for x in (_BASE, _INVERSE)]
    for x in both:
        x[0] = 1
    _KEPT[:] = [(np.cumprod(both[0]), np.cumprod(both[1]))]
    return _KEPT[0]


class Words(NamedTuple):
    """Words (runs of letters, digits and _) and single marks, lower case, in order: the code points of all texts, the
    first and last place of each word, the number of its text, and its hash."""

    cp: np.ndarray
    first: np.ndarray
    last: np.ndarray
    of: np.ndarray
    hash: np.ndarray

    def spelled(self, i: int) -> str:
        return self.cp[self.first[i] : self.last[i] + 1].tobytes().decode("utf-32-le", "surrogatepass")

    def only(self, at: np.ndarray) -> Words:
        """The words at these places, with their own code points alone."""
        size = self.last[at] - self.first[at] + 1
        ends = np.cumsum(size)
        cp = self.cp[np.repeat(self.first[at] - (ends - size), size) + np.arange(ends[-1] if len(at) else 0)]
        return Words(cp, (ends - size).astype(np.int32), (ends - 1).astype(np.int32), self.of[at], self.hash[at])


def cut(texts: list[str | None]) -> Words:
    """The words of texts; null is empty."""
    parts = [(t or "").lower() for t in texts]
    cp = np.frombuffer("\n".join([*parts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kind = _kinds()[cp]
    start = kind != _SPACE
    start[1:] &= (kind[1:] == _MARK) | (kind[:-1] != _LETTER)
    first = np.flatnonzero(start)
    end = kind == _LETTER
    end[:-1] &= kind[1:] != _LETTER
    end |= kind == _MARK
    last = np.flatnonzero(end)
    h = np.empty(len(first), dtype=np.uint64)
    at = 0
    while at < len(first):  # segments of whole words, as sums and powers are arrays of a segment's length
        to = max(at + 1, int(np.searchsorted(last, first[at] + SEGMENT)))
        lo, hi = first[at], last[to - 1] + 1
        up, down = _powers(int(hi - lo).bit_length())
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((cp[lo:hi].astype(np.uint64) + np.uint64(1)) * up[: hi - lo])])
        h[at:to] = (sums[last[at:to] + 1 - lo] - sums[first[at:to] - lo]) * down[first[at:to] - lo]
        at = to
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    bounds = np.cumsum([len(p) + 1 for p in parts])  # where each text's end of line lies, plus one
    return Words(cp, first, last, np.searchsorted(bounds, first, side="right").astype(np.int32), h.view(np.int64))


def pieces(texts: list[str | None], chars: int = PIECE) -> Iterator[list[str | None]]:
    """The texts in order, in lists of about so many characters together at most; a longer text is alone."""
    some: list[str | None] = []
    size = 0
    for t in texts:
        n = len(t) if t else 0
        if some and size + n > chars:
            yield some
            some, size = [], 0
        some.append(t)
        size += n
    if some:
        yield some


def counted(key: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each different key: the key, one place where it stands, how often it stands and in how many texts."""
    if not len(key):
        none = np.empty(0, dtype=np.int64)
        return key, none, none, none
    order = np.lexsort((of, key))
    k, t = key[order], of[order]
    new = np.concatenate([[True], k[1:] != k[:-1]])
    apart = new.copy()
    apart[1:] |= t[1:] != t[:-1]
    first = np.flatnonzero(new)
    return k[first], order[first], np.diff(np.append(first, len(k))), np.add.reduceat(apart.astype(np.int64), first)


def summed(key: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each different key: the key, one place where it stands, and its sums of the columns."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    new = np.ones(len(key), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    return key[first], order[first], *(np.add.reduceat(c[order], first, dtype=np.int64) if len(key) else c for c in columns)


def listed(key: np.ndarray, of: np.ndarray, texts: int) -> pa.ListArray:
    """For each of so many texts, its different keys and how often each stands there: array<struct<token, times>>."""
    order = np.lexsort((key, of))
    k, t = key[order], of[order]
    new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])])) if len(k) else np.empty(0, dtype=np.int64)
    times = np.diff(np.append(new, len(k))).astype(np.int32)
    offsets = np.searchsorted(t[new], np.arange(texts + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(k[new]), pa.array(times)], ["token", "times"]))
