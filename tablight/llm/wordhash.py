"""Words and word shingles of many texts at once, as 64-bit hashes (numpy).

A word is a maximal run of bytes other than space and 0x09-0x0D of the UTF-8
text. Its hash adds a random value of each byte times a power of its place and
is finished with an avalanche; the chance that two given words collide is about
2^-60. All arithmetic is modulo 2^64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_U = np.uint64
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**64, 256, dtype=_U)
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit values (xor-shift-multiply)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int) -> np.ndarray:
    p = np.empty(n, _U)
    p[:] = _BASE
    p[:1] = 1
    return np.multiply.accumulate(p)


@dataclass
class Words:
    """Words of a run of texts, in order: hash, text number, byte range in ``buf``."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    n_docs: int


def words(texts: list[bytes], lower: bool = True) -> Words:
    joined = b"\n".join(texts) + b"\n"
    if lower:
        joined = joined.lower()  # of bytes: A-Z only
    buf = np.frombuffer(joined, np.uint8)
    space = _SPACE[buf]
    step = np.diff(space.view(np.int8), prepend=np.int8(1))
    start, end = np.flatnonzero(step == -1), np.flatnonzero(step == 1)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    doc = np.searchsorted(ends, start, side="right")
    size = end - start
    if not len(start):
        return Words(buf, start, end, doc, np.zeros(0, _U), len(texts))
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    values = _BYTE[buf[~space]] * _powers(int(size.max()))[place]
    h = mix(np.add.reduceat(values, first) + size.astype(_U) * _U(0xD6E8FEB86659FD93))
    return Words(buf, start, end, doc, h, len(texts))


def shingles(w: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each distinct shingle of ``width`` words, sorted by
    both. A text with 1 to ``width - 1`` words has its whole sequence as one."""
    n = len(w.hash)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    per = np.bincount(w.doc, minlength=w.n_docs)
    first = np.cumsum(per) - per
    acc, mult = np.zeros(n, _U), _U(0xA0761D6478BD642F | 1)
    for k in range(width):
        part = np.zeros(n, _U)
        part[: n - k] = w.hash[k:]
        acc = acc * mult + part
    full = np.arange(n) - first[w.doc] <= per[w.doc] - width
    doc, h = w.doc[full], mix(acc[full])
    short = np.flatnonzero((per > 0) & (per < width))
    if len(short):
        whole = [int(mix(np.array([_fold(w.hash[first[d] : first[d] + per[d]]) + _U(int(per[d]))], _U))[0]) for d in short]
        doc, h = np.concatenate([doc, short]), np.concatenate([h, np.array(whole, _U)])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[keep], h[keep]


def _fold(hs: np.ndarray) -> np.uint64:
    acc = 0
    for h in hs:
        acc = (acc * 0xE7037ED1A0B428DB + int(h)) % 2**64
    return _U(acc)
