"""Word shingles of whole texts as 64-bit hashes, for batches of documents at once.

Words are runs of bytes that are not 0x20 or 0x09-0x0D after lower-casing A-Z. A
word's hash is a polynomial over random byte values, read from prefix sums; a
shingle's hash mixes its words' hashes by place.
"""

from __future__ import annotations

import functools

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_rng = np.random.default_rng(77)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) | _U(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    return tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)]), dtype=np.uint64)
                 for b in (_BASE, inverse))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n at least."""
    return _powers(1 << max(16, int(n).bit_length()))


def words(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(document number, hash) of every word of the batch, in order."""
    if not bodies:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    buf = np.frombuffer(b" ".join(bodies).lower() + b" ", np.uint8)
    space = _SPACE[buf]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    ends = np.flatnonzero(space & ~np.concatenate([[True], space[:-1]]))
    up, down = powers(len(buf))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[buf] * up[:len(buf)], dtype=np.uint64)])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    firsts = np.cumsum([0] + [len(b) + 1 for b in bodies])
    return np.searchsorted(firsts, starts, "right") - 1, hashes


def shingle_sets(bodies: list[bytes], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, values): sorted distinct shingles of document i are values[bounds[i]:bounds[i + 1]].

    A document of fewer than ``size`` words has one shingle, the whole sequence; without words it has none."""
    doc, w = words(bodies)
    n_docs = len(bodies)
    n_words = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(n_words)])
    full = np.zeros(0, np.uint64)
    full_doc = np.zeros(0, np.int64)
    if len(w) >= size:
        acc = np.zeros(len(w) - size + 1, np.uint64)
        for j in range(size):
            acc += w[j:len(w) - size + 1 + j] * _PLACE[j]
        inside = doc[:len(acc)] == doc[size - 1:]
        full, full_doc = mix(acc[inside]), doc[:len(acc)][inside]
    short = np.flatnonzero((n_words > 0) & (n_words < size))
    few = np.array([int(sum(int(w[first[d] + j]) * int(_PLACE[j]) for j in range(n_words[d]))) + int(n_words[d])
                    & (2**64 - 1) for d in short], dtype=np.uint64)
    values = np.concatenate([full, mix(few)])
    docs = np.concatenate([full_doc, short])
    order = np.lexsort((values, docs))
    values, docs = values[order], docs[order]
    once = np.ones(len(values), bool)
    once[1:] = (values[1:] != values[:-1]) | (docs[1:] != docs[:-1])
    values, docs = values[once], docs[once]
    return np.concatenate([[0], np.cumsum(np.bincount(docs, minlength=n_docs))]), values


def steps(lengths, limit: int = 1 << 19):
    """Slices (start, stop) of consecutive rows of about ``limit`` bytes together."""
    at, held = 0, 0
    for i, n in enumerate(lengths):
        held += n
        if held >= limit:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(lengths):
        yield at, len(lengths)
