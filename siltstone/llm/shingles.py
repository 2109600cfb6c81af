"""Word shingles of whole texts as 64-bit numbers."""

from __future__ import annotations

import hashlib

import numpy as np

#: White space that parts words: space and \t to \r.
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_SPACE_BYTES = bytes(np.flatnonzero(_SPACE).tolist())
#: Bytes hashed at a time; cuts fall on white space.
SEGMENT = 4 << 20

_U64 = np.uint64
_random = np.random.Generator(np.random.PCG64(20240131))
_BYTE = _random.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = int(_random.integers(0, 2**63)) * 2 + 1
_PLACES = _random.integers(0, 2**63, 64, dtype=np.uint64) * _U64(2) + _U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the splitmix64 finaliser)."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U64(27))
    x = x * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SEGMENT + 1)
            inverse = pow(_BASE, -1, 2**64)
            steps = np.full(size, _BASE, np.uint64), np.full(size, inverse, np.uint64)
            steps[0][0] = steps[1][0] = 1
            self.up, self.down = np.multiply.accumulate(steps[0]), np.multiply.accumulate(steps[1])
        return self.up, self.down


_powers = _Powers()


def word_hashes(text: bytes) -> np.ndarray:
    """A number for each word of the text, in order; equal words have equal numbers."""
    found = []
    at = 0
    while at < len(text):
        end = min(len(text), at + SEGMENT)
        while end < len(text) and text[end] not in _SPACE_BYTES:
            end += 1
        found.append(_segment_hashes(text[at:end])[0])
        at = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def _segment_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, and where they start."""
    codes = np.frombuffer(text, np.uint8)
    up, down = _powers.upto(len(codes) + 1)
    edge = np.ones(len(codes) + 2, bool)
    edge[1:-1] = _SPACE[codes]
    starts = np.flatnonzero(edge[:-1] & ~np.append(edge[1:-1], True))
    ends = np.flatnonzero(~edge[1:-1] & edge[2:]) + 1
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_BYTE[codes] * up[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def many_word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """``word_hashes`` of each text; short ones are hashed together."""
    out: list[np.ndarray] = [np.empty(0, np.uint64)] * len(texts)
    group: list[int] = []
    size = 0

    def flush():
        nonlocal group, size
        if group:
            hashes, starts = _segment_hashes(b"\n".join(texts[i] for i in group))
            bounds = np.cumsum([len(texts[i]) + 1 for i in group])
            for i, own in zip(group, np.split(hashes, np.searchsorted(starts, bounds[:-1]))):
                out[i] = own
        group, size = [], 0

    for i, text in enumerate(texts):
        if len(text) > SEGMENT // 4:
            out[i] = word_hashes(text)
            continue
        if size + len(text) + 1 > SEGMENT:
            flush()
        group.append(i)
        size += len(text) + 1
    flush()
    return out


def shingle_set(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct shingles of ``width`` words.

    Fewer words make one shingle of them all; none make an empty set.
    """
    if not len(words):
        return words
    used = min(width, len(words))
    total = np.zeros(len(words) - used + 1, np.uint64)
    for k in range(used):
        total += words[k : k + len(total)] * _PLACES[k]
    return np.unique(mix(total + _U64(used)))


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
