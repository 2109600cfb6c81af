"""Registers of exponentially spaced, truncated minima.

Every element of a set is a Poisson process whose points fall on random registers.
A register holds the floor of 1 - log_b of the least point on it, so the registers
of a union are the larger ones of its parts. Two sets agree on a register about as
often as they share elements.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

from siltstone.llm.shingles import mix

_U64 = np.uint64
_STEP = _U64(0x9E3779B97F4A7C15)
LOW_BITS = 2


@dataclass(frozen=True)
class SketchShape:
    registers: int = 128
    base: float = 1.001
    rate: float = 20.0
    largest: int = 65534  # registers are truncated to 0 .. largest + 1

    def sketch(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of registers for each set of 64-bit numbers; an empty set has zeros.

        Points are made in rising order and only as far as a bound that a set's
        registers hardly ever exceed; a set with a register left gets a larger bound.
        """
        sizes = np.array([len(s) for s in sets], np.int64)
        out = np.zeros((len(sets), self.registers), np.uint16)
        todo, spread = np.flatnonzero(sizes), math.log(self.registers) + 5
        while len(todo):
            bound = spread / (sizes[todo] * self.rate)
            least = self._least([sets[i] for i in todo], bound)
            done = np.isfinite(least).all(axis=1)
            values = np.floor(1 - np.log(least[done]) / math.log(self.base))
            out[todo[done]] = np.clip(values, 0, self.largest + 1)
            todo, spread = todo[~done], spread * 2
        return out

    def _least(self, sets: list[np.ndarray], bound: np.ndarray) -> np.ndarray:
        """The least point on every register below each set's bound, else infinity."""
        m = self.registers
        least = np.full(len(sets) * m, np.inf)
        element = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        reached = np.zeros(len(element))
        first, width = 0, 1
        while len(element):
            steps = np.arange(first + 1, first + width + 1, dtype=np.uint64) * _STEP
            bits = mix(element[:, None] + steps)
            uniform = ((bits >> _U64(11)).astype(float) + 0.5) / (1 << 53)
            points = np.cumsum(-np.log(uniform), axis=1)
            points *= 1 / (m * self.rate)
            points += reached[:, None]
            slot = (mix(bits + _STEP) % _U64(m)).astype(np.int64) + owner[:, None] * m
            below = points < bound[owner][:, None]
            np.minimum.at(least, slot[below], points[below])
            on = below[:, -1]
            element, owner, reached = element[on], owner[on], points[on, -1]
            first, width = first + width, min(16, width * 4)
        return least.reshape(-1, m)

    def joint_estimate(
        self, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray
    ) -> np.ndarray:
        """Maximum-likelihood Jaccard similarity of each row of ``a`` with that of ``b``.

        Uses how many registers are larger, smaller and equal, and the sizes of the
        sets; the likelihood has one maximum, which ternary search finds.
        """
        larger = (a > b).sum(axis=1)
        smaller = (a < b).sum(axis=1)
        equal = a.shape[1] - larger - smaller
        total = (size_a + size_b).astype(float)
        u, v = size_a / total, size_b / total
        low, high = np.zeros(len(a)), np.minimum(size_a, size_b) / np.maximum(size_a, size_b)

        def chance(x):
            return -np.log1p(-x * (self.base - 1) / self.base) / math.log(self.base)

        def likelihood(j):
            p, q = chance(np.maximum(u - v * j, 1e-12)), chance(np.maximum(v - u * j, 1e-12))
            rest = np.maximum(1 - p - q, 1e-12)
            return larger * np.log(p) + smaller * np.log(q) + equal * np.log(rest)

        for _ in range(40):
            third = (high - low) / 3
            left = likelihood(low + third) >= likelihood(high - third)
            low, high = np.where(left, low, low + third), np.where(left, high - third, high)
        return (low + high) / 2


def low_planes(registers: np.ndarray) -> np.ndarray:
    """The lowest bits of 128 registers as four 64-bit words, one bit after the other."""
    planes = [
        np.packbits((registers >> k) & 1, axis=1, bitorder="little").view(np.uint64)
        for k in range(LOW_BITS)
    ]
    return np.concatenate(planes, axis=1)


def low_matches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers whose low bits agree, for each row of ``a`` with each of ``b``."""
    words = a.shape[1] // LOW_BITS
    differ = a[:, None, :] ^ b[None, :, :]
    differ = differ[..., :words] | differ[..., words:]
    return 64 * words - np.bitwise_count(differ).sum(axis=2, dtype=np.int64)


def matches_for(similarity: float, registers: int) -> float:
    """Agreeing low bits to expect: equal registers, and a quarter of the others."""
    chance = 0.5**LOW_BITS
    return registers * (similarity + (1 - similarity) * chance)
