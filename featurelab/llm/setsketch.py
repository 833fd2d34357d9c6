"""SetSketch: registers of exponentially spaced, truncated minima, computed for many sets at once.

Each element of a set stands for a Poisson process of points on a line, the same in every set;
every point falls to one of the M registers. A register keeps the smallest point x it has seen, as
the integer floor(1 - log_BASE(RATE-scaled x)), cut to [0, LIMIT + 1]. Larger minima give smaller
integers, so sketches merge by the elementwise maximum, and two sets agree in a register about as
often as their similarity says.
"""

from __future__ import annotations

import math

import numpy as np

M = 128
ROWS = 4  # registers in a band
BANDS = M // ROWS
BASE = 1.001
RATE = 20.0
LIMIT = 2**16 - 2

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketches(elements: np.ndarray, owner: np.ndarray, sets: int) -> np.ndarray:
    """Registers (sets x M, uint16) of sets given as distinct elements and the number of their set.

    Points are generated in rising order, one round for all sets; an element stops as soon as
    its next point lies above all registers of its set.
    """
    least = np.full(sets * M, np.inf)
    at = np.zeros(len(elements))
    live = np.arange(len(elements))
    turn = 0
    while len(live):
        own, seed = owner[live], elements[live]
        turn += 1
        bits = mix(seed + np.uint64(2 * turn * int(_GOLD) & (2**64 - 1)))
        at[live] += -np.log1p(-((bits >> np.uint64(11)).astype(np.float64) * 2.0**-53))
        register = mix(bits + _GOLD) % np.uint64(M)
        np.minimum.at(least, own * M + register.astype(np.int64), at[live])
        highest = least.reshape(sets, M).max(axis=1)
        live = live[at[live] < highest[own]]
    with np.errstate(divide="ignore"):
        level = np.floor(1.0 - np.log(least / (M * RATE)) / math.log(BASE))
    return np.clip(level, 0, LIMIT + 1).astype(np.uint16).reshape(sets, M)


def passes(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the joint maximum-likelihood estimate of the similarity is at least `similarity`.

    a, b: registers of the pairs; na, nb: sizes of their sets. Given the sizes, the counts of
    registers that are larger, smaller and equal have probabilities p(u - vJ), p(v - uJ) and
    the rest, with p(x) = -log_BASE(1 - x (BASE - 1) / BASE), u and v the shares of the sizes. The
    likelihood is concave in J, so the sign of its slope at `similarity` tells the side of its top.
    """
    larger = (a > b).sum(axis=1).astype(float)
    smaller = (a < b).sum(axis=1).astype(float)
    equal = M - larger - smaller
    u = na / (na + nb)
    v = 1.0 - u
    k, c = (BASE - 1) / BASE, math.log(BASE)

    def p(x):
        return -np.log1p(-x * k) / c

    def slope(x):
        return k / (1 - x * k) / c

    x, y = u - v * similarity, v - u * similarity
    possible = (x > 0) & (y > 0)  # else sizes alone forbid this similarity
    x, y = np.where(possible, x, 0.5), np.where(possible, y, 0.5)
    px, py = p(x), p(y)
    dx, dy = -v * slope(x), -u * slope(y)
    score = larger * dx / px + smaller * dy / py - equal * (dx + dy) / np.maximum(1 - px - py, 1e-12)
    return possible & (score >= 0)
