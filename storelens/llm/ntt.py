"""Exact matches of many patterns, each in a window of its own, by whole-number transforms (numpy)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Primes with long power-of-two cycles, and a generator of each; length of the longest cycle they share
PRIMES = ((469762049, 3), (167772161, 3), (2013265921, 31))
LONGEST = 1 << 25
#: numbers that one step transforms
STEP = 1 << 19


@lru_cache(maxsize=64)
def _twiddles(prime: int, generator: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a root of unity of order ``size``, and of its inverse, up to half the size."""
    root = pow(generator, (prime - 1) // size, prime)
    made = []
    for base in (root, pow(root, -1, prime)):
        powers = np.ones(max(1, size // 2), np.int64)
        filled = 1
        while filled < len(powers):
            step = pow(base, filled, prime)
            powers[filled : 2 * filled] = powers[:filled] * step % prime
            filled *= 2
        made.append(powers)
    return made[0], made[1]


def forward(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Transforms of the rows, in bit-reversed order; their length is a power of two."""
    size = rows.shape[1]
    while size > 1:
        half = size // 2
        view = rows.reshape(len(rows), -1, 2, half)
        low, high = view[:, :, 0], view[:, :, 1]
        powers = _twiddles(prime, generator, size)[0]
        rows = np.stack([(low + high) % prime, (low - high) % prime * powers % prime], axis=2).reshape(rows.shape)
        size = half
    return rows


def backward(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """The rows whose transforms these are."""
    length, size = rows.shape[1], 2
    while size <= length:
        view = rows.reshape(len(rows), -1, 2, size // 2)
        low, high = view[:, :, 0], view[:, :, 1] * _twiddles(prime, generator, size)[1] % prime
        rows = np.stack([(low + high) % prime, (low - high) % prime], axis=2).reshape(rows.shape)
        size *= 2
    return rows * pow(length, -1, prime) % prime


def _mismatch(blocks: np.ndarray, windows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """Sums of squared differences modulo a prime, of each block with its window at each shift below its length."""
    size = blocks.shape[1]
    x, y = blocks % prime, windows % prime
    turned = np.zeros_like(y)
    turned[:, :size] = x[:, ::-1]
    product = forward(turned, prime, generator) * forward(y, prime, generator) % prime
    cross = backward(product, prime, generator)[:, size - 1 : 2 * size - 1]
    squares = np.zeros((len(y), 2 * size + 1), np.int64)
    np.cumsum(y * y % prime, axis=1, out=squares[:, 1:])
    own = (x * x % prime).sum(axis=1, keepdims=True)
    return (own + squares[:, size : 2 * size] - squares[:, :size] - 2 * cross) % prime


def occurrences(values: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(start, distance)`` of all later places at which the block of ``size`` values from ``start`` stands again.

    Distances reach from ``size`` to ``2 * size - 1``; ``size`` is a power of two. The sum of squared differences is taken modulo as many
    primes as make their product larger than any such sum, so that it is zero exactly where nothing differs;
    later primes are asked about blocks that the first ones leave open.
    """
    if 2 * size > LONGEST:
        raise ValueError("the values are too many for the transforms")
    most = int(values.max(initial=0)) + 1
    bound, primes, product = size * most * most, [], 1
    for pair in PRIMES:
        primes.append(pair)
        product *= pair[0]
        if product > bound:
            break
    padded = np.concatenate([values, np.full(3 * size, most, np.int64)])  # matches nothing
    found: list[tuple[np.ndarray, np.ndarray]] = []
    rows = max(1, STEP // (2 * size))
    for a in range(0, len(starts), rows):
        at = starts[a : a + rows]
        blocks = padded[at[:, None] + np.arange(size)]
        windows = padded[at[:, None] + size + np.arange(2 * size)]
        for prime, generator in primes:
            clean = _mismatch(blocks, windows, prime, generator) == 0
            kept = clean if prime == primes[0][0] else kept & clean
            some = kept.any(axis=1)
            at, blocks, windows, kept = at[some], blocks[some], windows[some], kept[some]
            if not len(at):
                break
        row, shift = np.nonzero(kept)
        found.append((at[row], shift + size))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
