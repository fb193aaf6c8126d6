"""Keyed permutations of row numbers, as column arithmetic.

A number below n is a cell (left, right) of a table of about sqrt(n) rows and columns. Four
Feistel rounds add a keyed square of one part to the other one, so that each can be undone.
The table has up to sqrt(n) cells too many; a number that lands on one of these walks on by
the same permutation until it is below n. How many steps that can take is worked out from the
cells outside alone, so the walk is written out with no loop and is exact at any n.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIME = (1 << 31) - 1
ROUNDS = 4


def sides(n: int) -> tuple[int, int]:
    """Rows and columns of the smallest near-square table of at least n cells."""
    rows = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return rows, max(1, -(-n // rows))


def key(seed: int, repeat, rnd: int, part: int):
    """A number below PRIME for a repeat, a round and one of its three parts. `repeat` may be
    a number or an array."""
    mixed = ((seed * 1000003 + rnd * 104729 + part * 1299709 + 12345) % PRIME
             + repeat * 7919) % PRIME
    mixed = mixed * 48271 % PRIME
    return (mixed * mixed + 1) % PRIME


def _apply(x: np.ndarray, n: int, seed: int, repeat: int, inverse: bool) -> np.ndarray:
    """The permutation of the cells of the table, on numbers."""
    a, b = sides(n)
    left, right = np.divmod(x.astype(np.int64), b)
    for rnd in (reversed(range(ROUNDS)) if inverse else range(ROUNDS)):
        k = [key(seed, repeat, rnd, part) for part in range(3)]
        z, size = (right, a) if rnd % 2 == 0 else (left, b)
        u = (z * k[0] + k[1]) % PRIME
        moved = (u * u + k[2]) % PRIME % size
        if rnd % 2 == 0:
            left = (left + (a - moved if inverse else moved)) % a
        else:
            right = (right + (b - moved if inverse else moved)) % b
    return left * b + right


def shuffled(x: np.ndarray, n: int, seed: int, repeat: int, inverse: bool = False) -> np.ndarray:
    """Where the permutation of a repeat takes numbers below n."""
    at = _apply(x, n, seed, repeat, inverse)
    outside = np.flatnonzero(at >= n)
    while len(outside):
        at[outside] = _apply(at[outside], n, seed, repeat, inverse)
        outside = outside[at[outside] >= n]
    return at


def longest_walk(n: int, seed: int, repeats: int, inverse: bool = False) -> int:
    """The most cells outside that a number below n crosses in a permutation. A cycle wholly
    outside is never entered."""
    a, b = sides(n)
    longest = 0
    for repeat in range(repeats):
        outside, steps = np.arange(n, a * b), 0
        at = outside[_apply(outside, n, seed, repeat, not inverse) < n]
        while len(at):
            steps += 1
            at = _apply(at, n, seed, repeat, inverse)
            at = at[at >= n]
        longest = max(longest, steps)
    return longest


def permute(df: DataFrame, x: str, out: str, n: int, seed: int, repeats: int,
            repeat: str = "repeat", inverse: bool = False) -> DataFrame:
    """`df` with `out`, where the permutation of a row's `repeat` takes its number `x`.

    One expression, as a chain of columns would be unfolded by the optimizer.
    """
    a, b = sides(n)
    keys = F.array(*[F.lit(key(seed, r, rnd, part)).cast("long") for r in range(repeats)
                     for rnd in range(ROUNDS) for part in range(3)])

    def moved(z: str, size: int) -> str:
        value = (f"transform(array(({z} * _keys[3 * k] + _keys[3 * k + 1]) % {PRIME}L), "
                 f"u -> (u * u + _keys[3 * k + 2]) % {PRIME}L % {size}L)[0]")
        return f"({size}L - {value})" if inverse else value
    order = f"sequence({ROUNDS - 1}, 0, -1)" if inverse else f"sequence(0, {ROUNDS - 1})"
    once = (f"aggregate({order}, named_struct('l', at div {b}L, 'r', at % {b}L), (s, k) -> "
            f"CASE WHEN k % 2 = 0 THEN named_struct('l', (s.l + {moved('s.r', a)}) % {a}L, 'r', s.r)"
            f" ELSE named_struct('l', s.l, 'r', (s.r + {moved('s.l', b)}) % {b}L) END, "
            f"s -> s.l * {b}L + s.r)")
    steps = 1 + longest_walk(n, seed, repeats, inverse)
    walk = (f"aggregate(sequence(1, {steps}), cast(`{x}` AS bigint), (at, step) -> "
            f"CASE WHEN step > 1 AND at < {n}L THEN at ELSE {once} END)")
    part = F.slice(keys, F.col(repeat) * (3 * ROUNDS) + 1, 3 * ROUNDS)
    return df.withColumn("_keys", part).withColumn(out, F.expr(walk)).drop("_keys")
