"""Integer matrix products in a residue number system.

Both matrices are taken modulo a few primes, so small that a product of residues in single
precision is exact: width * ((p - 1) / 2)^2 stays below 2^24, for residues between -(p-1)/2 and
(p-1)/2. The products modulo each prime give the digits of a mixed-radix number, and
centred digits stand for one signed number below half the product of the primes.
"""

from __future__ import annotations

import numpy as np

_SINGLE = 1 << 24  # whole numbers up to here are exact in single precision


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def primes_for(width: int, bound: int) -> list[int]:
    """The largest fitting primes whose product is above 2 * ``bound``."""
    chosen, product = [], 1
    p = 2 * int((_SINGLE / max(1, width)) ** 0.5) + 1
    while product <= 2 * bound:
        p -= 1
        if p < 3:
            raise ValueError(f"vectors of {width} entries are too long for residues of scores {bound}")
        if p % 2 and _is_prime(p) and width * ((p - 1) // 2) ** 2 < _SINGLE:
            chosen.append(p)
            product *= p
    return chosen


def residues(values: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """``values`` modulo each prime, centred, in single precision."""
    out = []
    for p in primes:
        half = (p - 1) // 2
        out.append((np.mod(values + half, p) - half).astype(np.float32))
    return out


def _centred(values: np.ndarray, p: int) -> np.ndarray:
    # Whole numbers below 2^40 or so: the quotient is never so close to a half as to round wrongly.
    return values - p * np.rint(values / p)


def products(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact a @ b.T as 64-bit integers from the residues of both.

    The true entries must be below half the product of the primes, which must be below 2^62.
    """
    total, weight, digits = None, 1, []
    for k, p in enumerate(primes):
        digit = (a[k] @ b[k].T).astype(np.float64)
        radix = 1
        for earlier, prime in zip(digits, primes, strict=False):
            digit = _centred(digit - earlier * (radix % p), p)
            radix *= prime
        if k:
            digit = _centred(digit, p) * pow(radix, -1, p)
        digit = _centred(digit, p)
        digits.append(digit)
        part = digit.astype(np.int64) * weight
        total = part if total is None else total + part
        weight *= p
    return total
