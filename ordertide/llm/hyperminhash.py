"""HyperMinHash sketches of shingle sets, in numpy inside Spark tasks.

A set's hashes are dealt to 2^P registers by their leading bits.  A register
keeps, of the element with the most leading zeros, the zero count and
``MANTISSA`` further bits: 16 bits a register.  Registers are banded for
candidate search; the share of equal registers, corrected for chance
collisions, estimates the Jaccard similarity.
"""

from __future__ import annotations

import numpy as np

from ordertide.llm.words import mix

P = 8
REGISTERS = 1 << P
MANTISSA = 10
ROWS, BANDS = 6, 42  # at similarity 0.85 a pair shares no band with odds 2e-9

# Order in which an empty register looks for a filled one (fixed by a seed).
_PROBES = np.argsort(np.random.default_rng(20240607).random((REGISTERS, REGISTERS)), axis=1)


def registers(hashes: np.ndarray) -> np.ndarray:
    """Registers (uint16, 0 = empty) of sorted distinct 64-bit hashes."""
    out = np.zeros(REGISTERS, np.uint16)
    if not len(hashes):
        return out
    bucket = (hashes >> np.uint64(64 - P)).astype(np.int64)
    other = mix(hashes + np.uint64(0x632BE59BD9B4E019))
    zeros = 53 - np.frexp((other >> np.uint64(11)).astype(np.float64))[1]
    low = (other & np.uint64((1 << MANTISSA) - 1)).astype(np.int64)
    value = ((zeros.astype(np.int64) + 1) << MANTISSA) + ((1 << MANTISSA) - 1 - low)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    out[bucket[first]] = np.maximum.reduceat(value, first)
    return out


def fill_empty(regs: np.ndarray) -> np.ndarray:
    """Rows of registers with every empty one copied from the first filled
    register in its probe order; rows must have a filled register."""
    regs = regs.copy()
    filled = regs != 0
    todo = np.flatnonzero(~filled.all(axis=1))
    have, done = filled[todo], filled[todo].copy()
    source = regs[todo]
    out = source.copy()
    for step in range(REGISTERS):
        if not len(todo):
            break
        donor = _PROBES[:, step]
        take = ~done & have[:, donor]
        out[take] = source[:, donor][take]
        done |= take
        ended = done.all(axis=1)
        regs[todo[ended]] = out[ended]
        left = ~ended
        todo, have, done, source, out = todo[left], have[left], done[left], source[left], out[left]
    return regs


def band_keys(regs: np.ndarray) -> np.ndarray:
    """(sets, BANDS) 64-bit keys (int64) of rows of registers."""
    rows = fill_empty(regs)[:, : ROWS * BANDS].astype(np.uint64).reshape(-1, BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.zeros((len(regs), 1), np.uint64)
    for k in range(ROWS):
        key = mix(key + rows[:, :, k])
    return key.view(np.int64)


def chance_of_collision(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Odds that a register of two disjoint sets of n and m elements agrees.

    With s elements in a register the largest zero count is z with
    probability (1 - 2^-(z+1))^s - (1 - 2^-z)^s; equal counts then need equal
    mantissas, about 2^-MANTISSA.
    """
    z = np.arange(0, 54, dtype=np.float64)

    def spread(size: np.ndarray) -> np.ndarray:
        share = np.maximum(np.asarray(size, np.float64) / REGISTERS, 1e-9)[:, None]
        return (1 - 0.5 ** (z + 1)) ** share - (1 - 0.5**z) ** share

    return (spread(n) * spread(m)).sum(axis=1) / (1 << MANTISSA)


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected Jaccard estimates of row pairs, and the number of
    registers each rests on."""
    used = ((a != 0) | (b != 0)).sum(axis=1)
    equal = ((a == b) & (a != 0)).sum(axis=1)
    chance = chance_of_collision(n, m)
    share = equal / np.maximum(used, 1)
    return np.clip((share - chance) / (1 - chance), 0, 1), used


def may_link(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, threshold: float, sigmas: float = 6.0) -> np.ndarray:
    """Pairs whose sizes and estimate leave room for ``threshold``; a pair at
    the threshold fails with odds of about 1e-9 (six standard errors)."""
    j, used = estimate(a, b, n, m)
    used = np.maximum(used, 1)
    room = sigmas * np.sqrt(threshold * (1 - threshold) / used) + 1.0 / used
    return (np.minimum(n, m) >= threshold * np.maximum(n, m)) & (j >= threshold - room)
