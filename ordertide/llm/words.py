"""Word hashes of whole texts in numpy, for use inside Spark tasks.

Texts are hashed in pieces of about a megabyte cut at separators, so memory
stays bounded by the piece and the 8 bytes a word that are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15)

_byte = np.arange(256)
# ASCII white space separates words.
SPACE = (_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D))
# Anything but ASCII letters, digits and bytes of other scripts separates.
PUNCTUATION = (_byte < 0x80) & ~(((_byte >= 48) & (_byte <= 57)) | ((_byte >= 65) & (_byte <= 90)) | ((_byte >= 97) & (_byte <= 122)))
LOWERED = np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte).astype(np.uint8)

_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift-multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 1024), _P, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


def _pieces(text: bytes, separators: np.ndarray) -> Iterator[bytes]:
    at = 0
    while len(text) - at > PIECE:
        window = np.frombuffer(text, np.uint8, PIECE, at)
        gaps = np.flatnonzero(separators[window])
        if len(gaps):
            end = at + int(gaps[-1]) + 1
        else:  # one word longer than a piece: take it whole
            rest = np.flatnonzero(separators[np.frombuffer(text, np.uint8, -1, at)])
            end = at + int(rest[0]) + 1 if len(rest) else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def _hash_joined(data: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of every word of ``data``, which ends with a separator."""
    inside = ~separators[data]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    chars = LOWERED[data[inside]].astype(np.uint64) + np.uint64(1)
    place = np.arange(len(chars)) - np.repeat(first, lengths)
    chars *= _power_table(int(lengths.max()) + 1)[place]
    return mix(np.add.reduceat(chars, first) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), starts


def word_hashes(texts: list[bytes], separators: np.ndarray = SPACE) -> Iterator[np.ndarray]:
    """For each text the 64-bit hashes of its words, A-Z lower-cased."""
    batch: list[bytes] = []
    size = 0

    def flush() -> Iterator[np.ndarray]:
        if not batch:
            return
        bounds = np.cumsum([0] + [len(t) + 1 for t in batch])
        hashes, starts = _hash_joined(np.frombuffer(b" ".join(batch) + b" ", np.uint8), separators)
        cuts = np.searchsorted(starts, bounds)
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield hashes[a:b]

    for text in texts:
        if len(text) > PIECE:
            yield from flush()
            batch, size = [], 0
            parts = [_hash_joined(np.frombuffer(p + b" ", np.uint8), separators)[0] for p in _pieces(text, separators)]
            yield np.concatenate(parts)
            continue
        batch.append(text)
        size += len(text)
        if size > PIECE:
            yield from flush()
            batch, size = [], 0
    yield from flush()


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of ``width``-word shingles; with fewer words the
    whole sequence is one shingle, without words there is none."""
    n = len(words)
    if not n:
        return words
    if n < width:
        total = np.array([n], np.uint64)
        for w in words:
            total = mix(total * _P + w)
        return total
    total = words[: n - width + 1].copy()
    for k in range(1, width):
        total = mix(total * _P) + words[k : n - width + 1 + k]
    return np.unique(mix(total))
