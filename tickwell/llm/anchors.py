"""Anchors: positions chosen by content, such that equal windows have equal anchors.

Of the short grams in a window the one with the smallest hash is its anchor
(the first of equal ones). Two windows with the same bytes have their anchor
at the same distance, so a window whose anchor's hash occurs nowhere else is
not repeated. Neighbouring windows mostly share their anchor: a run of windows
is one record.
"""

from __future__ import annotations

import numpy as np
import xxhash

GRAM = 32
#: Windows are handled so many at a time; a position within them fits the low bits of a key.
STEP = 1 << 19
_LOW = np.uint64((1 << 20) - 1)
_rng = np.random.default_rng(77)
_BYTES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _rng.integers(0, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each run of ``GRAM`` bytes, built by doubling."""
    sums, size = _BYTES[data], 1
    for factor in _FACTORS:
        if size == GRAM:
            break
        sums = sums[:-size] * factor + sums[size:]
        size *= 2
    sums = (sums ^ (sums >> np.uint64(29))) * _MIX
    return sums ^ (sums >> np.uint64(32))


def smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    rest = width - size
    return np.minimum(keys[:-rest], keys[rest:]) if rest else keys


def window_runs(raw: bytes, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows of ``length`` bytes that share an anchor.

    Hash of the anchor, hash of all bytes of the run's windows, first and last
    start of a window, and position of the anchor.
    """
    n = len(raw) - length + 1
    if n < 1:
        none = np.empty(0, np.int64)
        return none, none, none, none, none
    data = np.frombuffer(raw, np.uint8)
    hashes, firsts, lasts, anchors = [], [], [], []
    for at in range(0, n, STEP):
        stop = min(n, at + STEP)
        grams = gram_hashes(data[at : stop + length - 1])
        keys = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
        anchor = (smallest(keys, length - GRAM + 1) & _LOW).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
        hashes.append(grams[anchor[first]].view(np.int64))
        anchors.append(anchor[first] + at)
        firsts.append(first + at)
        lasts.append(np.append(first[1:], stop - at) - 1 + at)
    first, last = np.concatenate(firsts), np.concatenate(lasts)
    digest = xxhash.xxh3_64_intdigest
    spans = zip(first.tolist(), (last + length).tolist())
    whole = np.array([digest(raw[a:b]) for a, b in spans], dtype=np.uint64).view(np.int64)
    return np.concatenate(hashes), whole, first, last, np.concatenate(anchors)
