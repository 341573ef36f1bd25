"""Hashed words and word shingles of many texts at once, from their bytes."""

from __future__ import annotations

import numpy as np

WORDS = 5
GROUP_BYTES = 1 << 20

_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_BYTES = np.random.default_rng(1).integers(1, 1 << 63, 256, np.uint64)
_PLACES = np.random.default_rng(2).integers(1 << 32, 1 << 63, 64, np.uint64) | np.uint64(1)
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_powers: list[np.ndarray] = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_STEP, _BACK)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words per text): lower-case runs between ASCII white space.

    A word's hash is the difference of two prefix sums of byte values times place powers, shifted back to
    place zero, so that no word is handled on its own.
    """
    parts = [t.lower().encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    space = _SPACE[data]
    before = np.concatenate([[True], space[:-1]])
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    up, down = _power(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up)])
    hashes = mixed((sums[ends] - sums[starts]) * down[starts])
    edges = np.cumsum([0] + [len(p) + 1 for p in parts])
    counts = np.diff(np.searchsorted(starts, edges))
    return hashes, counts


def shingle_hashes(hashes: np.ndarray, counts: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each shingle, text of each shingle): runs of ``size`` words; a shorter text is one shingle."""
    owner = np.repeat(np.arange(len(counts)), counts)
    ends = np.repeat(np.cumsum(counts), counts)
    at = np.arange(len(hashes))
    total = np.zeros(len(hashes), np.uint64)
    for k in range(size):
        there = at + k < ends
        total[: len(hashes) - k] += np.where(there, hashes[np.minimum(at + k, len(hashes) - 1)] * _PLACES[k], np.uint64(0))[: len(hashes) - k]
    first = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, bool)
    keep = (at + size <= ends) | first & (np.repeat(counts, counts) < size)
    return mixed(total[keep]), owner[keep]


def counted(shingles: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct shingles text by text in hash order, times each occurs, offsets of the texts)."""
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    starts = np.flatnonzero(new)
    times = np.diff(np.append(starts, len(shingles)))
    return shingles[starts], times, np.searchsorted(owner[starts], np.arange(texts + 1))


def of_texts(texts: list[str], size: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``counted`` for raw texts, worked out for about ``GROUP_BYTES`` of text at a time."""
    found, start, held = [], 0, 0
    for i, text in enumerate([*texts, None]):
        if text is None or i > start and held + len(text) > GROUP_BYTES:
            found.append(counted(*shingle_hashes(*word_hashes(texts[start:i]), size), i - start))
            start, held = i, 0
        held += len(text or "")
    if len(found) == 1:
        return found[0]
    keys, times, offsets = zip(*found)
    base = np.cumsum([0, *(o[-1] for o in offsets)])
    return np.concatenate(keys), np.concatenate(times), np.concatenate([[0], *(o[1:] + b for o, b in zip(offsets, base))])
