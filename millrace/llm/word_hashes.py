"""Digests of words and of runs of words for a batch of texts, in numpy.

A word is a run of characters other than space and the control characters from tab to carriage return. All digests are
polynomials modulo 2**64 over prefix sums, finished by mixing; two families with different bases are independent.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np

BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
BYTES_AT_ONCE = 1 << 20
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """Powers of the base and of its inverse, at least n of each. What a text longer than BYTES_AT_ONCE needs is not held."""
    found = _POWERS.get(base)
    if found is None or found.shape[1] < n:
        step = np.full((2, max(n, min(n + n // 4, BYTES_AT_ONCE))), base, np.uint64)
        step[1] = pow(base, -1, 1 << 64)
        step[:, 0] = 1
        found = np.multiply.accumulate(step, axis=1)
        if found.shape[1] <= 2 * BYTES_AT_ONCE:
            _POWERS[base] = found
    return found


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def range_digests(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """The digest of values[start:end] for every pair; equal runs have equal digests wherever they stand."""
    powers, inverse = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def word_digests(bodies: Sequence[bytes], families: int = 2) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each text's words begin in the sequence of all words (one more entry than texts), and the words' digests."""
    text = np.frombuffer(b"\n".join(bodies) + b"\n", np.uint8)
    gap = SPACES[text]
    starts, found, at = [], [[] for _ in range(families)], 0
    while at < len(text):
        # A long text is read in stretches that end between words.
        stop = min(at + BYTES_AT_ONCE, len(text))
        stop += int(gap[stop - 1 :].argmax())
        part = gap[at:stop]
        edge = np.flatnonzero(part[1:] != part[:-1]) + 1
        start, end = (edge[::2], edge[1::2]) if part[0] else (np.concatenate([[0], edge[1::2]]), edge[::2])
        values = text[at:stop].astype(np.uint64)
        values += np.uint64(1)
        for digests, base in zip(found, BASES, strict=False):
            digests.append(range_digests(values, start, end, base))
        starts.append(start + at)
        at = stop
    start = np.concatenate(starts)
    digests = [np.concatenate(d) for d in found]
    ends = np.cumsum([len(b) + 1 for b in bodies])
    first = np.concatenate([[0], np.searchsorted(start, ends)])
    return first, digests


def by_size(keys: Iterable, bodies: Iterable[bytes]) -> Iterator[tuple[list, list[bytes]]]:
    """Consecutive texts, about BYTES_AT_ONCE at a time."""
    held_keys, held, size = [], [], 0
    for key, body in zip(keys, bodies, strict=True):
        held_keys.append(key)
        held.append(body)
        size += len(body) + 1
        if size >= BYTES_AT_ONCE:
            yield held_keys, held
            held_keys, held, size = [], [], 0
    if held:
        yield held_keys, held
