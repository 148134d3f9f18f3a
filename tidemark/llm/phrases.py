"""Cuts bytes into phrases at rolling-hash triggers (helper of ``suffix``; runs inside tasks, numpy only)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes of the string whose rolling hash decides on a trigger.
TRIGGER = 64
#: Window starts handled at a time; more only means more memory.
SLICE = 1 << 18

_POSITION = np.uint64((1 << 20) - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def rolling_hash(data: np.ndarray, width: int) -> np.ndarray:
    """Mixed polynomial hash of every ``width``-byte string (a power of two), by doubling."""
    with np.errstate(over="ignore"):
        hashed = (data.astype(np.uint64) + np.uint64(1)) * _MIX
        power, have = _BASE, 1
        while have < width:
            hashed = hashed[:-have] * power + hashed[have:]
            power, have = power * power, have * 2
        hashed ^= hashed >> np.uint64(31)
        hashed *= _MIX
        hashed ^= hashed >> np.uint64(29)
    return hashed


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def phrases(data: bytes, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Phrases of one text, some at a time: first window start, number of window starts, place and hash of the trigger.

    A window is a string of ``length`` bytes.  Its trigger is the leftmost of its 64-byte strings whose rolling
    hash is smallest, so equal windows have equal triggers at equal offsets, and every window has one.  A
    phrase is a maximal run of windows with one trigger; with the ``length - 1`` bytes after its last start it
    holds all bytes that decide on these windows.  Runs end at slice ends, which only makes more phrases.
    """
    view = np.frombuffer(data, dtype=np.uint8)
    starts = len(view) - length + 1
    reach = length - TRIGGER + 1
    for first in range(0, starts, SLICE):
        count = min(SLICE, starts - first)
        hashed = rolling_hash(view[first : first + count + length - 1], TRIGGER)
        order = np.arange(len(hashed), dtype=np.uint64)
        chosen = sliding_minimum((hashed & ~_POSITION) | order, reach) & _POSITION
        cut = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        trigger = chosen[cut].astype(np.int64)
        yield first + cut, np.diff(np.append(cut, count)), first + trigger, hashed[trigger]
