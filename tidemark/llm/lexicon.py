"""A minimal acyclic transducer from words to token ids, in flat arrays that can be memory-mapped."""

from __future__ import annotations

import functools
import mmap
import struct
from collections.abc import Iterable, Sequence

import numpy as np

_MAGIC = b"TMLEX001"


class _State:
    __slots__ = ("edges", "final", "output")

    def __init__(self) -> None:
        #: byte -> [target, output]
        self.edges: dict[int, list] = {}
        self.final = False
        #: Ids that remain when a word ends here.
        self.output: tuple[int, ...] = ()

    def key(self, numbers: dict[int, int]) -> tuple:
        edges = tuple((b, numbers[id(t)], o) for b, (t, o) in sorted(self.edges.items()))
        return self.final, self.output, edges


def _shared(a: Sequence[int], b: Sequence[int]) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def compile_lexicon(entries: Iterable[tuple[bytes, Sequence[int]]]) -> bytes:
    """The transducer's file for (word, ids) in ascending order of word, each word once.

    States are frozen as soon as no later word can reach them, and equal states (same endings, same outputs left to
    give) become one, so the result is minimal (Daciuk and others, 2000; outputs pushed towards the start as by
    Mihov and Maurel, 2001).
    """
    numbers: dict[int, int] = {}
    register: dict[tuple, _State] = {}
    frozen: list[_State] = []

    def freeze(path: list[_State], word: bytes, down_to: int) -> None:
        for i in range(len(word), down_to, -1):
            state = path[i]
            key = state.key(numbers)
            same = register.get(key)
            if same is None:
                register[key] = same = state
                numbers[id(state)] = len(frozen)
                frozen.append(state)
            path[i - 1].edges[word[i - 1]][0] = same

    path, last = [_State()], b""
    for word, ids in entries:
        keep = _shared(last, word)
        freeze(path, last, keep)
        del path[keep + 1 :]
        left = tuple(ids)
        for i in range(keep):  # what the words have in common stays on the way; the rest moves behind
            edge = path[i].edges[word[i]]
            n = _shared(edge[1], left)
            behind, edge[1] = edge[1][n:], edge[1][:n]
            if behind:
                target = edge[0]
                for e in target.edges.values():
                    e[1] = behind + e[1]
                if target.final:
                    target.output = behind + target.output
            left = left[n:]
        for i in range(keep, len(word)):
            path.append(_State())
            path[i].edges[word[i]] = [path[i + 1], left if i == keep else ()]
        path[len(word)].final = True
        path[len(word)].output = () if len(word) > keep else left
        last = word
    freeze(path, last, 0)
    numbers[id(path[0])] = len(frozen)
    frozen.append(path[0])

    outputs: dict[tuple[int, ...], int] = {(): 0}
    pool: list[int] = []

    def place(ids: tuple[int, ...]) -> int:
        if ids not in outputs:
            outputs[ids] = len(pool) + 1
            pool.extend((len(ids), *ids))
        return outputs[ids]

    first, labels, targets, given, ends = [0], [], [], [], []
    for state in frozen:
        for b, (target, ids) in sorted(state.edges.items()):
            labels.append(b)
            targets.append(numbers[id(target)])
            given.append(place(tuple(ids)))
        first.append(len(labels))
        ends.append(place(state.output) if state.final else -1)
    arrays = [
        np.array(first, np.uint32), np.array(targets, np.uint32), np.array(given, np.uint32),
        np.array(ends, np.int32), np.array(pool, np.uint32), np.array(labels, np.uint8),
    ]
    head = _MAGIC + struct.pack("<6Q", *(len(a) for a in arrays))
    return head + b"".join(a.tobytes() for a in arrays)


class Lexicon:
    """Read side: pages of the file are shared by the processes of a machine and loaded as they are needed."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            self._map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        if self._map[:8] != _MAGIC:
            raise ValueError(f"{path} is no lexicon")
        sizes, at, parts = struct.unpack("<6Q", self._map[8:56]), 56, []
        whole = memoryview(self._map)
        for n, kind in zip(sizes[:5], "IIIiI", strict=True):
            parts.append(whole[at : at + 4 * n].cast(kind))
            at += 4 * n
        self._first, self._targets, self._given, self._ends, self._pool = parts
        self._labels = at

    @property
    def states(self) -> int:
        return len(self._ends)

    def _ids(self, place: int) -> list[int]:
        return self._pool[place : place + self._pool[place - 1]].tolist() if place else []

    def get(self, word: bytes) -> list[int] | None:
        """The word's ids, or nothing if it is not in the lexicon."""
        first, find, labels = self._first, self._map.find, self._labels
        state, out = len(self._ends) - 1, []
        for i in range(len(word)):
            edge = find(word[i : i + 1], labels + first[state], labels + first[state + 1]) - labels
            if edge < 0:
                return None
            if self._given[edge]:
                out += self._ids(self._given[edge])
            state = self._targets[edge]
        end = self._ends[state]
        return None if end < 0 else out + self._ids(end)

    @functools.cached_property
    def _moves(self) -> tuple[np.ndarray, ...]:
        """All transitions as (state * 256 + byte), ascending; where each leads, what it gives; what states give at the end."""
        first, targets, given, ends = (np.frombuffer(x, k) for x, k in zip((self._first, self._targets, self._given, self._ends), ("u4", "u4", "u4", "i4"), strict=True))
        labels = np.frombuffer(self._map, np.uint8, len(targets), self._labels)
        return np.repeat(np.arange(len(ends), dtype=np.int64), np.diff(first)) * 256 + labels, targets, given, ends

    def get_all(self, words: Sequence[bytes]) -> list[list[int] | None]:
        """``get`` of many words: all walk a byte at a time, together."""
        keys, targets, given, ends = self._moves
        out: list[list[int] | None] = [None] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(sizes) - sizes
        alive, state = np.arange(len(words)), np.full(len(words), len(ends) - 1, np.int64)
        gifts: list[tuple[np.ndarray, np.ndarray]] = []
        depth = 0
        while len(alive):
            done = sizes[alive] == depth
            there, last = alive[done], ends[state[done]]
            gifts.append((there[last > 0], last[last > 0]))
            for w in there[last >= 0].tolist():
                out[w] = []
            alive, state = alive[~done], state[~done]
            if not len(alive) or not len(keys):
                break
            move = state * 256 + letters[starts[alive] + depth]
            at = np.minimum(np.searchsorted(keys, move), len(keys) - 1)
            on = keys[at] == move
            alive, at = alive[on], at[on]
            some = given[at] > 0
            gifts.append((alive[some], given[at[some]]))
            state = targets[at].astype(np.int64)
            depth += 1
        for who, what in gifts:
            for w, place in zip(who.tolist(), what.tolist(), strict=True):
                if out[w] is not None:
                    out[w] += self._ids(place)
        return out
