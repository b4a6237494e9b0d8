"""Minimal acyclic transducer over a word list: shared prefixes and suffixes, word ids as outputs.

Words are added in order and finished states are merged with equal ones, so the automaton is
minimal at every step. An edge carries how many words come before those it leads to; the sum
along a path numbers the word, and the number points at its token ids. The file is a header
and plain arrays, read through a memory map; many words are looked up at once.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

import numpy as np

_MAGIC = b"LEXICON1"
_ARRAYS = ("edges", "targets", "skips", "final", "begin", "count", "ids")


def compile_lexicon(words: Mapping[bytes, Sequence[int]]) -> bytes:
    """The file for words and their token ids."""
    ordered = sorted(words)
    states, root = _minimal(ordered)
    number = {id(state): at for at, state in enumerate(states)}
    below: dict[int, int] = {}
    for state in states:  # children come first
        below[id(state)] = state.final + sum(below[id(child)] for child in state.edges.values())
    rows = []
    for state in states:
        skip = int(state.final)
        for byte, child in sorted(state.edges.items()):
            rows.append(((number[id(state)] << 8) | byte, number[id(child)], skip))
            skip += below[id(child)]
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 3)
    count = np.array([len(words[word]) for word in ordered], np.int64)
    arrays = {
        "edges": table[:, 0].copy(),
        "targets": table[:, 1].astype(np.int32),
        "skips": table[:, 2].astype(np.int32),
        "final": np.array([state.final for state in states], np.uint8),
        "begin": np.cumsum(count) - count,
        "count": count,
        "ids": np.array([i for word in ordered for i in words[word]], np.int32),
    }
    places, body = {}, b""
    for name in _ARRAYS:
        body += b"\0" * (-len(body) % 8)
        places[name] = (len(body), len(arrays[name]), arrays[name].dtype.str)
        body += arrays[name].tobytes()
    head = json.dumps({"root": number[id(root)], "places": places}).encode()
    head += b" " * (-(len(head) + 16) % 8)
    return _MAGIC + len(head).to_bytes(8, "little") + head + body


class _State:
    __slots__ = ("edges", "final")

    def __init__(self) -> None:
        self.edges: dict[int, _State] = {}
        self.final = False

    def shape(self) -> tuple:
        return self.final, tuple((byte, id(child)) for byte, child in self.edges.items())


def _minimal(ordered: Sequence[bytes]) -> tuple[list[_State], _State]:
    """All states, children before parents, and the root; words ascend and differ."""
    root = _State()
    register: dict[tuple, _State] = {}
    path = [root]
    before = b""

    def settle(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            parent, byte = path[-1], before[len(path) - 1]
            parent.edges[byte] = register.setdefault(state.shape(), state)

    for word in ordered:
        common = 0
        while common < min(len(before), len(word)) and before[common] == word[common]:
            common += 1
        settle(common)
        for byte in word[common:]:
            path.append(_State())
            path[-2].edges[byte] = path[-1]
        path[-1].final = True
        before = word
    settle(0)
    return [*register.values(), root], root


class Lexicon:
    """The compiled file, from a memory map or from bytes."""

    def __init__(self, raw: np.ndarray | bytes) -> None:
        raw = np.frombuffer(raw, np.uint8) if isinstance(raw, bytes) else raw
        if raw[:8].tobytes() != _MAGIC:
            raise ValueError("not a lexicon file")
        body = 16 + int.from_bytes(raw[8:16].tobytes(), "little")
        head = json.loads(raw[16:body].tobytes())
        self.root = head["root"]
        for name, (at, size, kind) in head["places"].items():
            setattr(self, name, raw[body + at : body + at + size * np.dtype(kind).itemsize].view(kind))

    @classmethod
    def open(cls, path: str) -> Lexicon:
        return cls(np.memmap(path, np.uint8, "r"))

    def __len__(self) -> int:
        return len(self.count)

    def find(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Number of each word in the lexicon, -1 where it is not; all words take a step at once."""
        out = np.full(len(starts), -1, np.int64)
        if not len(self.edges):
            return out
        live, at = np.flatnonzero(ends > starts), 0
        state = np.full(len(live), self.root, np.int64)
        number = np.zeros(len(live), np.int64)
        while len(live):
            edge = (state << 8) | buffer[starts[live] + at]
            place = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
            on = self.edges[place] == edge
            live, place = live[on], place[on]
            number = number[on] + self.skips[place]
            state = self.targets[place].astype(np.int64)
            at += 1
            over = ends[live] - starts[live] == at
            done = over & (self.final[state] == 1)
            out[live[done]] = number[done]
            live, state, number = live[~over], state[~over], number[~over]
        return out
