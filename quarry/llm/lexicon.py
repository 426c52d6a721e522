"""Minimal acyclic transducer: byte strings to numbered outputs.

Words are inserted in sorted order and states with equal futures are shared as
soon as they are complete, so the automaton is minimal and shares suffixes as
well as prefixes.  Each arc carries the number of words that precede it among
its state's; the sum along an accepting path is the word's rank, which selects
its output.  The compiled form is one file of flat arrays that workers map into
memory and walk for many words at a time.
"""

from __future__ import annotations

import mmap
from collections.abc import Sequence

import numpy as np


def compile_words(entries: list[tuple[bytes, Sequence[int]]]) -> bytes:
    """The file of a transducer for distinct words and their id sequences."""
    entries = sorted((w, tuple(ids)) for w, ids in entries if w)
    finals: list[bool] = [False]
    arcs: list[list[tuple[int, int]]] = [[]]  # of a state: (byte, target)
    known: dict[tuple, int] = {}
    path: list[int] = [0]  # states of the word inserted last
    last = b""

    def settle(depth: int) -> None:
        """Share the finished states below ``depth`` of the last word."""
        while len(path) > depth + 1:
            state = path.pop()
            shape = (finals[state], tuple(arcs[state]))
            same = known.setdefault(shape, state)
            if same != state:
                parent = arcs[path[-1]]
                parent[-1] = (parent[-1][0], same)

    for word, _ in entries:
        common = 0
        for a, b in zip(word, last, strict=False):
            if a != b:
                break
            common += 1
        settle(common)
        for byte in word[common:]:
            arcs.append([])
            finals.append(False)
            arcs[path[-1]].append((byte, len(arcs) - 1))
            path.append(len(arcs) - 1)
        finals[path[-1]] = True
        last = word
    settle(0)

    # number the reachable states; count the words below each
    order, number, stack = [], {}, [0]
    while stack:
        state = stack.pop()
        if state not in number:
            number[state] = len(order)
            order.append(state)
            stack.extend(t for _, t in arcs[state])
    below: dict[int, int] = {}
    todo = [(0, False)]
    while todo:
        state, ready = todo.pop()
        if state in below:
            continue
        if ready:
            below[state] = finals[state] + sum(below[t] for _, t in arcs[state])
        else:
            todo.append((state, True))
            todo.extend((t, False) for _, t in arcs[state] if t not in below)
    keys, targets, skips = [], [], []
    for state in order:
        before = int(finals[state])
        for byte, target in arcs[state]:
            keys.append(number[state] << 8 | byte)
            targets.append(number[target])
            skips.append(before)
            before += below[target]
    lengths = [len(ids) for _, ids in entries]
    parts = [
        np.array(keys, "<i8"), np.array(targets, "<i8"), np.array(skips, "<i8"),
        np.array([finals[s] for s in order], "<i8"),
        np.concatenate([[0], np.cumsum(lengths, dtype="<i8")]).astype("<i8"),
        np.array([i for _, ids in entries for i in ids], "<i8"),
    ]
    return np.array([len(p) for p in parts], "<i8").tobytes() + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A compiled transducer, mapped from its file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.held = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        flat = np.frombuffer(self.held, "<i8")
        ends = 6 + np.concatenate([[0], np.cumsum(flat[:6])])
        self.keys, self.targets, self.skips, self.finals, self.starts, self.ids = (flat[a:b] for a, b in zip(ends, ends[1:], strict=False))

    def rank(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word, -1 where the lexicon has it not; all words
        take one step through the automaton at a time."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ranks = np.zeros(len(words), np.int64)
        ranks[lengths == 0] = -1
        if not len(self.keys):
            return np.full(len(words), -1, np.int64)
        text = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        live, state, step = np.flatnonzero(lengths > 0), np.zeros(len(words), np.int64), 0
        while len(live):
            key = state[live] << 8 | text[starts[live] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            ranks[live[~hit]] = -1
            live, at = live[hit], at[hit]
            state[live] = self.targets[at]
            ranks[live] += self.skips[at]
            step += 1
            ended = lengths[live] == step
            done = live[ended]
            ranks[done[self.finals[state[done]] == 0]] = -1
            live = live[~ended]
        return ranks

    def outputs(self, words: list[bytes]) -> list[np.ndarray | None]:
        """The ids of each word, None where the lexicon has it not."""
        starts, ids = self.starts, self.ids
        return [ids[starts[r] : starts[r + 1]] if r >= 0 else None for r in self.rank(words).tolist()]
