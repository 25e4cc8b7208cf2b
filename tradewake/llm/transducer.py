"""Minimal acyclic transducers: a sorted vocabulary as an automaton that gives ordinals.

States with the same continuations are one state. A transition carries how many terms come before
those that go through it, so the sum along a term's path is its place in the sorted vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


class Transducer:
    """Arrays: ``keys`` are ``state << 8 | byte`` in ascending order, with ``targets`` and
    ``skips`` beside them, and ``final`` says where terms may end. State 0 is the start. ``size``
    is the number of terms."""

    def __init__(self, size: int, keys: np.ndarray, targets: np.ndarray, skips: np.ndarray,
                 final: np.ndarray):
        self.size, self.keys, self.targets, self.skips = size, keys, targets, skips
        self.final = final

    @classmethod
    def build(cls, terms: Iterable[bytes]) -> Transducer:
        """From terms in ascending order of bytes, without repeats.

        Only the path of the last term is open; what it leaves behind is looked up among the
        closed states and merged with an equal one.
        """
        closed: dict[tuple, int] = {}
        nodes: list[tuple] = []  # of a closed state: final, then byte and target of each transition
        sizes: list[int] = []  # terms from a closed state on
        path: list[list] = [[False, []]]  # open states: final, transitions
        last = b""

        def close(node: list) -> int:
            key = (node[0], tuple(node[1]))
            found = closed.get(key)
            if found is None:
                found = closed[key] = len(nodes)
                nodes.append(key)
                sizes.append(node[0] + sum(sizes[t] for _, t in node[1]))
            return found

        for term in terms:
            same, most = 0, min(len(term), len(last))
            while same < most and term[same] == last[same]:
                same += 1
            while len(path) > same + 1:
                node = path.pop()
                path[-1][1].append((last[len(path) - 1], close(node)))
            path += [[False, []] for _ in range(len(term) - same)]
            path[-1][0] = True
            last = term
        while len(path) > 1:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], close(node)))
        start = close(path[0])
        # The start closes last; counted from the end it is state 0.
        keys, targets, skips = [], [], []
        for state, (ends, steps) in enumerate(reversed(nodes)):
            before = int(ends)
            for byte, to in steps:
                keys.append(state << 8 | byte)
                targets.append(start - to)
                skips.append(before)
                before += sizes[to]
        return cls(sizes[start], np.array(keys, dtype=np.int64), np.array(targets, dtype=np.int64),
                   np.array(skips, dtype=np.int64), np.array([n[0] for n in reversed(nodes)]))

    def to_bytes(self) -> bytes:
        head = np.array([self.size, len(self.keys)], dtype="<i8")
        return b"".join([head.tobytes(), *(x.astype("<i8").tobytes() for x in (
            self.keys, self.targets, self.skips)), self.final.astype(np.uint8).tobytes()])

    @classmethod
    def from_bytes(cls, raw: bytes) -> Transducer:
        size, n = np.frombuffer(raw, dtype="<i8", count=2).tolist()
        keys, targets, skips = np.frombuffer(raw, dtype="<i8", count=3 * n, offset=16).reshape(3, n)
        return cls(size, keys, targets, skips,
                   np.frombuffer(raw, dtype=np.uint8, offset=16 + 24 * n).astype(bool))

    def ordinals(self, text: bytes) -> np.ndarray:
        """The ordinal of every term of a text whose terms are parted by one space each; -1 for
        those that aren't in the vocabulary. All terms take a step at once."""
        data = np.frombuffer(text, dtype=np.uint8)
        ends = np.append(np.flatnonzero(data == 0x20), len(data))
        at = np.concatenate(([0], ends[:-1] + 1))
        out = np.full(len(at), -1, dtype=np.int64)
        if not len(self.keys):
            return out
        who = np.flatnonzero(at < ends)
        at, end = at[who], ends[who]
        state, place = np.zeros((2, len(who)), dtype=np.int64)
        while len(who):
            key = state << 8 | data[at]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = self.keys[found] == key
            found, who, at, end = found[on], who[on], at[on] + 1, end[on]
            state, place = self.targets[found], place[on] + self.skips[found]
            over = at == end
            here = over & self.final[state]
            out[who[here]] = place[here]
            who, at, end, state, place = (x[~over] for x in (who, at, end, state, place))
        return out
