"""Weighted acyclic automata over word sequences of up to three words.

An automaton holds counted phrases as paths from its root: every arc has a word
and the count of the phrase that ends with it (0: only a way to longer ones).
States with the same arcs are one state. It is built from a sorted table of
phrases, state by state as the sorted prefix moves on, each finished state being
looked up in a register; so it is minimal when the table ends.

A *table* is ``(words, codes, counts)``: the sorted distinct words (bytes), a
matrix of three columns of word numbers from 1 (0: no further word), sorted, and
one count per row.
"""

from __future__ import annotations

import struct
from bisect import bisect_left, bisect_right

from tidewater._shipping import by_value

by_value(__name__)

DEPTH = 3
WIDE = 1 << 21                 # so many word numbers fit three times into 63 bits


def packed(codes):
    """The rows as one sortable number each, if the words are few enough."""
    import numpy as np

    return (codes[:, 0] * WIDE + codes[:, 1]) * WIDE + codes[:, 2] if not len(codes) or codes.max() < WIDE else \
        np.unique(codes, axis=0, return_inverse=True)[1].reshape(-1)


def summed(codes, counts):
    """Sorted distinct rows and the sums of their counts."""
    import numpy as np

    key = packed(codes)
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return codes[order[head]], np.add.reduceat(counts[order], head) if len(head) else counts[:0]


def united(tables: list) -> tuple:
    """The union of tables; counts of equal phrases are added."""
    import numpy as np

    words = sorted(set().union(*(t[0] for t in tables)))
    number = {w: i for i, w in enumerate(words, 1)}
    moved = []
    for own, codes, _ in tables:
        to = np.fromiter([0, *map(number.__getitem__, own)], np.int64, len(own) + 1)
        moved.append(to[codes])
    codes, counts = summed(np.concatenate(moved), np.concatenate([t[2] for t in tables]))
    return words, codes, counts


def narrowed(table: tuple, rows) -> tuple:
    """The chosen rows, with only the words that they use."""
    import numpy as np

    words, codes, counts = table
    codes, counts = codes[rows], counts[rows]
    used = np.zeros(len(words) + 1, bool)
    used[codes.reshape(-1)] = True
    used[0] = False
    to = np.cumsum(used)
    return [words[i - 1] for i in np.flatnonzero(used).tolist()], np.where(codes > 0, to[codes], 0), counts


def cut_points(table: tuple, borders: list[tuple]) -> list[int]:
    """For every border (a phrase), the number of the table's phrases before it."""
    words, codes, _ = table
    import numpy as np

    rows, out = codes.tolist() if len(borders) and not codes.max(initial=0) < WIDE else None, []
    key = packed(codes) if rows is None else None
    for border in borders:
        at = []
        for w in border[:DEPTH]:
            i = bisect_left(words, w)
            at.append(i + 1)
            if i == len(words) or words[i] != w:
                break                                    # the first phrase beyond starts with the next word
        at += [0] * (DEPTH - len(at))
        out.append(int(np.searchsorted(key, (at[0] * WIDE + at[1]) * WIDE + at[2])) if rows is None else bisect_left(rows, at))
    return out


def range_of(phrase: tuple, borders: list[tuple]) -> int:
    """Number of the prefix range of a phrase among sorted borders."""
    return bisect_right(borders, phrase)


class Automaton:
    """``arcs``: word, count and target state (0: none) of every arc; arcs of one
    state stand together, by word; ``first[s]`` is where state s begins."""

    def __init__(self, words: list, label, count, target, first, root: int):
        self.words, self.label, self.count, self.target, self.first, self.root = words, label, count, target, first, root

    @classmethod
    def build(cls, table: tuple) -> Automaton:
        import numpy as np

        words, codes, counts = table
        register: dict[bytes, int] = {}
        label, count, target, first = [], [], [], [0, 0]      # state 0 has no arcs
        below = None                                          # target of each prefix of the level below
        for depth in range(DEPTH, 0, -1):
            rows = codes[:, depth - 1] > 0
            nodes = codes[rows][:, :depth]
            new = np.append(True, (nodes[1:] != nodes[:-1]).any(axis=1)) if len(nodes) else np.zeros(0, bool)
            head = np.flatnonzero(new)
            own = codes[rows][head]
            exact = (own[:, depth:] == 0).all(axis=1)         # the phrase itself stands before its extensions
            weight = np.where(exact, counts[rows][head], 0)
            to = np.zeros(len(head), np.int64)
            if below is not None and len(below[0]):
                at = np.searchsorted(packed(own * (np.arange(DEPTH) < depth)), below[0]) if codes.max() < WIDE else None
                if at is None:
                    place = {tuple(p): i for i, p in enumerate(own[:, :depth].tolist())}
                    at = np.array([place[tuple(p)] for p in below[2].tolist()], np.int64)
                to[at] = below[1]
            prefix = own[:, :depth - 1]
            starts = np.flatnonzero(np.append(True, (prefix[1:] != prefix[:-1]).any(axis=1))) if len(own) else np.zeros(0, np.int64)
            stops = np.append(starts[1:], len(own)) if len(own) else starts
            arcs = np.ascontiguousarray(np.stack([own[:, depth - 1], weight, to], axis=1)).astype(np.int64) if len(own) else np.zeros((0, 3), np.int64)
            raw, states = arcs.tobytes(), []
            for lo, hi in zip(starts.tolist(), stops.tolist()):
                signature = raw[24 * lo:24 * hi]
                s = register.get(signature)
                if s is None:
                    s = register[signature] = len(first) - 1
                    label.append(arcs[lo:hi, 0])
                    count.append(arcs[lo:hi, 1])
                    target.append(arcs[lo:hi, 2])
                    first.append(first[-1] + hi - lo)
                states.append(s)
            heads = own[starts] * (np.arange(DEPTH) < depth - 1)
            below = (packed(heads) if len(codes) and codes.max() < WIDE else heads[:, 0], np.array(states, np.int64), heads[:, :max(depth - 1, 0)])
        joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (label, count, target)]
        return cls(words, *joined, np.array(first, np.int64), int(below[1][0]) if len(below[1]) else 0)

    def table(self) -> tuple:
        """All counted phrases."""
        import numpy as np

        codes, state = np.zeros((1, DEPTH), np.int64), np.array([self.root])
        found, counts = [], []
        for depth in range(DEPTH):
            size = self.first[state + 1] - self.first[state]
            codes, begin = np.repeat(codes, size, axis=0), np.repeat(self.first[state], size)
            arc = begin + np.arange(len(begin)) - np.repeat(np.cumsum(size) - size, size)
            codes[:, depth] = self.label[arc]
            found.append(codes[self.count[arc] > 0])
            counts.append(self.count[arc][self.count[arc] > 0])
            state = self.target[arc]
            codes, state = codes[state > 0], state[state > 0]
        return (self.words, *summed(np.concatenate(found), np.concatenate(counts)))

    def compose(self, phrases: list[tuple]) -> list[int]:
        """Counts of sorted phrases (0: not in here). Both sides are walked
        together: what two neighbours share is walked once."""
        import numpy as np

        number = {w: i for i, w in enumerate(self.words, 1)}
        out, path, states = [], (), [self.root]
        weight = 0
        for phrase in phrases:
            shared = 0
            while shared < min(len(path), len(phrase) - 1) and path[shared] == phrase[shared]:
                shared += 1
            states = states[:shared + 1]
            for w in phrase[shared:]:
                s, code = states[-1], number.get(w, 0)
                lo, hi = int(self.first[s]), int(self.first[s + 1])
                at = lo + int(np.searchsorted(self.label[lo:hi], code))
                hit = s > 0 and code > 0 and at < hi and self.label[at] == code
                weight = int(self.count[at]) if hit else 0
                states.append(int(self.target[at]) if hit else 0)
            path = phrase
            out.append(weight)
        return out

    def to_bytes(self) -> bytes:
        import numpy as np

        text = b"\n".join(self.words)
        parts = [text]
        for x in (self.label, self.count, self.target, np.diff(self.first)):
            kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if not len(x) or int(x.max()) <= np.iinfo(k).max)
            parts.append(kind[-1].encode() + x.astype(kind).tobytes())
        return struct.pack("<qq5q", self.root, len(self.words), *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, raw: bytes) -> Automaton:
        import numpy as np

        root, n, *sizes = struct.unpack_from("<qq5q", raw)
        at, parts = struct.calcsize("<qq5q"), []
        for size in sizes:
            parts.append(raw[at:at + size])
            at += size
        words = parts[0].split(b"\n") if n else []
        label, count, target, wide = (np.frombuffer(p, f"<u{p[:1].decode()}", offset=1).astype(np.int64) for p in parts[1:])
        return cls(words, label, count, target, np.concatenate([[0], np.cumsum(wide)]), root)
