"""A minimal acyclic transducer from words to ids, in one flat file that workers map into memory.

States with the same right language are one state, so common endings are stored once.  The output of an edge is the number of
words that leave its state by smaller labels (one more if the state ends a word), so the outputs along a word add up to the word's
place among all words in byte order, and that place selects its ids.  Putting the place on the edges, not the ids, keeps the states shared.

``build`` takes words in byte order; ``Lexicon`` reads the file and looks up many words at once, one byte a step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_MAGIC = 0x4C455831
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Open-addressed table from non-negative 64-bit keys to slots, filled and read by whole arrays."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots
        self.shift = np.uint64(64 - (len(slots).bit_length() - 1))
        self.mask = len(slots) - 1

    @classmethod
    def of(cls, keys: np.ndarray) -> PairTable:
        """A table of the different ``keys``, at most half full."""
        size = 1 << max(4, int(2 * len(keys) - 1).bit_length())
        table = cls(np.full(size, -1, np.int64))
        left, at = keys.astype(np.int64), table._home(keys)
        while len(left):
            free = np.flatnonzero(table.slots[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            table.slots[at[put]] = left[put]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, at = left[rest], (at[rest] + 1) & table.mask
        return table

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's slot, or -1."""
        at = self._home(keys)
        seen = self.slots[at]
        out = np.where(seen == keys, at, -1)
        open_ = np.flatnonzero((seen != keys) & (seen >= 0))
        at = at[open_]
        while len(open_):
            at = (at + 1) & self.mask
            seen, want = self.slots[at], keys[open_]
            hit = seen == want
            out[open_[hit]] = at[hit]
            more = ~hit & (seen >= 0)
            open_, at = open_[more], at[more]
        return out


def _states(words: list[bytes]) -> tuple[list[tuple], list[bool], int]:
    """Edges ((label, state), ...) and finality of each state of the minimal automaton, and its root; a state follows its children."""
    register: dict[tuple, int] = {}
    edges: list[tuple] = []
    final: list[bool] = []
    path: list[list] = [[False, []]]  # along the last word: ends here, finished edges

    def close(depth: int, word: bytes) -> None:
        while len(path) - 1 > depth:
            ends, done = path.pop()
            key = (ends, *done)
            state = register.get(key)
            if state is None:
                state = register[key] = len(edges)
                edges.append(tuple(done))
                final.append(ends)
            path[-1][1].append((word[len(path) - 1], state))

    last = b""
    for word in words:
        common, top = 0, min(len(word), len(last))
        while common < top and word[common] == last[common]:
            common += 1
        close(common, last)
        path.extend([False, []] for _ in range(len(word) - common))
        path[-1][0] = True
        last = word
    close(0, last)
    edges.append(tuple(path[0][1]))
    final.append(path[0][0])
    return edges, final, len(edges) - 1


def build(words: list[bytes], ids: np.ndarray, ends: np.ndarray) -> bytes:
    """The file of different ``words`` in byte order; the ids of word k end at ``ends[k]`` in ``ids``."""
    edges, final, root = _states(words)
    below = [0] * len(edges)
    keys, targets, outs = [], [], []
    for state, out in enumerate(edges):
        n = int(final[state])
        for label, target in out:
            keys.append(state << 8 | label)
            targets.append(target)
            outs.append(n)
            n += below[target]
        below[state] = n
    keys = np.array(keys, np.int64)
    table = PairTable.of(keys)
    value = np.zeros((len(table.slots), 2), np.int32)
    value[table.find(keys), 0] = targets
    value[table.find(keys), 1] = outs
    if len(edges) >= 1 << 23:
        raise ValueError("too many words for one lexicon")
    parts = [table.slots.astype(np.int32), value, np.concatenate([[0], ends]).astype(np.int32), ids.astype(np.int32), np.array(final, np.uint8)]
    head = np.array([_MAGIC, root, *(p.nbytes for p in parts)], np.int64)
    return head.tobytes() + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """A file of ``build``, mapped: workers of one machine share its pages."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        head = raw[:56].view(np.int64)
        if head[0] != _MAGIC:
            raise ValueError(f"{path} is no lexicon")
        self.root, cuts = int(head[1]), np.concatenate([[56], 56 + np.cumsum(head[2:7])]).tolist()
        slots, value, ends, ids, final = (raw[i:j] for i, j in zip(cuts, cuts[1:]))
        self.table = PairTable(slots.view(np.int32))
        self.value = value.view(np.int32).reshape(-1, 2)
        self.ends, self.ids, self.final = ends.view(np.int32), ids.view(np.int32), final

    def __len__(self) -> int:
        return len(self.ends) - 1

    def find(self, words: pa.LargeStringArray) -> np.ndarray:
        """Each word's place in byte order, or -1.  A step follows one byte of all words that still have an edge."""
        if not len(words):
            return np.zeros(0, np.int64)
        at = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        size, place = np.diff(at), np.full(len(words), -1, np.int64)
        live, state, total = np.arange(len(words)), np.full(len(words), self.root, np.int64), np.zeros(len(words), np.int64)
        step = 0
        while len(live):
            done = size[live] == step
            if done.any():
                ends = done & (self.final[state] > 0)
                place[live[ends]] = total[ends]
                live, state, total = live[~done], state[~done], total[~done]
            slot = self.table.find(state << 8 | data[at[live] + step])
            on = slot >= 0
            live, slot = live[on], slot[on]
            state, total = self.value[slot, 0].astype(np.int64), total[on] + self.value[slot, 1]
            step += 1
        return place
