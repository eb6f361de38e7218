"""Rows remembered for short byte strings, looked up many at a time."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

KEY = 16  # bytes of a string that is remembered
SLOTS = 21  # bits of a hash that name a slot
# The bits of a key's two words that a string of 0 to KEY bytes fills.
FIRST = np.array([(1 << 8 * min(n, 8)) - 1 for n in range(KEY + 1)], dtype=np.uint64)
SECOND = np.array([(1 << 8 * max(n - 8, 0)) - 1 for n in range(KEY + 1)], dtype=np.uint64)


class ByteMemo:
    """Row numbers of distinct byte strings of up to KEY bytes, found by their exact
    bytes.  The owner keeps a value for each row; about ``room`` rows are held.  A
    slot names the row met last among those of equal leading bits of the hash, so
    most pieces are found without a search."""

    def __init__(self, room: int):
        self.room = room
        self.clear()

    def clear(self) -> None:
        self.hashes, self.order = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)
        self.keys, self.size = np.zeros((2, 0), dtype=np.uint64), np.zeros(0, dtype=np.uint8)
        self.met, self.slots = np.zeros(0, dtype=np.int32), np.full(1 << SLOTS, -1, dtype=np.int32)

    def __len__(self) -> int:
        return len(self.size)

    def shrink(self) -> np.ndarray:
        """Forget what was not met again since it was learnt, or all if that is not
        half of it.  The rows that stay, in their new order."""
        stay = np.flatnonzero(self.met > 0)
        if len(stay) > self.room // 2:
            self.clear()
            return stay[:0]
        new = np.full(len(self), -1, dtype=np.int32)
        new[stay] = np.arange(len(stay), dtype=np.int32)
        self.slots = np.where(self.slots >= 0, new[self.slots], np.int32(-1))
        known = new[self.order] >= 0
        self.hashes, self.order = self.hashes[known], new[self.order[known]]
        self.keys, self.size, self.met = self.keys[:, stay], self.size[stay], np.zeros(len(stay), dtype=np.int32)
        return stay

    def rows(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray,
             learn: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The row of each piece data[start:stop]; -1 where none is held.  ``learn``
        gets one place of each new piece and says which of them it has a value for;
        their rows follow in that order."""
        size = stop - start
        out = np.full(len(start), -1, dtype=np.int64)
        short = np.flatnonzero((size > 0) & (size <= KEY))
        if not len(short):
            return out
        size, low, high = size[short], int(start[short].min()), int(stop[short].max())
        near = np.zeros(high - low + KEY, dtype=np.uint8)
        near[:high - low] = data[low:high]
        words = np.ndarray(len(near) - 7, "<u8", near, strides=(1,))  # the 8 bytes from each byte on
        at = start[short] - low
        keys = np.stack([words[at] & FIRST[size], words[at + 8] & SECOND[size]])
        mixed = (keys[0] * np.uint64(0x9E3779B97F4A7C15)) ^ (keys[1] * np.uint64(0xC2B2AE3D27D4EB4F))
        mixed = (mixed ^ (mixed >> np.uint64(29)) ^ size.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
        slot = (mixed >> np.uint64(64 - SLOTS)).astype(np.int64)
        if len(self):
            row = self.slots[slot]
            found = (row >= 0) & self.equal(row, keys, size)
            self.met[row[found]] += 1
            out[short[found]] = row[found]
            rest = np.flatnonzero(~found)
            short, size, keys, mixed, slot = short[rest], size[rest], keys[:, rest], mixed[rest], slot[rest]
            if not len(short):
                return out
        hashes, first, member = np.unique(mixed, return_index=True, return_inverse=True)
        own = first[member]
        same = (keys[0, own] == keys[0]) & (keys[1, own] == keys[1]) & (size[own] == size)
        met, row = self.held(hashes)
        self.met[row[met]] += 1
        new = np.flatnonzero(~met)
        if len(new):
            new = new[learn(short[first[new]])]
            self.add(hashes[new], keys[:, first[new]], size[first[new]])
            met, row = self.held(hashes)
        sure = np.zeros(len(hashes), dtype=bool)
        sure[met] = self.equal(row[met], keys[:, first[met]], size[first[met]])
        self.slots[slot[first[sure]]] = row[sure]
        out[short] = np.where(sure[member] & same, row[member], -1)
        return out

    def equal(self, row: np.ndarray, keys: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether each row holds these bytes."""
        return (self.keys[0][row] == keys[0]) & (self.keys[1][row] == keys[1]) & (self.size[row] == size)

    def held(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is held, and its row."""
        if not len(self.hashes):
            return np.zeros(len(hashes), dtype=bool), np.zeros(len(hashes), dtype=np.int32)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[at] == hashes, self.order[at]

    def add(self, hashes: np.ndarray, keys: np.ndarray, size: np.ndarray) -> None:
        rows = np.arange(len(self), len(self) + len(hashes), dtype=np.int32)
        at = np.searchsorted(self.hashes, hashes, "right")  # hashes ascend
        self.hashes, self.order = np.insert(self.hashes, at, hashes), np.insert(self.order, at, rows)
        self.keys, self.size = np.concatenate([self.keys, keys], axis=1), np.concatenate([self.size, size.astype(np.uint8)])
        self.met = np.concatenate([self.met, np.zeros(len(hashes), dtype=np.int32)])


class IdStore:
    """Ids of the rows of a memo: places and numbers in one array of all ids."""

    def __init__(self, head: np.ndarray):
        self.head = head  # ids that belong to no row
        self.keep(None)

    def keep(self, rows: np.ndarray | None) -> None:
        """Keep these rows only, none for None."""
        if rows is None or not len(rows):
            self.place, self.count, self.ids = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), self.head.copy()
            return
        count = self.count[rows]
        ends = np.cumsum(count)
        ids = self.ids[gathered(self.place[rows], count)]
        self.place, self.count, self.ids = len(self.head) + ends - count, count, np.concatenate([self.head, ids])

    def add(self, ids: np.ndarray, count: np.ndarray) -> None:
        self.place = np.concatenate([self.place, len(self.ids) + np.cumsum(count) - count])
        self.count = np.concatenate([self.count, count])
        self.ids = np.concatenate([self.ids, ids.astype(self.head.dtype)])


def gathered(place: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All indices of the stretches of ``count`` from ``place`` on, one after another."""
    ends = np.cumsum(count)
    return np.repeat(place - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)
