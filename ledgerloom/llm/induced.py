"""Sorting the suffixes of a long string by induction, with the common prefixes of neighbours.

Suffixes are told apart by their first ``limit`` characters only. The suffixes at left-most S positions are sorted first;
from them all L suffixes are induced in rising order, and from these all S suffixes in falling order. Whatever waits for
its turn is a tuple of position and common prefix in a queue per first character. Tuples enter a queue in the order in
which they leave it, so that the 512 queues are one priority queue, and each goes to a file when it is long. The
string may be a memory map; it is read at the positions of one batch at a time.
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterator

import numpy as np

END, GAP, FIRST = 0, 1, 2  # characters: the end, what parts two pieces, and the byte 0
CHARACTERS = FIRST + 256
PACKED = 7  # characters of 9 bits in a word
BATCH = 1 << 16
HELD = 1 << 16  # most tuples of a queue that stay in memory

Tuples = tuple[np.ndarray, np.ndarray]


class Queue:
    """First in, first out, of (position, common prefix); beyond HELD tuples it goes on in a file of ``folder``."""

    def __init__(self, folder: str, name: str) -> None:
        self.path = os.path.join(folder, name)
        self.front: deque[Tuples] = deque()
        self.back: list[Tuples] = []
        self.waiting, self.stored, self.read = 0, 0, 0

    def push(self, at: np.ndarray, common: np.ndarray) -> None:
        if len(at):
            self.back.append((at, common))
            self.waiting += len(at)
            if self.waiting > HELD:
                self.store()

    def store(self) -> None:
        with open(self.path, "ab") as out:
            for at, common in self.back:
                np.stack([at, common], axis=1).astype(np.int64).tofile(out)
        self.stored += self.waiting
        self.back, self.waiting = [], 0

    def pop(self) -> Tuples | None:
        """The next tuples, BATCH or so at most; null if there is none just now."""
        if self.read < self.stored:
            n = min(BATCH, self.stored - self.read)
            both = np.fromfile(self.path, np.int64, 2 * n, offset=16 * self.read).reshape(-1, 2)
            self.read += n
            return both[:, 0], both[:, 1]
        if not self.back:
            return None
        at, common = (np.concatenate(x) for x in zip(*self.back))
        self.back, self.waiting = [], 0
        if len(at) > BATCH:
            self.push(at[BATCH:], common[BATCH:])
        return at[:BATCH], common[:BATCH]

    def __len__(self) -> int:
        return self.stored - self.read + self.waiting

    def falling(self) -> Iterator[Tuples]:
        """All tuples that were ever pushed, the last first; only for a queue from which nothing was taken."""
        for at, common in reversed(self.back):
            yield at[::-1], common[::-1]
        for end in range(self.stored, 0, -BATCH):
            start = max(end - BATCH, 0)
            both = np.fromfile(self.path, np.int64, 2 * (end - start), offset=16 * start).reshape(-1, 2)[::-1]
            yield both[:, 0], both[:, 1]


def words(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The PACKED characters from each position on, as numbers in their order."""
    out = np.zeros(len(at), np.uint64)
    for i in range(PACKED):
        out = out << np.uint64(9) | text[at + i].astype(np.uint64)
    return out


def seeds(text: np.ndarray, at: np.ndarray, limit: int) -> Tuples:
    """Positions in the order of their first ``limit`` characters, and what each has in common with the one before.

    Words are compared round by round; each round sorts only what is still tied, within its group of ties.
    """
    order, group, common = np.arange(len(at)), np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    slots, depth = np.arange(len(at)), 0
    while len(slots) and depth < limit:
        word, own = words(text, at[order[slots]] + depth), group[slots]
        turn = np.lexsort((word, own))
        order[slots], word = order[slots][turn], word[turn]
        inside = own[1:] == own[:-1]
        tied = inside & (word[1:] == word[:-1])
        differ = word[1:] ^ word[:-1]
        equal = sum((differ >> np.uint64(9 * (PACKED - 1 - i)) == 0).astype(np.int64) for i in range(PACKED))
        split = inside & ~tied
        common[slots[1:][split]] = depth + equal[split]
        group[slots] = np.maximum.accumulate(np.where(np.append(True, ~tied), slots, 0))
        slots = slots[np.append(tied, False) | np.append(False, tied)]
        depth += PACKED
    if len(slots):
        same = np.append(False, group[slots[1:]] == group[slots[:-1]])
        common[slots[same]] = limit
    return at[order], np.minimum(common, limit)


def range_minimum(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least value from ``first`` to ``last``, both included, for each pair."""
    tables, width = [values], 1
    while 2 * width <= len(values):
        below = tables[-1]
        tables.append(np.minimum(below[:-width], below[width:]))
        width *= 2
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    out = np.empty(len(first), values.dtype)
    for i in np.unique(level):
        own = level == i
        out[own] = np.minimum(tables[i][first[own]], tables[i][last[own] + 1 - (1 << i)])
    return out


class Induction:
    """One direction: takes suffixes in order and queues those that begin one character earlier and have the type."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, limit: int, folder: str, name: str) -> None:
        self.text, self.wanted, self.limit = text, wanted, limit
        self.queues = [Queue(folder, f"{name}-{c}") for c in range(CHARACTERS)]
        self.least = np.full(CHARACTERS, -1, np.int64)  # common prefix of all sources since a character's last tuple

    def feed(self, at: np.ndarray, common: np.ndarray) -> None:
        """``common`` is what each source shares with the one before it; an induced suffix shares one more than the least."""
        before = at - 1
        some = np.flatnonzero((before >= 0) & self.wanted[before])
        everything = int(common.min())
        if not len(some):
            self.least = np.minimum(self.least, everything)
            return
        before = before[some]
        character = self.text[before]
        turn = np.argsort(character, kind="stable")
        place, sorted_ = some[turn], character[turn]
        starts = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
        ends = np.append(starts[1:], len(place))
        first = np.empty(len(place), np.int64)
        first[1:] = place[:-1] + 1
        first[starts] = 0
        shared = range_minimum(common, first, place)
        present = sorted_[starts]
        shared[starts] = np.minimum(shared[starts], self.least[present])
        tail = np.minimum.accumulate(common[::-1])[::-1]
        self.least = np.minimum(self.least, everything)
        last = place[ends - 1]
        self.least[present] = np.where(last + 1 < len(common), tail[np.minimum(last + 1, len(common) - 1)], self.limit)
        shared, before = np.minimum(shared + 1, self.limit), before[turn]
        for c, start, end in zip(present.tolist(), starts.tolist(), ends.tolist()):
            self.queues[c].push(before[start:end], shared[start:end])


def common_prefix(text: np.ndarray, a: int, b: int, limit: int) -> int:
    x, y = text[a : a + limit], text[b : b + limit]
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    return int(differ[0]) if len(differ) else n


def types(text: np.ndarray, length: int) -> np.ndarray:
    """True where a suffix is less than the next one (S), over ``length`` characters of which the last is END."""
    out = np.empty(length, bool)
    following = True  # of END
    out[length - 1] = True
    for end in range(length - 1, 0, -(1 << 20)):
        start = max(end - (1 << 20), 0)
        here, there = text[start:end], text[start + 1 : end + 1]
        known = np.where(here != there, np.arange(end - start), end - start)
        known = np.minimum.accumulate(known[::-1])[::-1]
        out[start:end] = np.append(here < there, following)[known]
        following = bool(out[start])
    return out


def suffixes(text: np.ndarray, length: int, limit: int, folder: str) -> Iterator[Tuples]:
    """Positions of all suffixes but that of END in falling order, with what each has in common with the one before it.

    ``text`` has ``length`` characters, the last one END, the others not, and then ``limit + PACKED`` times END.
    """
    rising_type = types(text, length)
    first = np.flatnonzero(rising_type[1:] & ~rising_type[:-1]) + 1
    character = text[first]
    turn = np.argsort(character, kind="stable")
    bounds = np.searchsorted(character[turn], np.arange(CHARACTERS + 1))
    larger = Induction(text, ~rising_type, limit, folder, "l")
    kept = [Queue(folder, f"kept-{c}") for c in range(CHARACTERS)]
    for c in range(CHARACTERS):
        last = -1
        while (batch := larger.queues[c].pop()) is not None:
            kept[c].push(*batch)
            larger.feed(*batch)
            last = int(batch[0][-1])
        own = first[turn[bounds[c] : bounds[c + 1]]]
        if len(own):
            at, common = seeds(text, own, limit)
            common[0] = common_prefix(text, last, int(at[0]), limit) if last >= 0 else 0
            for i in range(0, len(at), BATCH):
                larger.feed(at[i : i + BATCH], common[i : i + BATCH])
    smaller = Induction(text, rising_type, limit, folder, "s")
    for c in range(CHARACTERS - 1, END, -1):
        last = -1
        while (batch := smaller.queues[c].pop()) is not None:
            yield batch
            smaller.feed(*batch)
            last = int(batch[0][-1])
        shared = -1  # what the next one to come shares with the one before it in falling order
        for at, common in kept[c].falling():
            if shared < 0:
                shared = common_prefix(text, last, int(at[0]), limit) if last >= 0 else 0
            falling = np.append(shared, common[:-1])
            shared = int(common[-1])
            yield at, falling
            smaller.feed(at, falling)
