"""Suffix sorting by induction, with queues that spill to disk.

Suffixes that start a descent (left-most S) are ordered first: their
substrings are sorted by one induction, named, and the string of names is
ordered by doubling; a second induction then orders all suffixes.  Induction
reads suffixes in order and hands each one's left neighbour to the queue of
its first byte.  A queue keeps order by byte, then arrival, which is what a
priority queue of (byte, rank) tuples gives; the whole batch of a byte is
handled by one numpy step.  Queues that exceed the memory allowed write their
batches to an unnamed file of the task, which is gone when the task ends.

Only the order by the first ``depth`` bytes is wanted here: names are doubled
until they cover it.
"""

from __future__ import annotations

import tempfile

import numpy as np


class ByteQueues:
    """First-in first-out queues of positions, one per byte value; batches beyond ``memory`` bytes go to disk."""

    def __init__(self, memory: int):
        self.batches: list[list] = [[] for _ in range(257)]
        self.memory, self.held, self.file = memory, 0, None

    def put(self, byte: int, positions: np.ndarray) -> None:
        if not len(positions):
            return
        self.held += positions.nbytes
        if self.held > self.memory:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.seek(0, 2)
            place = self.file.tell()
            positions.tofile(self.file)
            self.held -= positions.nbytes
            self.batches[byte].append((place, len(positions)))
        else:
            self.batches[byte].append(positions)

    def take(self, byte: int):
        """The batches of a byte, in order; those put while reading included."""
        queue = self.batches[byte]
        at = 0
        while at < len(queue):
            x, queue[at] = queue[at], None
            at += 1
            if isinstance(x, tuple):
                self.file.seek(x[0])
                x = np.fromfile(self.file, np.int64, x[1])
            else:
                self.held -= x.nbytes
            yield x
        queue.clear()


def rising(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it (the last one, before the sentinel, is not)."""
    n = len(text)
    out = np.zeros(n, bool)
    if n > 1:
        differs = np.flatnonzero(text[1:] != text[:-1])
        place = np.searchsorted(differs, np.arange(n - 1))
        known = place < len(differs)
        j = differs[place[known]]
        out[:n - 1][known] = text[j] < text[j + 1]
    return out


def induce(text: np.ndarray, up: np.ndarray, seeds: np.ndarray, memory: int) -> np.ndarray:
    """All suffixes ordered from the left-most S suffixes ``seeds`` in their order.

    ``text`` has bytes 1 to 256; the sentinel after it is smaller than all.
    """
    def deal(queues: ByteQueues, positions: np.ndarray, falling: bool) -> None:
        before = positions[positions > 0] - 1
        before = before[up[before] != falling]
        if len(before):
            byte = text[before]
            order = np.argsort(byte, kind="stable")
            byte, before = byte[order], before[order]
            cut = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1]]))
            for i, j in zip(cut, np.append(cut[1:], len(byte))):
                queues.put(int(byte[i]), before[i:j])

    n = len(text)
    first = ByteQueues(memory)
    seed_byte = text[seeds]
    order = np.argsort(seed_byte, kind="stable")
    seeds, seed_byte = seeds[order], seed_byte[order]
    ends = np.searchsorted(seed_byte, np.arange(258))
    out = np.empty(n, np.int64)
    starts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=257))])
    larger = np.zeros(258, np.int64)            # how many L suffixes each byte has
    deal(first, np.array([n]), True)            # the sentinel's left neighbour comes first
    for c in range(1, 257):
        at = starts[c]
        for batch in first.take(c):
            out[at:at + len(batch)] = batch
            at += len(batch)
            deal(first, batch, True)
        larger[c] = at - starts[c]
        deal(first, seeds[ends[c]:ends[c + 1]], True)
    second = ByteQueues(memory)
    for c in range(256, 0, -1):
        at = starts[c + 1] if c < 256 else n
        for batch in second.take(c):            # from the largest down
            out[at - len(batch):at] = batch[::-1]
            at -= len(batch)
            deal(second, batch, False)
        deal(second, out[starts[c]:starts[c] + larger[c]][::-1], False)
    return out


def named(text: np.ndarray, order: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Names (from 1) of the substrings text[p:ends[p]] met in ``order``; equal ones share a name."""
    new = np.ones(len(order), bool)
    size = ends - order
    for at in range(1, len(order), 1 << 16):
        a, b = order[at - 1:at - 1 + (1 << 16)], order[at:at + (1 << 16)]
        a = a[:len(b)]
        la, lb = size[at - 1:at - 1 + len(b)], size[at:at + len(b)]
        differ = la != lb
        same = np.flatnonzero(~differ)
        if len(same):
            n = la[same]
            offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            unequal = text[np.repeat(a[same], n) + offset] != text[np.repeat(b[same], n) + offset]
            differ[same] = np.add.reduceat(unequal, np.cumsum(n) - n) > 0
        new[at:at + len(b)] = differ
    return np.cumsum(new)


def suffix_order(raw: np.ndarray, depth: int, memory: int = 256 << 20) -> np.ndarray:
    """Positions of ``raw`` (bytes) ordered by the suffixes' first ``depth`` bytes at least."""
    n = len(raw)
    if n < 2:
        return np.arange(n)
    text = raw.astype(np.int64) + 1
    up = rising(text)
    low = np.flatnonzero(up[1:] & ~up[:-1]) + 1            # left-most S positions
    if not len(low):
        return induce(text, up, low, memory)
    order = induce(text, up, low, memory)
    is_low = np.zeros(n, bool)
    is_low[low] = True
    order = order[is_low[order]]                            # substrings in order
    ends = np.append(low[1:] + 1, n)[np.searchsorted(low, order)]
    name = np.zeros(n, np.int64)
    name[order] = named(text, order, ends)
    rank, step = name[low], 1
    while step < depth and rank.max() < len(rank):          # a substring covers more than one byte
        after = np.zeros_like(rank)
        after[:-step or None] = rank[step:] if step < len(rank) else 0
        key = rank * (int(rank.max()) + 1) + after
        rank = np.unique(key, return_inverse=True)[1] + 1
        step *= 2
    return induce(text, up, low[np.argsort(rank, kind="stable")], memory)
