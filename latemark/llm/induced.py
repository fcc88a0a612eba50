"""External induced sorting of all suffixes of one shard.

The suffixes that start at a local valley (S* suffixes) are sorted first: their substrings
are sorted as tuples of packed symbols and named, and the names are sorted by recursion. From
them the L suffixes
are induced and from those the S suffixes. Induction runs in waves: the suffixes right before
those placed last enter a priority queue as tuples (first symbol and rank of the next suffix,
place), and one pass over the placed suffixes merges the queue into them. Text, ranks, queue
and order together live in memory up to a bound and in files of the task's own scratch folder
beyond it. Types, valleys and names are always in memory; what bounds them is the shard.
"""

from __future__ import annotations

import tempfile
import weakref

import numpy as np

#: Suffixes that enter the queue as one sorted run, and placed suffixes merged at a time.
RUN = 1 << 18
BLOCK = 1 << 13


class Scratch:
    """Arrays in memory while ``memory`` bytes last for all in use, then in files that close with the block."""

    def __init__(self, memory: int):
        self.memory, self.folder, self.files, self.used = memory, None, 0, 0

    def array(self, size: int, kind=np.int64) -> np.ndarray:
        room = size * np.dtype(kind).itemsize
        if self.used + room <= self.memory or not size:
            self.used += room
            found = np.empty(size, kind)
            weakref.finalize(found, self._back, room)  # views keep the array in use
            return found
        if self.folder is None:
            self.folder = tempfile.TemporaryDirectory(prefix="induced-")
        self.files += 1
        return np.memmap(f"{self.folder.name}/{self.files}", kind, "w+", shape=(size,))

    def _back(self, room: int) -> None:
        self.used -= room

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        if self.folder is not None:
            self.folder.cleanup()


class TupleQueue:
    """Priority queue of (key, place) tuples in sorted runs; tuples come out in ascending order."""

    def __init__(self, scratch: Scratch):
        self.scratch, self.runs = scratch, []

    def push(self, keys: np.ndarray, places: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")
        run = self.scratch.array(2 * len(keys)).reshape(2, -1)
        run[0], run[1] = keys[order], places[order]
        self.runs.append([run, 0])

    def __len__(self) -> int:
        return sum(run.shape[1] - at for run, at in self.runs)

    def pop_until(self, limit: int | None) -> tuple[np.ndarray, np.ndarray]:
        """All tuples up to ``limit`` (all there are if None)."""
        taken = []
        for entry in self.runs:
            run, at = entry
            end = run.shape[1] if limit is None else at + int(np.searchsorted(run[0, at:], limit, side="right"))
            if end > at:
                taken.append(run[:, at:end])
                entry[1] = end
        self.runs = [e for e in self.runs if e[1] < e[0].shape[1]]
        if not taken:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, places = (np.concatenate([t[k] for t in taken]) for k in (0, 1))
        if len(taken) > 1:
            order = np.argsort(keys, kind="stable")
            keys, places = keys[order], places[order]
        return keys, places


def _blocks(size: int, block: int = RUN):
    return ((at, min(at + block, size)) for at in range(0, size, block))


def _places(size: int) -> type:
    """The integer type of places in a text of so many symbols."""
    return np.int32 if size < 1 << 31 else np.int64


def _waves(text, of_kind, placed, own_keys, width, lift, scratch, rank):
    """Place all suffixes of one kind before ``placed`` ones, wave after wave.

    ``own_keys(block of places, their ranks)`` gives the sort keys of what was placed before;
    an induced suffix has key symbol * width + lift + rank of its next suffix.
    """
    order, front = placed, placed
    for start, end in _blocks(len(order)):
        rank[order[start:end]] = np.arange(start, end)
    while len(front):
        queue = TupleQueue(scratch)
        for start, end in _blocks(len(front)):
            before = front[start:end] - 1
            before = before[before >= 0]
            before = before[of_kind[before]]
            if len(before):
                queue.push(text[before] * width + lift + rank[before + 1], before)
        if not len(queue):
            return order
        count = len(queue)
        kind = _places(len(text))
        merged, front = scratch.array(len(order) + count, kind), scratch.array(count, kind)
        out = met = 0
        for start, end in _blocks(len(order), BLOCK):
            block = order[start:end]
            last = int(own_keys(block[-1:], np.array([end - 1]))[0])
            more_keys, more = queue.pop_until(last if end < len(order) else None)
            if len(more):
                keys = own_keys(block, np.arange(start, end))
                merged[out:out + len(block) + len(more)] = np.insert(block, np.searchsorted(keys, more_keys), more)
            else:
                merged[out:out + len(block)] = block
            front[met:met + len(more)] = more
            out, met = out + len(block) + len(more), met + len(more)
        order = merged
        for start, end in _blocks(len(order)):
            rank[order[start:end]] = np.arange(start, end)
    return order


def _induced(text: np.ndarray, rising: np.ndarray, valleys: np.ndarray, scratch: Scratch) -> np.ndarray:
    """The order of all suffixes from the sorted valleys."""
    width = 4 * (len(text) + 1)
    half = width // 2
    rank = scratch.array(len(text), _places(len(text)))
    rank[:] = -1

    def keys_falling(block, ranks):
        # falling suffixes before rising ones of the same symbol
        inner = rank[np.minimum(block + 1, len(text) - 1)]
        return text[block] * width + np.where(rising[block], half + ranks, inner)

    order = _waves(text, ~rising, valleys, keys_falling, width, 0, scratch, rank)
    falling = order[~rising[order]]
    # the last suffix is the least of all and rises by definition
    start = np.concatenate([[len(text) - 1], falling])
    rank[:] = -1

    def keys_rising(block, ranks):
        inner = rank[np.minimum(block + 1, len(text) - 1)]
        risen = rising[block] & (block < len(text) - 1)
        return text[block] * width + np.where(risen, half + inner, ranks)

    return _waves(text, rising, start, keys_rising, width, half, scratch, rank)


def suffix_order(text: np.ndarray, scratch: Scratch) -> np.ndarray:
    """The sorted order of all suffixes of integers whose last is least and stands once."""
    size = len(text)
    if size == 1:
        return np.zeros(1, np.int64)
    change = np.flatnonzero(text[1:] != text[:-1])
    nearest = np.searchsorted(change, np.arange(size - 1))
    rising = np.ones(size, bool)
    at = change[nearest]
    rising[:-1] = text[at] < text[at + 1]
    valley = np.zeros(size, bool)
    valley[1:] = rising[1:] & ~rising[:-1]
    places = np.flatnonzero(valley)
    if len(places) > 1:
        names = _names(text, rising, places)
        if names.max() + 1 < len(places):
            sorted_ = places[suffix_order(names, scratch)]
        else:
            sorted_ = places[np.argsort(names)]
    else:
        sorted_ = places
    return _induced(text, rising, sorted_, scratch)


def _names(text: np.ndarray, rising: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Ranks 0, 1, ... of the valley substrings; equal ones have one rank.

    A substring reaches from its valley to the next, both included. Symbols carry whether they
    rise, so that none is the beginning of another. Several are packed in a word; words beyond
    the first are only sorted for substrings that are still alike.
    """
    typed = 2 * text + rising
    bits = max(1, int(typed.max()).bit_length())
    per = max(1, 63 // bits)
    length = np.diff(np.concatenate([places, [len(text) - 1]])) + 1
    rank = np.zeros(len(places), np.int64)
    left, offset = np.arange(len(places)), 0
    while len(left):
        word = np.zeros(len(left), np.int64)
        for at in range(offset, offset + per):
            inside = at < length[left]
            symbol = typed[np.minimum(places[left] + at, len(text) - 1)]
            word = word << bits | np.where(inside, symbol, 0)
        order = np.lexsort((word, rank[left]))
        left, word = left[order], word[order]
        old = rank[left]
        head = np.concatenate([[True], (old[1:] != old[:-1]) | (word[1:] != word[:-1])])
        start = np.flatnonzero(head)
        group = np.cumsum(head) - 1
        # ranks are places in the sorted order: that of the old group, and the place within it
        old_head = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
        within = start - old_head[np.searchsorted(old_head, start, side="right") - 1]
        rank[left] = (old[start] + within)[group]
        size = np.diff(np.concatenate([start, [len(left)]]))[group]
        offset += per
        left = left[(size > 1) & (length[left] > offset)]
    return np.unique(rank, return_inverse=True)[1].astype(np.int64)


def repeats(pieces: list[bytes], window: int, memory: int = 64 << 20) -> list[np.ndarray]:
    """For each piece, a mask of its window starts whose window also starts elsewhere in ``pieces``."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    data = np.frombuffer(b"".join(p + b"\0" for p in pieces) + bytes(window + 8), np.uint8)
    heads = np.concatenate([[0], np.cumsum(sizes + 1)])
    size = int(heads[-1])
    masks = [np.zeros(max(n - window + 1, 0), bool) for n in sizes]
    with Scratch(memory) as scratch:
        text = scratch.array(size)
        count = len(pieces)
        text[:] = data[:size].astype(np.int64) + count
        # every end is a symbol of its own, the last one least
        text[heads[1:] - 1] = np.arange(count - 1, -1, -1)
        order = suffix_order(text, scratch)
        of = np.repeat(np.arange(count), sizes + 1)
        eligible = np.arange(size) + window <= (heads[1:] - 1)[of]
        starts = order[eligible[order]]
        equal = common_window(data, starts, window)
        hit = np.zeros(len(starts), bool)
        hit[1:] |= equal
        hit[:-1] |= equal
        hits = starts[hit]
        piece = of[hits]
        for p in np.unique(piece):
            masks[p][hits[piece == p] - heads[p]] = True
    return masks


def common_window(data: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Whether neighbours in ``starts`` have a common prefix of ``window`` bytes, by 8 bytes at a time."""
    words = np.zeros(len(data) - 7, np.uint64)
    for k in range(8):
        words |= data[k:len(data) - 7 + k].astype(np.uint64) << np.uint64(8 * k)
    equal = np.ones(max(len(starts) - 1, 0), bool)
    left = np.arange(len(equal))
    for offset in [*range(0, window - 7, 8), max(window - 8, 0)]:
        if window >= 8:
            alike = words[starts[left] + offset] == words[starts[left + 1] + offset]
        else:
            mask = np.uint64((1 << 8 * window) - 1)
            alike = words[starts[left]] & mask == words[starts[left + 1]] & mask
        equal[left[~alike]] = False
        left = left[alike]
    return equal
