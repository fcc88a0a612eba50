"""Content-defined anchors of byte strings: where equal windows are cut alike.

Every window of ``window`` bytes owns one anchor, its ``gram`` bytes of smallest hash (the
leftmost of equal ones). Equal windows own equal anchors at equal offsets, so a window can
only be equal to windows that own an anchor of the same hash. Windows that own one anchor
start next to each other; the bytes that they cover are a segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

ODD = 0x9E3779B97F4A7C15
STIR = np.uint64(0xD6E8FEB86659FD93)
FINAL = np.uint64(0xFF51AFD7ED558CCD)
#: Window starts hashed at once; a place among them and a window more takes PLACE_BITS.
STRETCH = 1 << 17
PLACE_BITS = 18


@lru_cache(4)
def powers(base: int, count: int) -> np.ndarray:
    found = np.ones(count, np.uint64)
    done, step = 1, base
    while done < count:
        more = min(done, count - done)
        found[done:done + more] = found[:more] * np.uint64(step)
        step, done = step * step % 2**64, done + more
    return found


def stirred(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * STIR
    return (values ^ (values >> np.uint64(29))) * FINAL


BYTES = stirred(np.arange(1, 257, dtype=np.uint64))


class Hasher:
    """Hashes of any stretch of one byte array, from prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray):
        size = len(data) + 1
        room = max(1 << (size - 1).bit_length(), 1)
        self.down = powers(pow(ODD, -1, 2**64), room)[:size]
        self.sums = np.zeros(size, np.uint64)
        np.cumsum(BYTES[data] * powers(ODD, room)[:size - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return stirred((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, gram: int) -> np.ndarray:
        return stirred((self.sums[gram:] - self.sums[:-gram]) * self.down[:len(self.sums) - gram])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row, doubling the covered length."""
    least, covered = values, 1
    while covered < width:
        step = min(covered, width - covered)
        least = np.minimum(least[:len(least) - step], least[step:])
        covered += step
    return least


def owned(data: np.ndarray, bounds: np.ndarray, window: int, gram: int):
    """(anchor hash, segment hash, anchor place, first and last window start) of each segment.

    ``bounds`` are the offsets of the texts in ``data``, the end included; no window crosses
    one. ``data`` has at most STRETCH window starts.
    """
    none = np.zeros(0, np.int64)
    if len(data) < window:
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    hasher = Hasher(data)
    grams = hasher.grams(gram)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = sliding_least(grams & ~low | np.arange(len(grams), dtype=np.uint64), window - gram + 1)
    starts = np.arange(len(least))
    ends = np.repeat(bounds[1:], np.diff(bounds))[:len(starts)]
    inside = starts + window <= ends
    starts, place = starts[inside], (least[inside] & low).astype(np.int64)
    if not len(starts):
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    heads = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    tails = np.concatenate([heads[1:], [len(starts)]]) - 1
    first, last, place = starts[heads], starts[tails], place[heads]
    return grams[place], hasher.of(first, last + window), place, first, last


def segments(texts: list[bytes], window: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text index, anchor hash, segment hash, anchor place, first, last start), places within texts."""
    group: list[tuple[int, int, bytes]] = []
    size = 0

    def done():
        data = np.frombuffer(b"".join(part for _, _, part in group), np.uint8)
        bounds = np.cumsum([0, *(len(part) for _, _, part in group)])
        anchor, segment, place, first, last = owned(data, bounds, window, gram)
        of = np.searchsorted(bounds, first, side="right") - 1
        shift = np.array([at for _, at, _ in group], np.int64)[of] - bounds[of]
        index = np.array([i for i, _, _ in group], np.int64)[of]
        return index, anchor, segment, place + shift, first + shift, last + shift

    for i, text in enumerate(texts):
        # a long text is cut between window starts; cuts only divide segments
        for at in range(0, max(len(text) - window + 1, 0), STRETCH):
            part = text[at:at + STRETCH + window - 1]
            if size + len(part) > STRETCH and group:
                yield done()
                group, size = [], 0
            group.append((i, at, part))
            size += len(part)
    if group:
        yield done()
