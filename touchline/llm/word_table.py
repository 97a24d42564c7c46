"""Ids of short words, remembered per worker in flat arrays.

A word of up to 16 bytes is its own key: its first and its last eight bytes and its length. Words of a chunk are
looked up all at once by open addressing: a slot holds the number of a word, and a word whose slot holds
another one tries the next slot. Longer words go through a ``UnitCache``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from touchline.llm.common import ragged
from touchline.llm.unit_cache import UnitCache

# Bytes of a worker's arrays before the rare words are forgotten. Bounds memory, does not change results.
MAX_BYTES = 128 << 20
SHORT = 16
_WORD_BYTES = 64  # key, place, count and ids of a word, and its two slots
# Odd multipliers of the slot hash.
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class WordTable:
    """Ids of words in chunks of bytes. ``encode`` gives the ids of each new word."""

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], limit: int = MAX_BYTES):
        self.encode, self.limit = encode, limit // _WORD_BYTES
        self.long = UnitCache(encode, max(16, self.limit // 16))
        self._clear()

    def _clear(self) -> None:
        self.n = 0
        self.low, self.high = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.size, self.seen = np.zeros(0, np.uint8), np.zeros(0, np.int32)
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids, self.n_ids = np.zeros(0, np.int32), 0
        self.slots, self.shift = np.full(1 << 10, -1, np.int32), np.uint64(54)

    def _slot(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        mixed = (low * _MIX[0]) ^ ((high + size.astype(np.uint64)) * _MIX[1])
        mixed ^= mixed >> np.uint64(29)
        return (mixed * _MIX[2] >> self.shift).astype(np.int64)

    def _find(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Numbers of the words, -1 for unknown ones."""
        out = np.full(len(low), -1, np.int64)
        if not self.n:
            return out
        slot = self._slot(low, high, size)
        todo = np.arange(len(low))
        while len(todo):
            known = self.slots[slot].astype(np.int64)
            same = (known >= 0) & (self.low[known] == low[todo]) & (self.high[known] == high[todo])
            same &= self.size[known] == size[todo]
            out[todo[same]] = known[same]
            going = ~same & (known >= 0)
            todo, slot = todo[going], (slot[going] + 1) & (len(self.slots) - 1)
        return out

    def _place(self, numbers: np.ndarray) -> None:
        """Give each of the words a slot."""
        slot = self._slot(self.low[numbers], self.high[numbers], self.size[numbers])
        while len(numbers):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = numbers[free]  # of words with one free slot the last one gets it
            going = self.slots[slot] != numbers
            numbers, slot = numbers[going], (slot[going] + 1) & (len(self.slots) - 1)

    def _resize(self, n: int) -> None:
        if 2 * n > len(self.slots):
            bits = max(10, (4 * n).bit_length())
            self.slots, self.shift = np.full(1 << bits, -1, np.int32), np.uint64(64 - bits)
            self._place(np.arange(self.n, dtype=np.int32))

    def _grow(self, name: str, used: int, more: np.ndarray) -> None:
        """Append to an array with spare room, so that many small additions copy little."""
        old = getattr(self, name)
        if used + len(more) > len(old):
            wide = np.zeros(max(2 * len(old), used + len(more), 1024), old.dtype)
            wide[:used] = old[:used]
            setattr(self, name, wide)
        getattr(self, name)[used : used + len(more)] = more

    def _add(self, low: np.ndarray, high: np.ndarray, size: np.ndarray, ids: np.ndarray, counts: np.ndarray,
             seen: np.ndarray) -> None:
        for name, values in (("low", low), ("high", high), ("size", size), ("seen", seen), ("counts", counts),
                             ("starts", self.n_ids + np.cumsum(counts) - counts)):
            self._grow(name, self.n, values)
        self._grow("ids", self.n_ids, ids)
        first, self.n, self.n_ids = self.n, self.n + len(low), self.n_ids + len(ids)
        if 2 * self.n > len(self.slots):
            self._resize(self.n)
        else:
            self._place(np.arange(first, self.n, dtype=np.int32))

    def _forget(self) -> None:
        """Keep the more often seen half of the words, or fewer."""
        seen = self.seen[: self.n]
        common = np.flatnonzero(seen > max(1, int(np.median(seen))))
        counts = self.counts[common].astype(np.int64)
        kept = (self.low[common], self.high[common], self.size[common], self.ids[ragged(self.starts[common], counts)],
                counts, np.zeros(len(common), np.int32))
        self._clear()
        self._add(*kept)

    def rest(self) -> None:
        """Between tasks a worker remembers no more than its limit."""
        if self.n > self.limit:
            self._forget()
        self.long.rest()

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words data[start:end], one after the other, and the number of ids of each word."""
        if self.n > self.limit:
            self._forget()
        size = ends - starts
        long = np.flatnonzero(size > SHORT)
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
        low = eight[starts] & _MASKS[np.minimum(size, 8)]
        high = eight[starts + 8 * (size > 8)] & _MASKS[np.clip(size - 8, 0, 8)]
        short = np.minimum(size, 255).astype(np.uint8)
        at = self._find(low, high, short)
        at[long] = -1
        new = np.flatnonzero((at < 0) & (size <= SHORT))
        if len(new):
            order = new[np.lexsort((short[new], high[new], low[new]))]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0) | (np.diff(short[order]) != 0)
            number = self.n + np.cumsum(fresh) - 1
            one = order[fresh]
            raw = data.tobytes()
            coded = self.encode([raw[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist())])
            counts = np.fromiter(map(len, coded), np.int64, len(coded))
            ids = np.fromiter((i for x in coded for i in x), np.int32, int(counts.sum()))
            self._add(low[one], high[one], short[one], ids, counts, np.zeros(len(one), np.int32))
            at[order] = number
        known = at[at >= 0]
        self.seen[: self.n] += np.bincount(known, minlength=self.n).astype(np.int32)
        if not len(long):
            counts = self.counts[at].astype(np.int64)
            return self.ids[ragged(self.starts[at], counts)], counts
        raw = data.tobytes()
        more, more_counts = self.long.texts([[raw[a:b]] for a, b in zip(starts[long].tolist(), ends[long].tolist())])
        counts = np.where(at < 0, 0, self.counts[at]).astype(np.int64)
        counts[long] = more_counts
        place = np.where(at < 0, 0, self.starts[at])
        place[long] = self.n_ids + np.cumsum(more_counts) - more_counts
        return np.concatenate([self.ids[: self.n_ids], more])[ragged(place, counts)], counts
