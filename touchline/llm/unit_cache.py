"""Encoded units of text (words), remembered per worker."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, compress, repeat

import numpy as np

from touchline.llm.common import ragged

# Units of a worker before the rare ones are forgotten. Bounds memory, does not change results.
MAX_UNITS = 250_000


class UnitCache:
    """Ids of whole texts from the ids of their units. ``encode`` gives the ids of each new unit."""

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]], limit: int = MAX_UNITS):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.lengths, self.starts, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.seen = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the more often seen half of the units, or fewer."""
        common = self.seen > max(1, int(np.median(self.seen)))
        lengths = self.lengths[common]
        ids = self.ids[ragged(self.starts[common], lengths)]
        kept = compress(list(self.known), common.tolist())
        self._clear()
        self.known = {unit: i for i, unit in enumerate(kept)}
        self.lengths, self.starts, self.ids = lengths, np.cumsum(lengths) - lengths, ids
        self.seen = np.zeros(len(lengths), np.int64)

    def _add(self, units: list[bytes]) -> None:
        new = self.encode(units)
        lengths = np.fromiter(map(len, new), np.int64, len(new))
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        self.known.update(zip(units, range(len(self.known), len(self.known) + len(units))))
        self.lengths = np.concatenate([self.lengths, lengths])
        self.starts = np.concatenate([self.starts, starts])
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in new for i in x), np.int32, int(lengths.sum()))])

    def rest(self) -> None:
        """Between tasks a worker remembers the common units only."""
        if len(self.known) > self.limit // 2:
            self._forget()

    def texts(self, units: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each."""
        if len(self.known) > self.limit:
            self._forget()
        count = np.fromiter(map(len, units), np.int64, len(units))
        total = int(count.sum())
        at = np.fromiter(map(self.known.get, chain.from_iterable(units), repeat(-1)), np.int64, total)
        new = np.flatnonzero(at < 0)
        if len(new):
            missing = list(compress(chain.from_iterable(units), (at < 0).tolist()))
            self._add(list(dict.fromkeys(missing)))
            at[new] = np.fromiter(map(self.known.__getitem__, missing), np.int64, len(missing))
        self.seen = np.bincount(at, minlength=len(self.known)) + np.pad(self.seen, (0, len(self.known) - len(self.seen)))
        lengths = self.lengths[at]
        before = np.concatenate([[0], np.cumsum(lengths)])
        ends = np.concatenate([[0], np.cumsum(count)])
        return self.ids[ragged(self.starts[at], lengths)], np.diff(before[ends])
