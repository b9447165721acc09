"""Burrows-Wheeler transform and common prefixes of a collection of texts, built column by column.

Each round inserts one symbol of every text that is not used up, from its last one on. The suffix that a text's symbol begins
stands behind all suffixes that begin with smaller symbols and those with the same symbol whose rests come first: so its place is the number
of smaller symbols in the transform so far plus the rank of its own. Its common prefix with the one before it is one more than the smallest value between
their rests, and that of the one after it likewise. Ends of texts are smaller than all symbols, differ from each other, and stand in
the order of the texts.

Transform and prefixes are two files that a round reads from start to end and writes anew; memory holds a block of them and one place per text.
Files are private to the task, have no name, and go with it.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np

#: Entries of the files handled at a time.
BLOCK = 1 << 21
#: Where no common prefix is known yet.
_NONE = 255


class Collection:
    """The index of the texts ``data[starts[i]:starts[i + 1]]``; common prefixes count up to ``limit`` (at most 254)."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, limit: int):
        self.data, self.starts, self.limit = data, starts, limit
        self.lengths = np.diff(starts)
        used = np.flatnonzero(np.bincount(data, minlength=256)) if len(data) else np.zeros(0, np.int64)
        # Symbols by their order; 0 is the end of a text.
        self.symbols = len(used) + 1
        self.kind = np.uint8 if self.symbols <= 256 else np.uint16
        self.code = np.zeros(256, self.kind)
        self.code[used] = np.arange(1, self.symbols)
        self.transform, self.prefixes, self.size = self._build()

    def _symbol(self, texts: np.ndarray, done: int) -> np.ndarray:
        """The symbol before the last ``done`` ones of each text; 0 before the first."""
        at = self.starts[texts + 1] - done - 1
        inside = at >= self.starts[texts]
        return np.where(inside, self.code[self.data[np.maximum(at, 0)]], 0).astype(self.kind) if len(self.data) else np.zeros(len(texts), self.kind)

    def _build(self) -> tuple[BinaryIO, BinaryIO, int]:
        texts = np.arange(len(self.lengths))
        first = self._symbol(texts, 0)
        transform, prefixes = tempfile.TemporaryFile(), tempfile.TemporaryFile()
        transform.write(first.tobytes())
        prefixes.write(np.zeros(len(first), np.uint8).tobytes())
        totals, size, places = np.bincount(first, minlength=self.symbols), len(first), texts
        for done in range(1, int(self.lengths.max(initial=0)) + 1):
            # Texts whose latest suffix has a symbol before it go on.
            on = self.lengths[texts] >= done
            texts, places = texts[on], places[on]
            begins = len(self.lengths) + np.cumsum(totals[:-1]) - totals[0]
            begins = np.concatenate([[0], begins])
            targets, values, fresh, owners = self._places(transform, prefixes, size, places, begins)
            symbols = self._symbol(texts[owners], done)
            transform, prefixes = self._merge(transform, prefixes, size, targets, values, fresh, symbols)
            texts, places = texts[owners], targets[fresh]
            size += len(texts)
            totals = totals + np.bincount(symbols, minlength=self.symbols)
        return transform, prefixes, size

    def _blocks(self, file: BinaryIO, size: int, kind: type) -> Iterator[np.ndarray]:
        file.seek(0)
        for lo in range(0, size, BLOCK):
            n = min(BLOCK, size - lo)
            yield np.frombuffer(file.read(n * np.dtype(kind).itemsize), kind)

    def _places(self, transform: BinaryIO, prefixes: BinaryIO, size: int, places: np.ndarray, begins: np.ndarray):
        """Where suffixes go, and the common prefixes there: of the new ones and of each old one right behind a new one.

        Returned in the order of the places, with a mark of the new ones and, for these, which of ``places`` (ascending) they come from.
        """
        rank = np.zeros(self.symbols, np.int64)
        since = np.full(self.symbols, _NONE, np.uint8)
        was_new = np.zeros(self.symbols, bool)
        found: list[tuple[np.ndarray, ...]] = []
        lo = 0
        for block, low in zip(self._blocks(transform, size, self.kind), self._blocks(prefixes, size, np.uint8)):
            a, b = np.searchsorted(places, [lo, lo + len(block)])
            new = np.zeros(len(block), bool)
            new[places[a:b] - lo] = True
            order = np.argsort(block, kind="stable")
            counts = np.bincount(block, minlength=self.symbols)
            heads = np.cumsum(counts) - counts
            present = np.flatnonzero(counts)
            marked = new[order]
            wanted = marked.copy()
            wanted[1:] |= marked[:-1]
            # The first of a symbol follows the last one of earlier blocks.
            wanted[heads[present]] = marked[heads[present]] | was_new[present]
            k = np.flatnonzero(wanted)
            at, symbol = order[k], block[order[k]].astype(np.int64)
            before = np.where(k > heads[symbol], order[k - 1], -1)
            least = self._least(low, before, at)
            head = before < 0
            least[head] = np.minimum(least[head], since[symbol[head]])
            value = np.minimum(least.astype(np.int64) + 1, self.limit)
            value[head & (rank[symbol] == 0)] = 0
            target = begins[symbol] + rank[symbol] + k - heads[symbol]
            found.append((target, value.astype(np.uint8), marked[k], np.searchsorted(places, at + lo)))
            if lo + len(block) == size:
                break
            tails = order[(heads + counts - 1)[present]]
            after = np.minimum.accumulate(np.append(low, _NONE)[::-1])[::-1]
            since = np.minimum(since, after[0])
            since[present] = after[tails + 1]
            was_new[present] = new[tails]
            rank += counts
            lo += len(block)
        target, value, fresh, owner = (np.concatenate(c) for c in zip(*found))
        turn = np.argsort(target, kind="stable")
        return target[turn], value[turn], fresh[turn], owner[turn][fresh[turn]]

    @staticmethod
    def _least(low: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The smallest of ``low[before + 1 : at + 1]`` for each pair."""
        if not len(at):
            return np.zeros(0, np.uint8)
        # Backwards, so that what reduceat does between the pairs is one entry each.
        bounds = np.empty(2 * len(at), np.int64)
        bounds[0::2], bounds[1::2] = (before + 1)[::-1], (at + 1)[::-1]
        return np.minimum.reduceat(np.append(low, np.uint8(_NONE)), bounds)[0::2][::-1].copy()

    def _merge(self, transform, prefixes, size, targets, values, fresh, symbols) -> tuple[BinaryIO, BinaryIO]:
        new_transform, new_prefixes = tempfile.TemporaryFile(), tempfile.TemporaryFile()
        transform.seek(0)
        prefixes.seek(0)
        added = targets[fresh]
        for lo in range(0, size + len(added), BLOCK):
            hi = min(lo + BLOCK, size + len(added))
            a, b = np.searchsorted(added, [lo, hi])
            old = np.ones(hi - lo, bool)
            old[added[a:b] - lo] = False
            n = hi - lo - (b - a)
            block, low = np.empty(hi - lo, self.kind), np.empty(hi - lo, np.uint8)
            block[old] = np.frombuffer(transform.read(n * block.itemsize), self.kind)
            block[added[a:b] - lo] = symbols[a:b]
            low[old] = np.frombuffer(prefixes.read(n), np.uint8)
            a, b = np.searchsorted(targets, [lo, hi])
            low[targets[a:b] - lo] = values[a:b]
            new_transform.write(block.tobytes())
            new_prefixes.write(low.tobytes())
        transform.close()
        prefixes.close()
        return new_transform, new_prefixes

    def suffixes(self, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All suffixes of at least ``least`` symbols in sorted order: text, length, and the common prefix with the suffix before it."""
        block = np.concatenate([np.zeros(0, self.kind), *self._blocks(self.transform, self.size, self.kind)])
        low = np.concatenate([np.zeros(0, np.uint8), *self._blocks(self.prefixes, self.size, np.uint8)])
        back = np.empty(self.size, np.int64)
        back[np.argsort(block, kind="stable")] = np.arange(self.size)
        owner, length = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
        texts = np.arange(len(self.lengths))
        places = texts
        for done in range(1, int(self.lengths.max(initial=0)) + 1):
            on = self.lengths[texts] >= done
            texts, places = texts[on], back[places[on]]
            owner[places], length[places] = texts, done
        long = np.flatnonzero(length >= least)
        # What a shorter suffix between two long ones shares with them, they share at most.
        before = np.concatenate([[-1], long[:-1]])[: len(long)]
        return owner[long], length[long], self._least(low, before, long)

    def close(self) -> None:
        self.transform.close()
        self.prefixes.close()
