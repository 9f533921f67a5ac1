"""Periodic runs of words, found by dyadic catchers of squares.

Each completed aligned block of 2**k words has a catcher. It watches the words that follow for the block's next
occurrences at the distances 2**(k+1) - 1 to 2**(k+2) - 2: a square whose half is that long holds such a block in its first
half. An occurrence starts comparisons of the two places to both sides; words agree as far as the distance is a period, so
the stretch found is a square if it is at least twice as long as the distance. Squares of one stretch are one run, whose
period is the smallest distance.

The catchers of a level are advanced together over all words of a block of documents. Windows of 2**k words are told apart
by 64-bit names, each mixed from the names of its halves; comparisons to the sides go on by such windows, the larger first.
What is reported is checked word by word.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from attestry.llm.blocks import Block, Words, append_columns, blocks, mix, per_document, word_hashes, words

MIN_LENGTH = 24
MIN_EXPONENT = 3
KEPT = 64
FIELDS = {"n_words": "long", "runs": "array<struct<start:long,length:long,period:long>>", "collapsed": "string"}


class Catchers:
    """The words of some documents, one after the other, with the first word of each document in `offsets`."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray, min_length: int, min_exponent: int) -> None:
        self.ids, self.offsets = ids, offsets
        self.min_length, self.min_exponent = min_length, min_exponent
        self.names = {1: mix(ids.copy())}
        document = per_document(np.diff(offsets))
        self.low, self.high = offsets[:-1][document], offsets[1:][document]

    def name(self, size: int) -> np.ndarray:
        """Names of all windows of `size` words; those of up to `KEPT` and of the newest size are kept."""
        if size not in self.names:
            half = self.name(size // 2)
            if len(half) <= size // 2:
                return np.zeros(0, np.uint64)
            self.names[size] = mix(half[: -size // 2] * np.uint64(0x9E3779B97F4A7C15) + half[size // 2 :])
            if size // 2 > KEPT:
                del self.names[size // 2]
        return self.names[size]

    def first_level(self) -> int:
        """The size of the smallest blocks: any run of a period that its catchers watch for must hold a whole block and
        that block's next occurrence."""
        size = 1
        while all(self._matched(p) >= 4 * size - 1 for p in range(1, 8 * size - 1)):
            size *= 2
        return size

    def _matched(self, period: int) -> int:
        """Words that agree with those a period later, in the shortest run to be found."""
        return max(self.min_length - period, (self.min_exponent - 1) * period)

    def occurrences(self, size: int, nearest: int) -> tuple[np.ndarray, np.ndarray]:
        """(block start, distance) of the catchers of a level; of blocks in a row that recur alike only the first."""
        ids, farthest = self.ids, 4 * size - 1
        n = len(ids) // size
        names = self.name(size)
        prints = np.zeros(n * size + farthest, np.uint64)
        prints[: len(names)] = names
        ahead = np.lib.stride_tricks.as_strided(
            prints[nearest:], (n, farthest - nearest), (size * prints.itemsize, prints.itemsize), writeable=False
        )
        same = ahead == prints[: n * size : size, None]
        block, distance = np.nonzero(same)
        at, period = block * size, distance + nearest
        inside = at + period + size <= self.high[at]
        before = np.maximum(at - size, 0)
        known = (block > 0) & (self.low[at] <= before) & same[np.maximum(block - 1, 0), distance]
        chosen = inside & ~known
        return at[chosen], period[chosen]

    def _agree(self, one: np.ndarray, other: np.ndarray, limit: np.ndarray, step: int) -> np.ndarray:
        """For how many words two places agree, going on from them (`step` 1) or back (-1), at most `limit`."""
        got = np.zeros(len(one), np.int64)
        for size in sorted(self.names, reverse=True):
            names, live = self.names[size], np.arange(len(one))
            while len(live):
                live = live[limit[live] - got[live] >= size]
                shift = got[live] if step > 0 else -got[live] - size
                live = live[names[one[live] + shift] == names[other[live] + shift]]
                got[live] += size
        return got

    def stretches(self, at: np.ndarray, period: np.ndarray, size: int) -> np.ndarray:
        """Rows (start, end, period, block start) of the long enough stretches around the blocks."""
        after = at + size
        end = after + period + self._agree(after, after + period, self.high[at] - after - period, 1)
        start = at - self._agree(at, at + period, at - self.low[at], -1)
        return self._long(np.stack([start, end, period, at], axis=1))

    def _long(self, found: np.ndarray) -> np.ndarray:
        length = found[:, 1] - found[:, 0]
        return found[length >= np.maximum(self.min_length, self.min_exponent * found[:, 2])]

    def _exact(self, period: int, at: int) -> list[tuple[int, int]]:
        """The stretches of a distance in the document of the word `at`, compared word by word."""
        low, high = int(self.low[at]), int(self.high[at])
        same = self.ids[low : high - period] == self.ids[low + period : high]
        edges = np.flatnonzero(np.diff(np.r_[False, same, False]))
        found = [(low + a, low + b + period) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
        return [(a, b) for a, b in found if b - a >= max(self.min_length, self.min_exponent * period)]

    def runs(self) -> np.ndarray:
        """Rows (start, end, period) of all runs, sorted."""
        longest = int(np.diff(self.offsets).max(initial=0))
        found = [np.zeros((0, 4), np.int64)]
        if longest >= self.min_length:
            size, nearest = self.first_level(), 1
            while nearest <= longest // self.min_exponent:
                found.append(self.stretches(*self.occurrences(size, nearest), size))
                size *= 2
                nearest = 2 * size - 1
        squares = np.concatenate(found)
        squares = squares[np.lexsort((squares[:, 2], squares[:, 1], squares[:, 0]))]
        kept: dict[tuple[int, int], int] = {}
        for start, end, period, at in squares.tolist():
            # Further distances of a stretch are multiples of its period.
            if (start, end) in kept:
                continue
            if np.array_equal(self.ids[start : end - period], self.ids[start + period : end]):
                kept[start, end] = period
            else:
                for seen in self._exact(period, at):
                    kept[seen] = min(period, kept.get(seen, period))
        return np.array(sorted((*k, p) for k, p in kept.items()), np.int64).reshape(-1, 3)


def collapsed(block: Block, found: Words, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the documents' words joined by one space, each run cut to its first period."""
    data = block.data.copy()
    stays = np.ones(len(found.starts), dtype=bool)
    for start, end, period in runs.tolist():
        stays[start + period : end] = False
    edges = np.zeros(len(data) + 1, np.int8)
    edges[found.starts[stays]] += 1
    # A word is followed by white space wherever another word follows; that byte becomes the separator.
    at = np.flatnonzero(stays)
    document = per_document(found.counts)[at]
    last = np.r_[document[1:] != document[:-1], True][: len(at)]
    ends = found.ends[at]
    data[ends[~last]] = 0x20
    stop = ends + ~last
    np.subtract.at(edges, stop, 1)
    mask = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    return data[mask], np.r_[0, np.cumsum(mask)][block.offsets]


def find(
    docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT, drop: tuple = ()
) -> DataFrame:
    """Rows of `docs` with `n_words`, `runs` and `collapsed`; nothing is shuffled.

    A run is a longest stretch of words (split at ASCII white space) with smallest period q and at least
    max(`min_length`, `min_exponent` * q) words; `start` is its first word's number, from 0. Runs are sorted by start, then
    period. `collapsed` has the words joined by one space, without those that a run holds after its first q words. A null
    or empty text has no words, no runs and an empty `collapsed`. Each row stands for itself, whatever its key; an empty
    table gives no rows. Columns named as the new ones are replaced, those in `drop` left out.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has at least two words and two periods")

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            counts, tables, sizes, texts = [], [np.zeros((0, 3), np.int64)], [], []
            for block in blocks(batch.column(batch.schema.get_field_index(text))):
                found = words(block)
                runs = Catchers(word_hashes(block, found), found.offsets, min_length, min_exponent).runs()
                data, offsets = collapsed(block, found, runs)
                texts.append(
                    pa.StringArray.from_buffers(
                        len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data.tobytes())
                    )
                )
                document = np.searchsorted(found.offsets, runs[:, 0], side="right") - 1
                runs[:, :2] -= found.offsets[document][:, None]
                runs[:, 1] -= runs[:, 0]
                counts.append(found.counts)
                tables.append(runs)
                sizes.append(np.bincount(document, minlength=len(found.counts)))
            table = np.concatenate(tables)
            ends = np.r_[0, np.cumsum(np.concatenate(sizes))].astype(np.int32)
            rows = pa.StructArray.from_arrays(
                [pa.array(np.ascontiguousarray(table[:, i])) for i in range(3)], names=["start", "length", "period"]
            )
            return {
                "n_words": pa.array(np.concatenate(counts).astype(np.int64)),
                "runs": pa.ListArray.from_arrays(pa.array(ends), rows),
                "collapsed": pa.chunked_array(texts, pa.string()).combine_chunks(),
            }

        return work

    return append_columns(docs, FIELDS, make, drop)
