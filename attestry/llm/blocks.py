"""Vectorised work on Arrow text batches: blocks of bytes, words, and rolling fingerprints.

A task sees its rows as Arrow batches. A batch is cut into blocks of whole documents of about `BLOCK_BYTES`, so that
the arrays of a block stay small whatever the batch holds; only a single longer document makes a longer block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BYTES = 1 << 20
#: For work that holds many 64-bit values for each byte; a Python worker keeps some 60 MB less than with larger blocks.
SMALL_BLOCK_BYTES = 1 << 18
#: Stands for a null doc_id inside operators that order documents: nulls come first.
NULL_ID = -(1 << 63)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass
class Block:
    """Rows `low` to `high` of a batch; `data[ends[i-1]:ends[i]]` is a document (`offsets` has a leading 0)."""

    low: int
    high: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def blocks(column: pa.Array | pa.ChunkedArray, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a text column into blocks of whole documents; null is taken as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    n = len(column)
    if not n:
        return
    held = column.buffers()
    offsets = np.frombuffer(held[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(held[2], dtype=np.uint8) if held[2] is not None and held[2].size else np.zeros(0, np.uint8)
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1)
        yield Block(low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


class Powers:
    """Powers of the rolling base modulo 2**64, and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _BASE, dtype=np.uint64)], dtype=np.uint64)
                self.down = np.cumprod(np.r_[np.uint64(1), np.full(n - 1, _INVERSE, dtype=np.uint64)], dtype=np.uint64)
        return self.up, self.down


_POWERS = Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of a 64-bit value over the word (multiply and shift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def symbol_values(seed: int, lower: bool = False) -> np.ndarray:
    """A random 64-bit value for each byte; `lower` gives A-Z the values of a-z."""
    values = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return values[_LOWER] if lower else values


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which `span` takes the fingerprint of any run of symbols."""
    up, _ = _POWERS.get(len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def span(sums: np.ndarray, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
    """Fingerprints of the runs [start, end); equal runs get equal values wherever they stand."""
    _, down = _POWERS.get(len(sums))
    return mix((sums[end] - sums[start]) * down[: len(sums)][start])


@dataclass
class Words:
    """Words of a block: byte ranges, and `offsets[i]` as the first word of document i."""

    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def words(block: Block) -> Words:
    """Runs of bytes other than ASCII white space; none crosses a document."""
    solid = ~_SPACE[block.data]
    first, last = solid.copy(), solid.copy()
    if len(solid):
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        edge = block.offsets[:-1][block.lengths > 0]
        first[edge] = solid[edge]
        edge = block.offsets[1:][block.lengths > 0] - 1
        last[edge] = solid[edge]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(starts, ends, np.searchsorted(starts, block.offsets))


def word_hashes(block: Block, found: Words, seed: int = 1, lower: bool = False) -> np.ndarray:
    sums = prefix(symbol_values(seed, lower)[block.data])
    return span(sums, found.starts, found.ends)


def per_document(counts: np.ndarray) -> np.ndarray:
    """The document index of each item, from the item counts of the documents."""
    return np.repeat(np.arange(len(counts)), counts)


def sums_by(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of `values` over [offsets[i], offsets[i + 1]), 0 for empty ranges."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), dtype=np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def append_columns(
    df: DataFrame, fields: dict[str, str], make: Callable[[], Callable[[pa.RecordBatch], dict]], drop: tuple = ()
) -> DataFrame:
    """Rows of `df` with columns computed from each Arrow batch.

    Columns of `df` named as a new one (in any case) are replaced. `make` runs once in each task and returns the
    function of a batch; columns in `drop` are read but not returned.
    """
    taken = {x.lower() for x in fields}
    kept = [c for c in df.columns if c.lower() not in taken and c not in drop]
    schema = T.StructType([df.schema[c] for c in kept])
    for name, kind in fields.items():
        schema = schema.add(name, T._parse_datatype_string(kind))
    read = [*kept, *(c for c in drop if c in df.columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows:
                new = work(batch)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in kept), *(new[c] for c in fields)], names=[*kept, *fields]
                )

    return df.select(*(F.col(f"`{c}`") for c in read)).mapInArrow(run, schema)


def fold(column: str, modulus: int) -> F.Column:
    """crc32 of the id as text, modulo `modulus`; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus
