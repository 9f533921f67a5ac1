"""Substring deduplication of bytes with a logarithmic family of suffix arrays.

Texts come in batches. A batch gets a suffix array: its window starts in the order of the suffixes that begin there, cut
at the window size. The array is merge-scanned with each existing level: suffixes that agree over a whole window are long
matches. Then the batch becomes a level, and levels of equal size are merged until sizes differ, so a text takes part in
logarithmically many merges. In the corpus job the pieces of an anchor partition of `repeats` go through families of bounded size.

The same families find repeated passages of words: their symbols are the words' hashes instead of bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm import repeats
from attestry.llm.blocks import (
    SMALL_BLOCK_BYTES,
    Block,
    append_columns,
    blocks,
    per_document,
    prefix,
    span,
    symbol_values,
    word_hashes,
    words,
)
from attestry.llm.store import noted, release, stored

SIZE = 400
ANCHOR = 128
#: Words of the anchor of a passage, for passages of any length above.
PASSAGE_ANCHOR = 8


class Level:
    """A sorted suffix array: by the suffixes' first eight bytes, then by the fingerprint of the window.

    Only equality over the whole window matters below the first eight bytes, so any order serves there.
    """

    def __init__(self, head: np.ndarray, rest: np.ndarray, entry: np.ndarray) -> None:
        order = np.lexsort((rest, head))
        self.head, self.rest, self.entry = head[order], rest[order], entry[order]

    def __len__(self) -> int:
        return len(self.entry)


class Family:
    """Levels of suffix arrays. Entries are numbered as they come; `marked` tells which have an equal elsewhere."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.levels: list[tuple[int, Level]] = []  # (batches in it, level)
        self.marked = np.zeros(0, dtype=bool)

    def add(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Add a batch: bytes or hashes of words, and the window starts in them. Returns the entries' numbers."""
        entry = len(self.marked) + np.arange(len(starts))
        self.marked = np.r_[self.marked, np.zeros(len(starts), dtype=bool)]
        rest = span(prefix(symbol_values(23)[data] if data.dtype == np.uint8 else data), starts, starts + self.size)
        head = np.zeros(len(starts), np.uint64)
        for i in range(min(8, self.size)):
            head = head << np.uint64(8) | data[starts + i].astype(np.uint8)
        new = Level(head, rest, entry)
        self._scan(new)
        for _, level in self.levels:
            self._scan(new, level)
        batches = 1
        while self.levels and self.levels[-1][0] == batches:
            _, level = self.levels.pop()
            new = Level(*(np.concatenate(x) for x in ((new.head, level.head), (new.rest, level.rest), (new.entry, level.entry))))
            batches *= 2
        self.levels.append((batches, new))
        return entry

    def _scan(self, new: Level, level: Level | None = None) -> None:
        """Mark the long matches inside a level, or between two."""
        if level is None:
            same = (new.head[1:] == new.head[:-1]) & (new.rest[1:] == new.rest[:-1])
            self.marked[new.entry[1:][same]] = self.marked[new.entry[:-1][same]] = True
            return
        both = Level(*(np.concatenate(x) for x in ((new.head, level.head), (new.rest, level.rest), (new.entry, level.entry))))
        self._scan(both)


class _Job:
    """A family over pieces, with the place of each entry."""

    def __init__(self, size: int) -> None:
        self.size, self.family = size, Family(size)
        self.rows: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.queries: list[np.ndarray] = []

    def __len__(self) -> int:
        return len(self.family.marked)

    def add(self, block: Block, at: dict[str, np.ndarray], low: int, high: int) -> None:
        """Rows `low` to `high` of a block of symbols as a batch."""
        offsets = block.offsets[low : high + 1] - block.offsets[low]
        count = np.diff(offsets) - self.size + 1
        row = per_document(count)
        nth = np.arange(len(row)) - np.r_[0, np.cumsum(count)][row]
        self.family.add(block.data[block.offsets[low] : block.offsets[high]], offsets[:-1][row] + nth)
        row += block.low + low
        self.rows.append(at["row"][row])
        self.places.append((at["a"][row] + nth).astype(np.int32))
        self.queries.append(at["query"][row].astype(bool))

    def found(self) -> pa.RecordBatch:
        """Marked windows as ranges."""
        row, place = np.concatenate(self.rows), np.concatenate(self.places)
        found = self.family.marked & np.concatenate(self.queries)
        row, place = row[found], place[found]
        order = np.lexsort((place, row))
        row, place = row[order], place[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (place[1:] > place[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.r_[first[1:], len(row)] - 1 if len(row) else first
        return pa.RecordBatch.from_arrays(
            [pa.array(row[first]), pa.array(place[first]), pa.array(place[last])], names=["row", "a", "b"]
        )


def _hashed(block: Block) -> Block:
    """The words of a block as symbols."""
    found = words(block)
    return Block(block.low, block.high, word_hashes(block, found, 23), found.offsets)


def index(
    size: int, batch_bytes: int = 1 << 18, family_entries: int = 1 << 19, by_words: bool = False
) -> repeats.Index:
    """Families over the pieces of a partition, which come sorted by anchor.

    A family that has `family_entries` is closed where the anchor changes; pieces of different anchors can't match.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        job, last = _Job(size), None
        for batch in batches:
            at = {x: batch.column(x).to_numpy(zero_copy_only=False) for x in ("anchor", "row", "a", "query")}
            for block in blocks(batch.column(batch.schema.get_field_index("body")), batch_bytes):
                block = _hashed(block) if by_words else block
                anchor = at["anchor"][block.low : block.high]
                low = 0
                if len(job) >= family_entries:
                    other = np.flatnonzero(anchor != last)
                    low = int(other[0]) if len(other) else len(anchor)
                    if low:
                        job.add(block, at, 0, low)
                    if len(other):
                        yield job.found()
                        job = _Job(size)
                if low < len(anchor):
                    job.add(block, at, low, len(anchor))
                last = anchor[-1]
        if len(job):
            yield job.found()

    return run


def duplicate_spans(rows: DataFrame, size: int = SIZE) -> DataFrame:
    """(row, text, spans): byte ranges covered by a `size`-byte string that also starts anywhere else.

    `rows` is (doc, row, text). Null and short texts have no window. Every row is a document, so repeated rows mark each
    other.
    """
    frame = repeats.Frame(by_words=False, size=size, anchor=max(1, size * ANCHOR // SIZE), keep_first=False)
    return repeats.spans(rows, frame, index(size), ("anchor",))


def repeated_passages(rows: DataFrame, size: int) -> DataFrame:
    """(row, text, spans): ranges of words covered by a passage of `size` words that also starts anywhere else.

    As `duplicate_spans`, but white space between the words may differ.
    """
    frame = repeats.Frame(by_words=True, size=size, anchor=min(size, PASSAGE_ANCHOR), keep_first=False)
    return repeats.spans(rows, frame, index(size, by_words=True), ("anchor",))


def _bytes_of_words(found: DataFrame) -> DataFrame:
    """(row, text, spans) with ranges of words turned into ranges of bytes, from a first word to the end of a last one."""

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            out = []
            spans = batch.column("spans").to_pylist()
            for block in blocks(batch.column(batch.schema.get_field_index("text")), SMALL_BLOCK_BYTES):
                at = words(block)
                for i in range(block.low, block.high):
                    first, start = at.offsets[i - block.low], block.offsets[i - block.low]
                    out.append(
                        [
                            {"start": int(at.starts[first + x["start"]] - start), "end": int(at.ends[first + x["end"] - 1] - start)}
                            for x in spans[i]
                        ]
                    )
            return {"spans": pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))}

        return work

    return append_columns(found, {"spans": "array<struct<start:int,end:int>>"}, make, ("spans",))


def _kept_alone(found: Callable[[], DataFrame]) -> DataFrame:
    """(row, spans) of `found`, stored; what it has stored on the way is deleted."""
    with noted() as paths:
        out = stored(found().select("row", "spans"), "spans")
    release(paths[:-1], out)
    return out


def _cut(body: bytes, spans: list[dict], whole_characters: bool) -> bytes:
    kept, at = [], 0
    for x in spans:
        start, end = x["start"], min(x["end"], len(body))
        if whole_characters:
            while start < end and body[start] & 0xC0 == 0x80:
                start += 1
            while end > start and end < len(body) and body[end] & 0xC0 == 0x80:
                end -= 1
        kept.append(body[at:start])
        at = max(at, end)
    kept.append(body[at:])
    return b"".join(kept)


def summary(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256), a row for each row of `docs`."""
    held = repeats.numbered(docs.select(key, text))
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    base = held.select(
        F.col(repeats.ROW).alias("row"),
        F.col(f"`{key}`").alias("__key"),
        F.octet_length(body).cast("long").alias("n_bytes"),
        F.sha2(body, 256).alias("whole"),
    )

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            n, count, digest = [], [], []
            for body, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                raw = body.encode()
                kept = _cut(raw, spans, False)
                n.append(len(raw) - len(kept))
                count.append(len(spans))
                digest.append(hashlib.sha256(kept).hexdigest())
            return {
                "n_removed": pa.array(n, pa.int64()),
                "n_spans": pa.array(count, pa.int64()),
                "kept_sha256": pa.array(digest),
            }

        return work

    fields = {"n_removed": "long", "n_spans": "long", "kept_sha256": "string"}
    found = append_columns(duplicate_spans(repeats.keyed(held, key, text), size), fields, make, ("text", "spans"))
    return base.join(found, "row", "left").select(
        F.col("__key").alias(key),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )


def remove(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, passage: int | None = None
) -> DataFrame:
    """`docs` with the marked bytes taken out of the texts (a cut character stays whole). Rows and columns stay.

    With `passage`, words covered by a passage of so many words that also starts anywhere else go as well, however few bytes
    it has. Both are judged on the texts as given.
    """

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            pairs = zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True)
            return {"kept": pa.array([_cut(x.encode(), s, True).decode("utf-8", "replace") for x, s in pairs], pa.string())}

        return work

    held = repeats.numbered(docs)
    given = repeats.keyed(held, key, text)
    if passage is None:
        found = duplicate_spans(given, size)
    else:
        parts = [_kept_alone(lambda: duplicate_spans(given, size)), _kept_alone(lambda: _bytes_of_words(repeated_passages(given, passage)))]
        # Rows of both kinds have their ranges merged; a row has at most one list of each kind.
        both = parts[0].unionByName(parts[1]).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))
        found = given.select("row", "text").join(both, "row").withColumn("spans", F.array_sort("spans"))
    found = append_columns(found, {"kept": "string"}, make, ("text", "spans"))
    rows = held.join(found.select(F.col("row").alias(repeats.ROW), F.col("kept").alias("__kept")), repeats.ROW, "left")
    new = F.coalesce("__kept", F.col(f"`{text}`"))
    return rows.select(*(new.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns))
