"""Where runs of a given length stand more than once: the distributed frame of both substring operators.

A window is a run of `size` units (words or bytes) of one document. Every window is assigned to its anchor, the run of
`anchor` units inside it with the smallest fingerprint (the first of equals). Equal windows have equal anchors at the same
place, so windows can only be equal if their anchors are. Neighbouring windows share an anchor; those that do form a
chunk, the unit that is shuffled.

1. Anchors are counted; chunks whose anchor occurs once are dropped. This leaves about what is repeated.
2. Chunks with the same anchor and the same content (`digest`) have the same windows. All of them but the first are
   settled at once, and so is an anchor with a single content.
3. What is left are the first chunks of anchors with several contents: the edges of repeats. Their texts are grouped by
   anchor, and the operator's own index (suffix automata, suffix arrays) finds the windows that they share. Anchors with
   more than `HEAVY` contents would make unbounded groups; their windows are counted by fingerprint instead.

Fingerprints of 64 bits are used in pairs (anchor and digest, anchor and window). Each row is a document of its own, told
apart by a number that is stored with it; documents are ordered by key and then by this number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.blocks import (
    NULL_ID,
    SMALL_BLOCK_BYTES,
    Block,
    append_columns,
    blocks,
    per_document,
    prefix,
    signed,
    span,
    symbol_values,
    word_hashes,
    words,
)
from attestry.llm.store import drop, stored

HEAVY = 64
ROW = "__row"


@dataclass(frozen=True)
class Frame:
    """`by_words`: units are words, else bytes. `keep_first`: the first of equal windows is not marked."""

    by_words: bool
    size: int
    anchor: int
    keep_first: bool


def _units(frame: Frame, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two fingerprint sums over the units of a block, and the documents' offsets in units."""
    if frame.by_words:
        found = words(block)
        one, two = (word_hashes(block, found, seed) for seed in (17, 19))
        return prefix(one), prefix(two), found.offsets
    return prefix(symbol_values(17)[block.data]), prefix(symbol_values(19)[block.data]), block.offsets


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of `width` values."""
    step = 1
    while 2 * step <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[: len(x) - (width - step)], x[width - step :]) if width > step else x


def chunks_of(frame: Frame, block: Block) -> tuple[np.ndarray, ...]:
    """(document, first window, last window, anchor, digest) of the chunks of a block; windows count from the document."""
    one, two, offsets = _units(frame, block)
    n = len(one) - 1
    lengths = np.diff(offsets)
    count = np.maximum(lengths - frame.size + 1, 0)
    if not count.sum():
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    gram = span(one, slice(0, n - frame.anchor + 1), slice(frame.anchor, n + 1))
    # The top of the fingerprint decides; the position in the low bits breaks ties to the left.
    low = max(1, int(n).bit_length())
    ranked = (gram >> np.uint64(low) << np.uint64(low)) | np.arange(len(gram), dtype=np.uint64)
    best = (_least(ranked, frame.size - frame.anchor + 1) & np.uint64((1 << low) - 1)).astype(np.int64)
    doc = per_document(count)
    at = offsets[:-1][doc] + np.arange(len(doc)) - np.r_[0, np.cumsum(count)][doc]
    best = best[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(at)] - 1
    a, b, place = at[first], at[last], best[first]
    digest = span(two, a, b + frame.size) + (place - a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    own = offsets[:-1][doc[first]]
    return doc[first], a - own, b - own, gram[place], digest


def _chunks(docs: DataFrame, frame: Frame, whole: bool) -> DataFrame:
    """Anchors of all chunks, or the whole chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("doc", "row"))
            for block in blocks(batch.column("text"), SMALL_BLOCK_BYTES):
                doc, a, b, anchor, digest = chunks_of(frame, block)
                columns = {"anchor": pa.array(signed(anchor))}
                if whole:
                    columns |= {
                        "digest": pa.array(signed(digest)),
                        "doc": pa.array(keys[block.low + doc]),
                        "row": pa.array(rows[block.low + doc]),
                        "a": pa.array(a.astype(np.int32)),
                        "b": pa.array(b.astype(np.int32)),
                    }
                yield pa.RecordBatch.from_pydict(columns)

    schema = "anchor long" + ", digest long, doc long, row long, a int, b int" * whole
    return docs.mapInArrow(run, schema)


def numbered(docs: DataFrame) -> DataFrame:
    """`docs` with a number for each row, stored, as a later scan of `docs` may number them differently."""
    return stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc, text): the key as a long, nulls as the smallest; and `row`, the row's number, if `docs` is numbered."""
    return docs.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NULL_ID)).alias("doc"),
        *([F.col(ROW).alias("row")] if ROW in docs.columns else []),
        F.col(f"`{text}`").alias("text"),
    )


def _list(column: pa.Array) -> tuple[np.ndarray, pa.StructArray]:
    """Row of each element of a list column (nulls hold none), and the elements."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(column.value_lengths().fill_null(0))
    return per_document(sizes), column.flatten()


def _pieces(held: DataFrame, frame: Frame) -> DataFrame:
    """(anchor, doc, row, a, query, heavy, body): texts of the chunks to be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, edges = _list(batch.column("edges"))
            a, b = (np.asarray(edges.field(x)).astype(np.int64) for x in ("a", "b"))
            for block in blocks(batch.column("text"), SMALL_BLOCK_BYTES):
                low, high = np.searchsorted(row, [block.low, block.high])
                if low == high:
                    continue
                own = row[low:high] - block.low
                if frame.by_words:
                    found = words(block)
                    first = found.starts[found.offsets[own] + a[low:high]]
                    last = found.ends[found.offsets[own] + b[low:high] + frame.size - 1]
                else:
                    first = block.offsets[own] + a[low:high]
                    last = block.offsets[own] + b[low:high] + frame.size
                raw = block.data.tobytes()
                bodies = [raw[x:y] for x, y in zip(first.tolist(), last.tolist(), strict=True)]
                part = edges.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.field("anchor"),
                        batch.column("doc").take(pa.array(row[low:high])),
                        batch.column("row").take(pa.array(row[low:high])),
                        part.field("a"),
                        part.field("query"),
                        part.field("heavy"),
                        pa.array(bodies, pa.binary()),
                    ],
                    names=["anchor", "doc", "row", "a", "query", "heavy", "body"],
                )

    return held.filter(F.size("edges") > 0).select("doc", "row", "text", "edges").mapInArrow(
        run, "anchor long, doc long, row long, a int, query boolean, heavy boolean, body binary"
    )


def _counted(pieces: DataFrame, frame: Frame) -> DataFrame:
    """(row, a, b): windows of heavy anchors that stand elsewhere (or earlier), by counting fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ("anchor", "doc", "row", "a", "query")}
            for block in blocks(batch.column(batch.schema.get_field_index("body")), 1 << 18):
                one, _, offsets = _units(frame, block)
                count = np.diff(offsets) - frame.size + 1
                row = per_document(count)
                nth = np.arange(len(row)) - np.r_[0, np.cumsum(count)][row]
                start = offsets[:-1][row] + nth
                row += block.low
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(at["anchor"][row]),
                        pa.array(signed(span(one, start, start + frame.size))),
                        pa.array(at["doc"][row]),
                        pa.array(at["row"][row]),
                        pa.array((at["a"][row] + nth).astype(np.int32)),
                        pa.array(at["query"][row].astype(bool)),
                    ],
                    names=["anchor", "window", "doc", "row", "a", "query"],
                )

    # Pieces of one document or file are spread over all tasks before they are cut into windows.
    spread = pieces.filter("heavy").repartition("anchor", "row", "a")
    rows = spread.mapInArrow(run, "anchor long, window long, doc long, row long, a int, query boolean")
    seen = (
        rows.groupBy("anchor", "window")
        .agg(F.count("*").alias("n"), F.min(F.struct("doc", "row", "a")).alias("first"))
        .filter("n > 1")
    )
    met = rows.filter("query").join(seen, ["anchor", "window"])
    if frame.keep_first:
        met = met.filter(F.struct("doc", "row", "a") != F.col("first"))
    return met.select("row", "a", F.col("a").alias("b"))


Index = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def spans(docs: DataFrame, frame: Frame, index: Index, sort: tuple[str, ...] = ()) -> DataFrame:
    """(row, text, spans) of the documents with marked units; `docs` is (doc, row, text) as `keyed` gives it.

    `spans` are disjoint, ascending [start, end) in units. `index` reads the pieces of one hash partition of anchors,
    sorted by `sort`, and returns (row, a, b): ranges of windows to be marked.
    """
    repeated = _chunks(docs, frame, False).groupBy("anchor").count().filter("count > 1").select("anchor")
    chunks = stored(_chunks(docs, frame, True).join(repeated, "anchor", "left_semi"), "chunks")
    contents = chunks.groupBy("anchor", "digest").agg(
        F.min(F.struct("doc", "row", "a")).alias("first"), F.count("*").alias("n")
    )
    kinds = contents.groupBy("anchor").agg(F.count("*").alias("kinds"), F.max("n").alias("most"))
    kinds = kinds.filter("kinds > 1 OR most > 1")
    judged = chunks.join(contents, ["anchor", "digest"]).join(kinds, "anchor")
    is_first = F.struct("doc", "row", "a") == F.col("first")
    edge = is_first & (F.col("kinds") > 1)
    if frame.keep_first:
        judged = judged.withColumns({"known": ~is_first, "edge": edge, "query": F.lit(True)})
    else:
        judged = judged.withColumns({"known": F.col("n") > 1, "edge": edge, "query": F.col("n") == 1})
    lists = (
        judged.filter("known OR edge")
        .groupBy("row")
        .agg(
            F.collect_list(F.when(F.col("known"), F.struct("a", "b"))).alias("known"),
            F.collect_list(
                F.when(F.col("edge"), F.struct("anchor", "a", "b", "query", (F.col("kinds") > HEAVY).alias("heavy")))
            ).alias("edges"),
        )
    )
    # Row numbers and ranges only; the texts stay in the numbered table and are joined where they are cut.
    marks = stored(lists, "marks")
    drop(chunks)
    pieces = stored(_pieces(docs.join(marks.filter(F.size("edges") > 0), "row"), frame), "pieces")
    light = pieces.filter("NOT heavy").repartition("anchor")
    if sort:
        light = light.sortWithinPartitions(*sort)
    marked = light.mapInArrow(index, "row long, a int, b int").unionByName(_counted(pieces, frame))
    # A document has at most one row for each of its windows here.
    more = marked.groupBy("row").agg(F.collect_list(F.struct("a", "b")).alias("more"))

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            parts = [_list(batch.column(batch.schema.get_field_index(x))) for x in ("known", "more")]
            row = np.concatenate([x for x, _ in parts])
            start, last = (np.concatenate([np.asarray(v.field(x)) for _, v in parts]).astype(np.int64) for x in "ab")
            row, start, end = _union(row, start, last + frame.size)
            sizes = np.bincount(row, minlength=batch.num_rows)
            ranges = pa.StructArray.from_arrays(
                [pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], names=["start", "end"]
            )
            ends = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            return {"spans": pa.ListArray.from_arrays(ends, ranges)}

        return work

    joined = docs.select("row", "text").join(marks.select("row", "known"), "row").join(more, "row", "left")
    kind = "array<struct<start:int,end:int>>"
    return append_columns(joined, {"spans": kind}, make, ("known", "more")).filter(F.size("spans") > 0)


def _union(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of the ranges of each row, disjoint and ascending; those that touch become one."""
    if not len(row):
        return row, start, end
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    scale = int(end.max()) + 1
    upto = np.maximum.accumulate(row * scale + end)
    new = np.r_[True, (row * scale + start)[1:] > upto[:-1]]
    new[1:] |= row[1:] != row[:-1]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(row)] - 1
    return row[first], start[first], upto[last] - row[first] * scale


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of ranges as disjoint ascending ones; those that touch become one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            if end > out[-1][1]:
                out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out
