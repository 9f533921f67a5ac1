"""Line dedup: lines that stand in several documents stay in the first of them only.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Each task puts the keys of its documents,
once for each document, into a Bloom filter of keys seen once, and keys already there into one of keys seen twice. The
filters travel as segments of set words; merged, a bit is seen twice if it is so in one task or set in two. Only lines
whose key is in the merged filter are shuffled, with their keys, and confirmed by exact grouping; the first document is
the one of the smallest id. Confirmed lines go back to their documents as line numbers.

The filters are sized from the number of lines. Up to `MAX_BITS` the merged one is broadcast; beyond that no executor need
hold it: 64-bit hashes of the keys are exchanged instead, and those that two documents share name the suspected lines.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.llm.blocks import _LOWER, _SPACE, Block, append_columns, blocks, per_document, prefix, signed, span, symbol_values
from attestry.llm.store import stored

MIN_POINTS = 10
LINE_BITS = 16
MAX_BITS = 1 << 28
SEGMENT_WORDS = 1 << 13
_VALUES = symbol_values(13, lower=True)


@dataclass
class Lines:
    """Lines of a block: byte ranges, ranges of their keys, code points of the keys, and each document's first line."""

    starts: np.ndarray
    ends: np.ndarray
    key_starts: np.ndarray
    key_ends: np.ndarray
    points: np.ndarray
    offsets: np.ndarray


def lines(block: Block) -> Lines:
    data, edges = block.data, block.offsets
    breaks = np.flatnonzero(data == 10)
    counts = np.diff(np.searchsorted(breaks, edges)) + 1
    offsets = np.r_[0, np.cumsum(counts)]
    starts, ends = np.empty(offsets[-1], np.int64), np.empty(offsets[-1], np.int64)
    inner = np.ones(offsets[-1], dtype=bool)
    inner[offsets[:-1]] = False
    starts[offsets[:-1]], starts[inner] = edges[:-1], breaks + 1
    inner[:] = True
    inner[offsets[1:] - 1] = False
    ends[offsets[1:] - 1], ends[inner] = edges[1:], breaks
    solid = np.flatnonzero(~_SPACE[data])
    low, high = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    key_starts, key_ends = starts.copy(), starts.copy()
    held = high > low
    key_starts[held], key_ends[held] = solid[low[held]], solid[high[held] - 1] + 1
    lead = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    return Lines(starts, ends, key_starts, key_ends, lead[key_ends] - lead[key_starts], offsets)


def key_hashes(block: Block, found: Lines) -> np.ndarray:
    return span(prefix(_VALUES[block.data]), found.key_starts, found.key_ends)


def word_and_bits(hashes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The word of a filter that a hash belongs to, and its four bits there."""
    bits = np.zeros(len(hashes), np.uint64)
    for shift in (40, 46, 52, 58):
        bits |= np.uint64(1) << ((hashes >> np.uint64(shift)) & np.uint64(63))
    return (hashes & np.uint64(words - 1)).astype(np.int64), bits


class Filters:
    """Words of the keys seen once and of those seen twice."""

    def __init__(self, words: int) -> None:
        self.once, self.twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)

    def add(self, hashes: np.ndarray, document: np.ndarray) -> None:
        """Add the keys of documents; a document counts once for each of its keys, and its keys come in one call."""
        order = np.lexsort((document, hashes))
        hashes, document = hashes[order], document[order]
        new = np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)]
        again = ~new & np.r_[False, document[1:] != document[:-1]][: len(hashes)]
        word, bits = word_and_bits(hashes, len(self.once))
        again |= new & ((self.once[word] & bits) == bits)
        np.bitwise_or.at(self.twice, word[again], bits[again])
        np.bitwise_or.at(self.once, word[new], bits[new])

    def merge(self, word: np.ndarray, once: np.ndarray, twice: np.ndarray) -> None:
        """Add the set words of other documents' filters."""
        self.twice[word] |= twice | (self.once[word] & once)
        self.once[word] |= once


def filter_words(n_lines: int) -> int:
    """Words of 64 bits that hold the keys of so many lines, a power of two and a whole number of segments."""
    return max(SEGMENT_WORDS, 1 << (max(n_lines, 1) * LINE_BITS - 1).bit_length() >> 6)


def twice_filter(docs: DataFrame, text: str, words: int, min_points: int) -> np.ndarray:
    """The filter of keys seen in two documents or more; at most `words` words come to the driver."""
    schema = "segment int, word binary, once binary, twice binary"

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Filters(words)
        for batch in batches:
            for block in blocks(batch.column(0)):
                found = lines(block)
                keyed = found.points >= min_points
                held.add(key_hashes(block, found)[keyed], per_document(np.diff(found.offsets))[keyed])
        cuts = [slice(i, i + SEGMENT_WORDS) for i in range(0, words, SEGMENT_WORDS)]
        yield from segments((i.start, held.once[i], held.twice[i]) for i in cuts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Filters] = {}
        for batch in batches:
            for segment, word, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if segment not in held:
                    held[segment] = Filters(SEGMENT_WORDS)
                held[segment].merge(np.frombuffer(word, "<u2"), np.frombuffer(once, "<u8"), np.frombuffer(twice, "<u8"))
        yield from segments((s * SEGMENT_WORDS, x.twice, x.twice) for s, x in held.items())

    found = docs.select(F.col(f"`{text}`")).mapInArrow(gather, schema).repartition("segment").mapInArrow(merge, schema)
    out = np.zeros(words, np.uint64)
    for row in found.select("segment", "word", "twice").collect():
        out[row[0] * SEGMENT_WORDS + np.frombuffer(row[1], "<u2").astype(np.int64)] = np.frombuffer(row[2], "<u8")
    return out


def segments(parts: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows of the set words of segments, given by first word."""
    for first, once, twice in parts:
        word = np.flatnonzero(once)
        if len(word):
            yield pa.RecordBatch.from_pydict(
                {
                    "segment": pa.array([first // SEGMENT_WORDS], pa.int32()),
                    "word": pa.array([word.astype("<u2").tobytes()], pa.binary()),
                    "once": pa.array([once[word].tobytes()], pa.binary()),
                    "twice": pa.array([twice[word].tobytes()], pa.binary()),
                }
            )


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The id, the text, and a fingerprint that tells texts of one id apart."""
    content = F.col(f"`{text}`")
    return docs.select(F.col(f"`{key}`").alias("doc"), F.xxhash64(content).alias("print"), content.alias("text"))


def _hot_hashes(rows: DataFrame, min_points: int) -> DataFrame:
    """(doc, print, suspects): the hashes of each text's keys that stand in other documents as well, by exchange."""

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            values, ends = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
            for block in blocks(batch.column(batch.schema.get_field_index("text"))):
                found = lines(block)
                keyed = np.r_[0, np.cumsum(found.points >= min_points)][found.offsets]
                values.append(signed(key_hashes(block, found)[found.points >= min_points]))
                ends.append(keyed[1:] + ends[-1][-1])
            offsets = pa.array(np.concatenate(ends).astype(np.int32))
            return {"hashes": pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(values)))}

        return work

    held = append_columns(rows, {"hashes": "array<long>"}, make, ("text",))
    held = held.select("doc", "print", F.explode(F.array_distinct("hashes")).alias("hash"))
    shared = held.groupBy("hash").agg(*_holders()).filter(_repeated()).select("hash")
    return held.join(shared, "hash").groupBy("doc", "print").agg(F.collect_set("hash").alias("suspects"))


def _holders() -> list[Column]:
    return [F.min("doc").alias("first"), F.max("doc").alias("last"), F.max(F.col("doc").isNull()).alias("null_id")]


def _repeated() -> Column:
    return (F.col("first") != F.col("last")) | (F.col("null_id") & F.col("first").isNotNull())


def suspected(docs: DataFrame, key: str, text: str, min_points: int, max_bits: int) -> DataFrame:
    """(doc, print, key, lines): the keys of each text that may stand elsewhere as well, with their line numbers."""
    spark, rows = docs.sparkSession, _rows(docs, key, text)
    content = f"`{text}`"
    n_lines = docs.select(F.sum(F.expr(f"length({content}) - length(replace({content}, '\n', '')) + 1"))).first()[0]
    words = filter_words(n_lines or 0)
    told = None
    if 64 * words <= max_bits:
        told = spark.sparkContext.broadcast(twice_filter(docs, text, words, min_points))
    else:
        hot = _hot_hashes(rows, min_points).withColumnsRenamed({"doc": "of", "print": "own"})
        rows = rows.join(hot, rows["doc"].eqNullSafe(hot["of"]) & (rows["print"] == hot["own"])).drop("of", "own")

    def make() -> Callable[[pa.RecordBatch], dict]:
        twice = told.value if told is not None else None

        def work(batch: pa.RecordBatch) -> dict:
            names = batch.schema.names
            texts = batch.column(names.index("text"))
            keys, numbers, sizes, upto = [], [], [], [np.zeros(1, np.int64)]
            for block in blocks(texts):
                found = lines(block)
                hashes, document = key_hashes(block, found), per_document(np.diff(found.offsets))
                if twice is not None:
                    word, bits = word_and_bits(hashes, len(twice))
                    chosen = (twice[word] & bits) == bits
                else:
                    chosen = np.zeros(len(hashes), dtype=bool)
                    for i, row in enumerate(batch.column(names.index("suspects")).slice(block.low, block.high - block.low)):
                        a, b = found.offsets[i], found.offsets[i + 1]
                        chosen[a:b] = np.isin(signed(hashes[a:b]), row.values.to_numpy())
                at = np.flatnonzero(chosen & (found.points >= min_points))
                at = at[np.lexsort((at, hashes[at], document[at]))]
                own, of = hashes[at], document[at]
                new = np.r_[True, (own[1:] != own[:-1]) | (of[1:] != of[:-1])][: len(at)]
                raw = _LOWER[block.data].tobytes()
                first = at[new]
                keys += [raw[a:b] for a, b in zip(found.key_starts[first].tolist(), found.key_ends[first].tolist(), strict=True)]
                numbers.append(at - found.offsets[document[at]])
                sizes.append(np.diff(np.r_[np.flatnonzero(new), len(at)]))
                upto.append(np.searchsorted(of[new], np.arange(len(found.offsets) - 1), side="right") + upto[-1][-1])
            ends = np.r_[0, np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes]))].astype(np.int32)
            numbers = np.concatenate([np.zeros(0, np.int64), *numbers]).astype(np.int32)
            held = pa.StructArray.from_arrays(
                [pa.array(keys, pa.binary()).cast(pa.string()), pa.ListArray.from_arrays(pa.array(ends), pa.array(numbers))],
                names=["key", "lines"],
            )
            return {"held": pa.ListArray.from_arrays(pa.array(np.concatenate(upto).astype(np.int32)), held)}

        return work

    kind = {"held": "array<struct<key:string,lines:array<int>>>"}
    found = append_columns(rows, kind, make, ("text", "suspects"))
    return found.select("doc", "print", F.inline("held"))


def _fresh(name: str, taken: list[str]) -> str:
    while name.lower() in {c.lower() for c in taken}:
        name = f"_{name}"
    return name


def remove(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_points: int = MIN_POINTS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """Rows of `docs` without repeated lines, with `n_lines` (before) and `n_dropped`; other columns stay.

    Texts are cut at newlines. Lines whose key has at least `min_points` code points and stands in two or more documents
    go from all but the document of the smallest id, which keeps each of its own; the other lines stay, joined by newlines.
    A document is an id: rows of one id, equal or not, keep their common lines. Rows without an id are one document that
    comes before all others. A null text has one empty line and stays null; so does an empty one. An empty table gives no
    rows. Columns named n_lines or n_dropped are replaced.
    """
    held = stored(suspected(docs, key, text, min_points, max_bits), "lines")
    # Stored, so that the join's sides are shuffles of their own and a hot key can be split at run time.
    firsts = stored(held.groupBy("key").agg(*_holders()).filter(_repeated()), "firsts")
    later = F.col("doc").isNotNull() & (F.col("null_id") | (F.col("doc") != F.col("first")))
    gone = held.join(firsts, "key").filter(later).groupBy("doc", "print").agg(F.flatten(F.collect_set("lines")).alias("gone"))
    mark, drop = _fresh("__print", docs.columns), _fresh("__gone", docs.columns)
    doc, of = _fresh("__doc", docs.columns), _fresh("__of", docs.columns)
    gone = gone.select(F.col("doc").alias(doc), F.col("print").alias(of), F.col("gone").alias(drop)).hint("shuffle_hash")
    rows = docs.withColumn(mark, F.xxhash64(F.col(f"`{text}`")))
    rows = rows.join(gone, (rows[f"`{key}`"] == gone[doc]) & (rows[mark] == gone[of]), "left").drop(doc, of)

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            texts, lists = (batch.column(batch.schema.get_field_index(x)) for x in (text, drop))
            out, before, dropped = texts.to_pylist(), [], []
            for block in blocks(texts):
                found = lines(block)
                before.append(np.diff(found.offsets))
                for i in range(block.low, block.high):
                    numbers = lists[i].values
                    dropped.append(0 if numbers is None else len(numbers))
                    if dropped[-1]:
                        a, b = found.offsets[i - block.low], found.offsets[i - block.low + 1]
                        stay = np.ones(b - a, dtype=bool)
                        stay[numbers.to_numpy()] = False
                        at = a + np.flatnonzero(stay)
                        spans = zip(found.starts[at].tolist(), found.ends[at].tolist(), strict=True)
                        out[i] = b"\n".join([block.data[x:y].tobytes() for x, y in spans]).decode()
            return {
                text: pa.array(out, pa.string()),
                "n_lines": pa.array(np.concatenate(before)),
                "n_dropped": pa.array(dropped, pa.int64()),
            }

        return work

    # The text is replaced: it is read under its name and returned under the same.
    return append_columns(rows, {text: "string", "n_lines": "long", "n_dropped": "long"}, make, (text, mark, drop))
