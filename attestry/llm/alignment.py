"""Alignment of two tokenizers' ids over the same texts, and how well known each aligned pair is in the corpus.

A text is encoded twice, by a byte-level BPE file (A) and by a piece model (B) that puts a space before the text; A gets that
space as well. Both id lists then tile the same bytes. The ends of each list's tokens are looked up by byte offset, in a
table from end to index; offsets in both tables are the common ends, and two common ends in a row slice both id lists into
a group. Inside a group every A-B pair whose bytes overlap is a link: links are expanded slice by slice, as the pieces that
the ends of either list cut the group into.

A pair's count is the number of documents that hold it linked. Counting and scoring work on one row of distinct pairs for
each document, stored once. The counts are broadcast while there are at most `BROADCAST_PAIRS` of them (vocabularies bound
them, the corpus does not); beyond that the links are joined with them by shuffle.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attestry.llm.blocks import Block, blocks, per_document, prefix, span, symbol_values
from attestry.llm.store import stored
from attestry.llm.tokens import CACHED_PIECES, ENCODE_BYTES, Encoder, encoder

BROADCAST_PAIRS = 1 << 21
FIELDS = {
    "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long",
    "groups": "string", "pairs": "array<long>", "times": "array<int>",
}
SUMS = ("n_best", "count_sum")


class TokenBytes:
    """The bytes of each id, as one array and offsets."""

    def __init__(self, held: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(held), np.uint8)
        self.sizes = np.array([len(x) for x in held], np.int64)
        self.starts = np.r_[0, np.cumsum(self.sizes)[:-1]]

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        upto = np.r_[0, np.cumsum(sizes)]
        return self.data[np.repeat(self.starts[ids] - upto[:-1], sizes) + np.arange(upto[-1])]


def byte_level(held: Encoder) -> TokenBytes:
    """Bytes of the entries of a byte-level vocabulary."""
    byte = {chr(c): b for b, c in enumerate(held.shown.tolist())}
    vocabulary = held.library.get_vocab()
    shown = [""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        shown[i] = entry
    return TokenBytes([bytes(byte[c] for c in x) if all(c in byte for c in x) else x.encode() for x in shown])


class PieceModel:
    """Encodes texts that begin with a space by a piece model that adds it.

    Pieces that join a space to what stands before it don't exist in the model, so a text can be cut before each run of
    spaces; each distinct cut is encoded once. The half of the cuts that was used most is remembered when there are too
    many. A model with other pieces gets whole texts.
    """

    def __init__(self, path: str, cached: int = CACHED_PIECES) -> None:
        import sentencepiece

        self.model, self.cached = sentencepiece.SentencePieceProcessor(model_file=path), cached
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.cuts = not any("▁" in x.lstrip("▁") for x in pieces)
        self.bytes = TokenBytes(
            [
                bytes([int(x[3:5], 16)]) if self.model.is_byte(i) else x.replace("▁", " ").encode()
                for i, x in enumerate(pieces)
            ]
        )
        self.space = self.model.piece_to_id("▁")
        self.known, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.at, self.size, self.uses = (np.zeros(0, np.int64) for _ in range(3))
        self.same = np.zeros(0, dtype=bool)

    def _encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, their number for each text, and whether they give the text's bytes."""
        found = self.model.encode([x[1:].decode("utf-8", "replace") for x in texts], num_threads=1)
        # The model adds no space to an empty text; here a last single space stands behind other cuts.
        found = [[self.space] if x == b" " else ids for x, ids in zip(texts, found, strict=True)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for x in found for i in x), np.int32, int(size.sum()))
        joined, upto = self.bytes.joined(ids).tobytes(), np.r_[0, np.cumsum(self.bytes.sizes[ids])]
        edges = upto[np.r_[0, np.cumsum(size)]].tolist()
        same = [joined[a:b] == x for a, b, x in zip(edges[:-1], edges[1:], texts, strict=True)]
        return ids, size, np.array(same, dtype=bool)

    def _remember(self, hashes: np.ndarray, texts: list[bytes]) -> None:
        ids, size, same = self._encode(texts)
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        at = len(self.ids) + np.r_[0, np.cumsum(size)[:-1]]
        self.known, self.ids = known[order], np.concatenate([self.ids, ids])
        self.at, self.size = np.concatenate([self.at, at])[order], np.concatenate([self.size, size])[order]
        self.same = np.concatenate([self.same, same])[order]
        self.uses = np.concatenate([self.uses, np.zeros(len(size), np.int64)])[order]

    def _forget(self) -> None:
        keep = np.sort(np.argsort(-self.uses, kind="stable")[: self.cached // 2])
        size, at = self.size[keep], self.at[keep]
        new = np.r_[0, np.cumsum(size)]
        self.ids = self.ids[np.repeat(at - new[:-1], size) + np.arange(new[-1])]
        self.known, self.at, self.size, self.same = self.known[keep], new[:-1], size, self.same[keep]
        self.uses = self.uses[keep] // 2

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all documents in one array, the documents' offsets in it, and whether their bytes are the text's."""
        data, edges = block.data, block.offsets
        n = len(edges) - 1
        begins = np.zeros(len(data) + 1, dtype=bool)
        if self.cuts:
            blank = data == 0x20
            begins[:-1] = blank & ~np.r_[False, blank[:-1]][: len(data)]
        begins[edges] = True
        starts = np.flatnonzero(begins[:-1])
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64), np.ones(n, dtype=bool)
        ends = np.r_[starts[1:], len(data)]
        hashes = span(prefix(symbol_values(11)[data]), starts, ends)
        keys, first, cut = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, keys)
        missing = np.ones(len(keys), dtype=bool)
        inside = at < len(self.known)
        missing[inside] = self.known[at[inside]] != keys[inside]
        if missing.any():
            low, raw = first[missing], data.tobytes()
            texts = [raw[a:b] for a, b in zip(starts[low].tolist(), ends[low].tolist(), strict=True)]
            self._remember(keys[missing], texts)
            at = np.searchsorted(self.known, keys)
        self.uses[at] += 1
        at = at[cut]
        size = self.size[at]
        total = np.r_[0, np.cumsum(size)]
        ids = self.ids[np.repeat(self.at[at] - total[:-1], size) + np.arange(total[-1])]
        offsets = np.searchsorted(starts, edges)
        wrong = np.r_[0, np.cumsum(~self.same[at])]
        if len(self.known) > self.cached:
            self._forget()
        return ids, total[offsets], wrong[offsets[1:]] == wrong[offsets[:-1]]


class Aligner:
    """Aligns blocks of texts; one for each Python worker and pair of files."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = encoder(path_a, plain=True), PieceModel(path_b)
        self.bytes = byte_level(self.a)
        self.scale = len(self.b.bytes.sizes)
        most = max(len(self.bytes.sizes), self.scale)
        # A row for each id: its digits, and a place for the separator after it.
        width = len(str(most - 1))
        digits = np.array([str(i) for i in range(most)], f"S{width}").view(np.uint8).reshape(most, width)
        self.shown = np.concatenate([digits, np.zeros((most, 1), np.uint8)], axis=1)

    def _same_bytes(self, ids: np.ndarray, offsets: np.ndarray, block: Block) -> np.ndarray:
        """Which documents have the block's bytes, joined from their tokens."""
        joined = self.bytes.joined(ids)
        edges = np.r_[0, np.cumsum(self.bytes.sizes[ids])][offsets]
        if len(joined) == len(block.data) and (edges == block.offsets).all() and (joined == block.data).all():
            return np.ones(len(offsets) - 1, dtype=bool)
        spans = zip(edges[:-1], edges[1:], block.offsets[:-1], block.offsets[1:], strict=True)
        return np.array([np.array_equal(joined[a:b], block.data[c:d]) for a, b, c, d in spans], dtype=bool)

    def __call__(self, block: Block) -> dict[str, pa.Array]:
        """The columns of a block of texts that each have a space before them (texts without tokens are empty)."""
        ids_a, off_a = self.a.encode(block)
        ids_b, off_b, good = self.b.encode(block)
        good &= self._same_bytes(ids_a, off_a, block) & (block.lengths > 0)
        n_a, n_b = np.diff(off_a), np.diff(off_b)
        if not good.all():
            ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
            n_a, n_b = n_a * good, n_b * good
        ids_a, ids_b = ids_a.astype(np.int64), ids_b.astype(np.int64)
        ends_a, ends_b = np.cumsum(self.bytes.sizes[ids_a]), np.cumsum(self.b.bytes.sizes[ids_b])
        total = int(ends_a[-1]) if len(ends_a) else 0
        doc_ends = np.cumsum(block.lengths * good)
        # Tables from end to index, addressed by the byte offset.
        index_a, index_b = np.full(total + 1, -1, np.int32), np.full(total + 1, -1, np.int32)
        index_a[ends_a], index_b[ends_b] = np.arange(len(ends_a)), np.arange(len(ends_b))
        common = np.flatnonzero((index_a >= 0) & (index_b >= 0))
        n_groups = np.diff(np.r_[0, np.searchsorted(common, doc_ends, side="right")])
        either = np.flatnonzero((index_a >= 0) | (index_b >= 0))
        n_links = np.diff(np.r_[0, np.searchsorted(either, doc_ends, side="right")])
        closes_a, closes_b = index_a[either] >= 0, index_b[either] >= 0
        left = ids_a[np.cumsum(closes_a) - closes_a]
        right = ids_b[np.cumsum(closes_b) - closes_b]
        pairs, times, held = self._distinct(left * self.scale + right, n_links)
        return {
            "n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(n_groups), "n_links": pa.array(n_links),
            "groups": self._written(ids_a, ids_b, index_a[common] + 1, index_b[common] + 1, n_a + n_b),
            "pairs": pa.ListArray.from_arrays(pa.array(held), pa.array(pairs)),
            "times": pa.ListArray.from_arrays(pa.array(held), pa.array(times)),
        }

    @staticmethod
    def _distinct(pairs: np.ndarray, n_links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The documents' distinct pairs, how often each is linked there, and the documents' offsets."""
        document = per_document(n_links)
        order = np.sort((document << 40) | pairs)
        first = np.flatnonzero(np.r_[True, order[1:] != order[:-1]][: len(order)])
        times = np.diff(np.r_[first, len(order)]).astype(np.int32)
        offsets = np.r_[0, np.cumsum(np.bincount(order[first] >> 40, minlength=len(n_links)))]
        return order[first] & ((1 << 40) - 1), times, offsets.astype(np.int32)

    def _written(self, a: np.ndarray, b: np.ndarray, upto_a: np.ndarray, upto_b: np.ndarray, n: np.ndarray) -> pa.Array:
        """The groups of each document as text: `a1,a2|b1;a3|b2,b3`."""
        sizes_a, sizes_b = np.diff(np.r_[0, upto_a]), np.diff(np.r_[0, upto_b])
        at_a = np.arange(len(a)) + np.repeat(upto_b - sizes_b, sizes_a)
        at_b = np.arange(len(b)) + np.repeat(upto_a, sizes_b)
        ids = np.empty(len(a) + len(b), np.int64)
        ids[at_a], ids[at_b] = a, b
        rows = self.shown[ids]
        rows[:, -1] = ord(",")
        rows[at_a[upto_a - 1], -1] = ord("|")
        rows[at_b[upto_b - 1], -1] = ord(";")
        ends = np.cumsum(n)
        rows[ends[n > 0] - 1, -1] = 0
        filled = rows != 0
        sizes = np.r_[0, np.cumsum(filled.sum(axis=1))]
        offsets = pa.py_buffer(sizes[np.r_[0, ends]].astype(np.int32))
        return pa.StringArray.from_buffers(len(n), offsets, pa.py_buffer(rows[filled].tobytes()))


_MADE: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _MADE:
        _MADE[path_a, path_b] = Aligner(path_a, path_b)
    return _MADE[path_a, path_b]


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", drop: tuple = ()) -> DataFrame:
    """Rows of `docs` with their alignment; nothing is shuffled.

    `n_a`, `n_b`: tokens; `n_groups`; `n_links`; `groups`: decimal ids as `a1,a2|b1;a3|b2,b3`; `pairs`: the distinct linked
    pairs, each A id * B vocabulary + B id, ascending; `times`: how often each is linked. Strings of special tokens are
    plain text. Null and empty texts, and texts whose tokens don't give their bytes back, have no tokens: zeros, an empty
    text, empty arrays. Each row stands for itself, whatever its key; an empty table gives no rows. Columns named as the
    new ones are replaced, those in `drop` left out.
    """
    kept = [c for c in docs.columns if c.lower() not in FIELDS and c not in drop]
    schema = T.StructType([docs.schema[c] for c in kept])
    for name, kind in FIELDS.items():
        schema = schema.add(name, T._parse_datatype_string(kind))
    content = F.col(f"`{text}`")
    # Texts with tokens, with the space before them, come as the last column.
    spaced = F.when(F.length(content) > 0, F.concat(F.lit(" "), content))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = aligner(path_a, path_b)
        for batch in batches:
            for block in blocks(batch.column(len(kept)), ENCODE_BYTES):
                new = work(block)
                own = [batch.column(i).slice(block.low, block.high - block.low) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*own, *(new[c] for c in FIELDS)], names=[*kept, *FIELDS])

    return docs.select(*(F.col(f"`{c}`") for c in kept), spaced.alias("__spaced")).mapInArrow(run, schema)


def pair_counts(links: DataFrame, scale: int) -> DataFrame:
    """(pair, n_docs, best): the documents that hold a pair, and whether no pair of its A id is in more."""
    counts = links.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n_docs"))
    counts = stored(counts.withColumn("a", F.expr(f"pair div {scale}")), "pairs")
    # One row for each A id: at most as many as the vocabulary has.
    most = counts.groupBy("a").agg(F.max("n_docs").alias("most"))
    return counts.join(F.broadcast(most), "a").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def _sums_by_lookup(links: DataFrame, counts: DataFrame) -> DataFrame:
    """(row, n_best, count_sum) by a broadcast table of all counts, sorted by pair."""
    table = counts.orderBy("pair").toArrow()
    columns = [table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("pair", "n_docs", "best")]
    shared = links.sparkSession.sparkContext.broadcast(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n_docs, best = shared.value
        for batch in batches:
            row, pairs, times = (batch.column(i) for i in range(3))
            at = np.searchsorted(known, pairs.flatten().to_numpy())
            held = times.flatten().to_numpy().astype(np.int64)
            upto = np.r_[0, np.cumsum(pairs.value_lengths().to_numpy())]
            sums = [np.r_[0, np.cumsum(held * x[at])][upto] for x in (best, n_docs)]
            yield pa.RecordBatch.from_arrays([row, *(pa.array(np.diff(x)) for x in sums)], names=["row", *SUMS])

    return links.select("row", "pairs", "times").mapInArrow(run, "row long, n_best long, count_sum long")


def _sums_by_join(links: DataFrame, counts: DataFrame) -> DataFrame:
    """(row, n_best, count_sum) by a shuffle of the links; a hot pair is split at run time."""
    each = links.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    joined = each.join(counts, "pair").select(
        "row", F.when(F.col("best"), F.col("times")).otherwise(0).cast("long").alias("n_best"),
        (F.col("times") * F.col("n_docs")).alias("count_sum"),
    )
    return joined.groupBy("row").agg(*(F.sum(c).alias(c) for c in SUMS))


def score(links: DataFrame, scale: int, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Rows of `links` (a stored table with a `row` number of its own for each row) with `n_best`, the links whose count is
    the highest of their A id, and `count_sum`, the sum of the counts over the links; 0 without links."""
    counts = stored(pair_counts(links, scale), "counts")
    small = counts.count() <= broadcast_pairs
    sums = (_sums_by_lookup if small else _sums_by_join)(links, counts)
    out = links.drop("pairs", "times", *SUMS).join(sums, "row", "left").drop("row")
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in SUMS})


def numbered_links(aligned: DataFrame) -> DataFrame:
    """The stored alignment with a number for each row."""
    return stored(aligned.withColumn("row", F.monotonically_increasing_id()), "links")


def vocabulary(path: str) -> int:
    """The number of ids of a piece model."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=os.fspath(path)).get_piece_size()
