"""Packing of token sequences by shortest-pack-first over the length histogram.

Documents become ids and are cut at the sequence length; the last piece of a document is what is left over. The histogram
of piece lengths, at most one bin for each length, is packed on the driver: lengths are placed longest first, each into
the packs with the most room (a pack is a pattern of lengths with the number of sequences that follow it), and only
pieces without a pack with room open new ones. Pieces then find their place by rank: the k-th piece of a length takes the
k-th slot of that length in the patterns. Ranks are counted within scan partitions and shifted by the counts of the
partitions before, so no length is gathered in one task.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attestry.llm.blocks import append_columns, blocks, per_document
from attestry.llm.store import stored
from attestry.llm.tokens import ENCODE_BYTES, encoder, with_end

SEQUENCE = 1024
END_ID = 0
_PIECES = "array<struct<start:long,length:int,rank:long,ids_crc32:long{ids}>>"


@dataclass
class Plan:
    """Slots of each length, in order of rank: `upto` is the number of pieces in this slot and those before of its length,
    `first` the sequence of its first piece, `offset` the place inside the sequences."""

    length: np.ndarray
    upto: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces."""
        # Slots are sorted by (length, upto), so one search finds both.
        scale = int(self.upto.max(initial=0)) + 1
        at = np.searchsorted(self.length * scale + self.upto, length * scale + rank, side="right")
        same = (at > 0) & (self.length[at - 1] == length)
        before = np.where(same, self.upto[at - 1], 0)
        return self.first[at] + rank - before, self.offset[at]


def shortest_pack_first(counts: dict[int, int], size: int = SEQUENCE) -> Plan:
    """Pack a histogram {length: pieces}; lengths are 1 to `size`."""
    packs: list[tuple[int, int, tuple[int, ...], int]] = []  # (-room, order, lengths, sequences)
    done, order = [], 0
    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        left = counts[length]
        while left and packs and -packs[0][0] >= length:
            room, _, lengths, n = heapq.heappop(packs)
            take = min(n, left)
            left -= take
            if take < n:
                order += 1
                heapq.heappush(packs, (room, order, lengths, n - take))
            order += 1
            heapq.heappush(packs, (room + length, order, (*lengths, length), take))
        if left:
            order += 1
            heapq.heappush(packs, (length - size, order, (length,), left))
    done = sorted(packs, key=lambda p: (p[2], p[1]), reverse=True)
    rows, first = [], 0
    for _, _, lengths, n in done:
        offset = 0
        for length in lengths:
            rows.append((length, n, first, offset))
            offset += length
        first += n
    rows.sort(key=lambda r: (r[0], r[2], r[3]))
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    upto = table[:, 1].copy()
    for length in np.unique(table[:, 0]):
        own = table[:, 0] == length
        upto[own] = np.cumsum(upto[own])
    return Plan(table[:, 0], upto, table[:, 2], table[:, 3], first)


def cut_pieces(docs: DataFrame, path: str, text: str, size: int, end: int, with_ids: bool) -> DataFrame:
    """Rows of `docs` without the text, with `doc_tokens`, the scan partition and the pieces."""
    kind = _PIECES.format(ids=",ids:binary" if with_ids else "")

    def make() -> Callable[[pa.RecordBatch], dict]:
        encode, part = encoder(path).encode, TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)

        def work(batch: pa.RecordBatch) -> dict:
            columns: dict[str, list] = {x: [] for x in ("start", "length", "rank", "crc", "ids")}
            tokens, pieces = [], [np.zeros(1, np.int64)]
            for block in blocks(batch.column(batch.schema.get_field_index(text)), ENCODE_BYTES):
                ids, offsets = with_end(*encode(block), end)
                total = np.diff(offsets)
                count = -(-total // size)
                doc = per_document(count)
                upto = np.r_[0, np.cumsum(count)]
                start = (np.arange(upto[-1]) - upto[doc]) * size
                length = np.minimum(size, total[doc] - start)
                order = np.argsort(length, kind="stable")
                rank = np.empty(len(length), np.int64)
                held = np.bincount(length, minlength=size + 1)
                rank[order] = np.arange(len(length)) - np.repeat(np.r_[0, np.cumsum(held)[:-1]], held)
                rank += seen[length]
                seen[:] += held
                raw = memoryview(ids.astype("<u4").tobytes())
                lows = 4 * (offsets[doc] + start)
                spans = list(zip(lows.tolist(), (lows + 4 * length).tolist(), strict=True))
                columns["crc"] += [zlib.crc32(raw[a:b]) for a, b in spans]
                if with_ids:
                    columns["ids"] += [bytes(raw[a:b]) for a, b in spans]
                for name, value in (("start", start), ("length", length), ("rank", rank)):
                    columns[name].append(value)
                tokens.append(total)
                pieces.append(upto[1:] + pieces[-1][-1])
            fields = {
                "start": pa.array(np.concatenate(columns["start"])),
                "length": pa.array(np.concatenate(columns["length"]).astype(np.int32)),
                "rank": pa.array(np.concatenate(columns["rank"])),
                "ids_crc32": pa.array(columns["crc"], pa.int64()),
            }
            if with_ids:
                fields["ids"] = pa.array(columns["ids"], pa.binary())
            ends = pa.array(np.concatenate(pieces).astype(np.int32))
            return {
                "doc_tokens": pa.array(np.concatenate(tokens)),
                "__part": pa.array(np.full(batch.num_rows, part, np.int64)),
                "__pieces": pa.ListArray.from_arrays(
                    ends, pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
                ),
            }

        return work

    return append_columns(docs, {"doc_tokens": "long", "__part": "long", "__pieces": kind}, make, (text,))


def pack(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    size: int = SEQUENCE,
    end: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """A row for each piece: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset), `ids` if asked for.

    A null text counts as empty: its one piece is the end id. Rows are documents: repeated keys and null keys are packed
    each on its own. An empty table gives no rows.
    """
    cut = stored(cut_pieces(docs.select(key, text), path, text, size, end, with_ids), "pieces")
    rows = cut.select(key, "doc_tokens", "__part", F.inline("__pieces"))
    # At most one row for each partition and length.
    held = rows.groupBy("length", "__part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shift = held.select("length", "__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__shift"))
    plan = shortest_pack_first({r[0]: r[1] for r in held.groupBy("length").agg(F.sum("n")).collect()}, size)
    shared = docs.sparkSession.sparkContext.broadcast(plan)

    def make() -> Callable[[pa.RecordBatch], dict]:
        held = shared.value

        def work(batch: pa.RecordBatch) -> dict:
            at = {x: batch.column(x).to_numpy(zero_copy_only=False) for x in ("length", "rank", "__shift")}
            sequence, offset = held.place(at["length"].astype(np.int64), at["rank"] + at["__shift"])
            return {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}

        return work

    placed = append_columns(
        rows.join(shift, ["length", "__part"]), {"sequence_id": "long", "offset": "long"}, make
    )
    ids = ["ids"] if with_ids else []
    return placed.select(
        key, "start", F.col("length").cast("long"), "ids_crc32", "doc_tokens", "sequence_id", "offset", *ids
    )
