"""Token-id files of patched frame-of-reference blocks.

A payload holds the ids of many documents as blocks of 128: the block's minimum is taken off, the rest is bit-packed at a
width that covers a given share of the block (`PERCENTILE`), and the high bits of larger values stand in an exception
list (position, rest). An index of where blocks start lets a reader decode any of them alone.

    payload  = magic "PFOR1", ids (u8), blocks (u4), index (u4 for each block: start in the body), body
    block    = minimum (u4), width (u1), exceptions (u1), packed bits (16 * width bytes), positions (u1 each), rests (u4)

All numbers are little-endian. The files are rows in Parquet, one row for each payload: its place in the order of keys
(`part`, `seq`), the keys and id counts of its documents, the ids before it in its part, and the payload.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm.blocks import blocks
from attestry.llm.tokens import ENCODE_BYTES, encoder, with_end

MAGIC = b"PFOR1"
BLOCK = 128
PERCENTILE = 95
_HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("odd", "u1")])
SCHEMA = (
    "part long, seq long, before long, n_ids long, docs array<long>, null_docs array<boolean>, "
    "counts array<long>, payload binary"
)


def _width(x: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.where(x > 0, np.floor(np.log2(np.maximum(x, 1))).astype(np.int64) + 1, 0)


def encode(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """The payload of 32-bit ids."""
    n = len(ids)
    count = -(-n // BLOCK)
    table = np.zeros((count, BLOCK), np.int64)
    table.ravel()[:n] = ids
    if n % BLOCK:
        table[-1, n % BLOCK :] = table[-1, : n % BLOCK].min()
    low = table.min(axis=1) if count else np.zeros(0, np.int64)
    table -= low[:, None]
    ranked = np.partition(table, int(np.ceil(BLOCK * percentile / 100)) - 1, axis=1) if count else table
    width = _width(ranked[:, int(np.ceil(BLOCK * percentile / 100)) - 1]) if count else np.zeros(0, np.int64)
    odd = (table >> width[:, None]) > 0
    odds = odd.sum(axis=1)
    head = np.zeros(count, _HEAD)
    head["low"], head["width"], head["odd"] = low, width, odds
    size = _HEAD.itemsize + BLOCK // 8 * width + 5 * odds
    start = np.r_[0, np.cumsum(size)].astype(np.int64)
    body = np.zeros(start[-1], np.uint8)
    for i in range(_HEAD.itemsize):
        body[start[:-1] + i] = head.view(np.uint8).reshape(count, -1)[:, i] if count else 0
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        bits = ((table[rows][:, :, None] >> np.arange(w)) & 1).astype(np.uint8)
        packed = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
        body[start[rows][:, None] + _HEAD.itemsize + np.arange(packed.shape[1])] = packed
    row, position = np.nonzero(odd)
    if len(row):
        nth = np.arange(len(row)) - np.r_[0, np.cumsum(odds)][row]
        at = start[row] + _HEAD.itemsize + BLOCK // 8 * width[row]
        body[at + nth] = position
        rest = (table[row, position] >> width[row]).astype("<u4")
        body[(at + odds[row] + 4 * nth)[:, None] + np.arange(4)] = rest.view(np.uint8).reshape(-1, 4)
    head_bytes = MAGIC + np.array([n], "<u8").tobytes() + np.array([count], "<u4").tobytes()
    return head_bytes + start[:-1].astype("<u4").tobytes() + body.tobytes()


class Reader:
    """Decodes a payload, whole or by block."""

    def __init__(self, payload: bytes) -> None:
        if payload[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token-id payload")
        raw, at = np.frombuffer(payload, np.uint8), len(MAGIC)
        self.n = int(np.frombuffer(payload, "<u8", 1, at)[0])
        self.count = int(np.frombuffer(payload, "<u4", 1, at + 8)[0])
        at += 12
        self.start = np.frombuffer(payload, "<u4", self.count, at).astype(np.int64)
        self.body = raw[at + 4 * self.count :]

    def blocks(self, chosen: np.ndarray) -> np.ndarray:
        """The ids of the chosen blocks, one row for each (the last block's row is padded)."""
        start = self.start[chosen]
        head = self.body[start[:, None] + np.arange(_HEAD.itemsize)].copy().view(_HEAD).ravel()
        width, odds = head["width"].astype(np.int64), head["odd"].astype(np.int64)
        out = np.zeros((len(chosen), BLOCK), np.int64)
        for w in np.unique(width[width > 0]):
            rows = np.flatnonzero(width == w)
            packed = self.body[start[rows][:, None] + _HEAD.itemsize + np.arange(BLOCK // 8 * w)]
            bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(rows), BLOCK, w)
            wide = np.zeros((len(rows), BLOCK, 8 * (-(-int(w) // 8))), np.uint8)
            wide[:, :, :w] = bits
            held = np.packbits(wide, axis=2, bitorder="little")
            value = np.zeros((len(rows), BLOCK), np.int64)
            for i in range(held.shape[2]):
                value |= held[:, :, i].astype(np.int64) << (8 * i)
            out[rows] = value
        row = np.repeat(np.arange(len(chosen)), odds)
        if len(row):
            nth = np.arange(len(row)) - np.r_[0, np.cumsum(odds)][row]
            at = start[row] + _HEAD.itemsize + BLOCK // 8 * width[row]
            rest = self.body[(at + odds[row] + 4 * nth)[:, None] + np.arange(4)].copy().view("<u4").ravel()
            out[row, self.body[at + nth]] |= rest.astype(np.int64) << width[row]
        return out + head["low"].astype(np.int64)[:, None]

    def ids(self) -> np.ndarray:
        return self.blocks(np.arange(self.count)).ravel()[: self.n].astype("<u4")

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids [start, stop), decoding only the blocks that hold them."""
        first, last = start // BLOCK, -(-stop // BLOCK)
        return self.blocks(np.arange(first, last)).ravel()[start - first * BLOCK : stop - first * BLOCK].astype("<u4")


def write(docs: DataFrame, folder: str, path: str, end: int, key: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all texts, each closed by `end`, in ascending order of the key (nulls first).

    Null texts count as empty; rows of equal key are ordered by text. `path` is the tokenizer's file. Parts are ranges of
    keys, and payloads of a part hold about `ENCODE_BYTES` of text.
    """
    ordered = (
        docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
        .repartitionByRange("key")
        .sortWithinPartitions("key", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, part = encoder(path).encode, TaskContext.get().partitionId()
        seq = before = 0
        for batch in batches:
            for block in blocks(batch.column(1), ENCODE_BYTES):
                ids, offsets = with_end(*work(block), end)
                keys = batch.column(0).slice(block.low, block.high - block.low)
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part], pa.int64()),
                        "seq": pa.array([seq], pa.int64()),
                        "before": pa.array([before], pa.int64()),
                        "n_ids": pa.array([len(ids)], pa.int64()),
                        "docs": pa.array([keys.fill_null(0).to_numpy()], pa.list_(pa.int64())),
                        "null_docs": pa.array([keys.is_null().to_pylist()], pa.list_(pa.bool_())),
                        "counts": pa.array([np.diff(offsets)], pa.list_(pa.int64())),
                        "payload": pa.array([encode(ids)], pa.binary()),
                    }
                )
                seq, before = seq + 1, before + len(ids)

    ordered.mapInArrow(run, SCHEMA).write.parquet(folder)


def read(spark: SparkSession, folder: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32), `ids` if asked for, of each document in the files.

    Only the ids' numbers in each part come to the driver; they place the parts one after the other.
    """
    files = spark.read.schema(SCHEMA).parquet(folder)
    sizes = sorted(files.groupBy("part").agg(F.sum("n_ids")).collect())
    first, upto = {}, 0
    for part, n in sizes:
        first[part], upto = upto, upto + n
    shared = spark.sparkContext.broadcast(first)
    fields: dict[str, str] = {key: "long", "start": "long", "n_tokens": "long", "ids_crc32": "long"}
    fields |= {"ids": "binary"} if with_ids else {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                at = {name: batch.column(name)[row] for name in batch.schema.names}
                ids = Reader(at["payload"].as_py()).ids()
                counts = at["counts"].values.to_numpy(zero_copy_only=False)
                offsets = np.r_[0, np.cumsum(counts)]
                raw = memoryview(ids.tobytes())
                spans = list(zip((4 * offsets[:-1]).tolist(), (4 * offsets[1:]).tolist(), strict=True))
                missing = at["null_docs"].values.to_numpy(zero_copy_only=False).astype(bool)
                out = [
                    pa.array(at["docs"].values.to_numpy(zero_copy_only=False), mask=missing),
                    pa.array(shared.value[at["part"].as_py()] + at["before"].as_py() + offsets[:-1]),
                    pa.array(counts),
                    pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64()),
                ]
                if with_ids:
                    out.append(pa.array([bytes(raw[a:b]) for a, b in spans], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names=list(fields))

    columns = files.select("part", "before", "docs", "null_docs", "counts", "payload")
    return columns.mapInArrow(run, ", ".join(f"`{name}` {kind}" for name, kind in fields.items()))
