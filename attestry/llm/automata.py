"""Substring deduplication of words with suffix automata.

Reading a text through the automaton of a reference gives its matching statistics: at each word, the length of the longest
run ending there that the reference holds. Runs of at least the window size are removed.

`remove_known` takes out what a given reference holds: its shards, each of bounded size, become automata that are
broadcast one after the other while the documents stream past them. `later_spans` removes from a corpus what stands
earlier in itself. There the reference grows with the documents, and to broadcast it would not do at any larger size:
the shards are the groups of equal anchors in `repeats`, which are co-partitioned with the text they can match. Their
automata are built online, in document order; after each word, the suffix link's length is the longest run ending there
that was seen before.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm import repeats
from attestry.llm.blocks import append_columns

SIZE = 20
ANCHOR = 7
SHARD_WORDS = 200_000


class Automaton:
    """A suffix automaton over hashable symbols, built online."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self.last = 0

    def extend(self, symbol) -> int:
        """Append a symbol; the length of the longest run ending here that was there before."""
        nxt, link, length = self.next, self.link, self.length
        now, at = len(nxt), self.last
        nxt.append({})
        length.append(length[at] + 1)
        link.append(0)
        while at != -1 and symbol not in nxt[at]:
            nxt[at][symbol] = now
            at = link[at]
        if at != -1:
            to = nxt[at][symbol]
            if length[at] + 1 == length[to]:
                link[now] = to
            else:
                copy = len(nxt)
                nxt.append(dict(nxt[to]))
                length.append(length[at] + 1)
                link.append(link[to])
                while at != -1 and nxt[at].get(symbol) == to:
                    nxt[at][symbol] = copy
                    at = link[at]
                link[to] = link[now] = copy
        self.last = now
        return length[link[now]]

    def statistics(self, symbols: list) -> list[int]:
        """At each symbol, the length of the longest run ending there that the automaton holds."""
        nxt, link, length = self.next, self.link, self.length
        out, at, matched = [], 0, 0
        for symbol in symbols:
            while at and symbol not in nxt[at]:
                at = link[at]
                matched = length[at]
            if symbol in nxt[at]:
                at = nxt[at][symbol]
                matched += 1
            out.append(matched)
        return out


def index(size: int) -> repeats.Index:
    """An automaton for each anchor; its pieces come in document order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, automaton, separators = None, Automaton(), 0
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            columns = (batch.column(x).to_pylist() for x in ("anchor", "row", "a", "body"))
            for anchor, row, a, body in zip(*columns, strict=True):
                if anchor != now:
                    now, automaton = anchor, Automaton()
                extend = automaton.extend
                seen = [extend(word) for word in body.split()]
                out += [(row, a + i - size + 1, a + i - size + 1) for i, n in enumerate(seen) if n >= size]
                separators += 1
                extend(separators)  # an integer: no word, and another one each time
            if out:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(x), kind)
                        for x, kind in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32()), strict=True)
                    ],
                    names=["row", "a", "b"],
                )

    return run


def later_spans(rows: DataFrame, size: int = SIZE) -> DataFrame:
    """(row, text, spans): ranges of words covered by a window of `size` words that also starts earlier.

    `rows` is (doc, row, text). Earlier is a smaller key (a null key is the smallest, and `doc` the smallest long), of
    equal keys a smaller row number, or an earlier place of the same row. Null and short texts have no window.
    """
    frame = repeats.Frame(by_words=True, size=size, anchor=max(1, size * ANCHOR // SIZE), keep_first=True)
    return repeats.spans(rows, frame, index(size), ("anchor", "doc", "row", "a"))


def _kept(found: list[bytes], spans: list[dict]) -> list[bytes]:
    out, at = [], 0
    for x in spans:
        out += found[at : x["start"]]
        at = max(at, x["end"])
    return out + found[at:]


def _split(body: str | None) -> list[bytes]:
    # bytes.split() cuts at the six ASCII white-space bytes only.
    return (body or "").encode().split()


def summary(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256), a row for each row of `docs`."""

    def make_base() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            n, digest = [], []
            for body in batch.column("text").to_pylist():
                found = _split(body)
                n.append(len(found))
                digest.append(hashlib.sha256(b" ".join(found)).hexdigest())
            return {"n_words": pa.array(n, pa.int64()), "whole": pa.array(digest)}

        return work

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            n, digest = [], []
            for body, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                found = _split(body)
                kept = _kept(found, spans)
                n.append(len(found) - len(kept))
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            return {"n_removed": pa.array(n, pa.int64()), "kept_sha256": pa.array(digest)}

        return work

    rows = repeats.keyed(repeats.numbered(docs.select(key, text)), key, text)
    base = append_columns(rows, {"n_words": "long", "whole": "string"}, make_base, ("text",))
    fields = {"n_removed": "long", "kept_sha256": "string"}
    found = append_columns(later_spans(rows, size), fields, make, ("text", "spans"))
    return base.join(found, "row", "left").select(
        F.when(F.col("doc") != repeats.NULL_ID, F.col("doc")).alias(key),
        "n_words",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )


def _shards(reference: DataFrame, text: str, shard_words: int) -> DataFrame:
    """(shard): automata-sized lists of words; a shard is closed by the text that fills it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        room = shard_words
        for batch in batches:
            for body in batch.column(0).to_pylist():
                held.append(b" ".join(_split(body)))
                room -= held[-1].count(b" ") + 1
                if room <= 0:
                    yield pa.RecordBatch.from_arrays([pa.array([held], pa.list_(pa.binary()))], names=["texts"])
                    held, room = [], shard_words
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([held], pa.list_(pa.binary()))], names=["texts"])

    return reference.select(text).mapInArrow(run, "texts array<binary>")


def remove_known(
    docs: DataFrame,
    reference: DataFrame,
    text: str = "text",
    reference_text: str = "text",
    size: int = SIZE,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """`docs` with the runs of at least `size` words that a reference text holds taken out; words are then joined by one
    space. Texts without such a run, null ones among them, stay as they are.

    Shards come to the driver one at a time and are broadcast; a shard has at most `shard_words` words and one text more.
    """
    frame = docs.withColumn("__spans", F.array().cast("array<struct<start:int,end:int>>"))
    for shard in _shards(reference, reference_text, shard_words).toLocalIterator():
        automaton = Automaton()
        for k, body in enumerate(shard[0]):
            for word in bytes(body).split():
                automaton.extend(word)
            automaton.extend(k)
        shared = docs.sparkSession.sparkContext.broadcast(automaton)

        def make(shared=shared) -> Callable[[pa.RecordBatch], dict]:
            def work(batch: pa.RecordBatch) -> dict:
                out = []
                for body, spans in zip(batch.column(text).to_pylist(), batch.column("__was").to_pylist(), strict=True):
                    seen = shared.value.statistics(_split(body))
                    found = [(i + 1 - n, i + 1) for i, n in enumerate(seen) if n >= size]
                    ranges = repeats.merged([(x["start"], x["end"]) for x in spans] + found)
                    out.append([{"start": s, "end": e} for s, e in ranges])
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                return {"__spans": pa.array(out, kind)}

            return work

        frame = append_columns(
            frame.withColumnRenamed("__spans", "__was"), {"__spans": "array<struct<start:int,end:int>>"}, make, ("__was",)
        )

    def make_cut() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            pairs = zip(batch.column(text).to_pylist(), batch.column("__spans").to_pylist(), strict=True)
            kept = [b" ".join(_kept(_split(x), s)).decode("utf-8", "replace") if s else x for x, s in pairs]
            return {"__kept": pa.array(kept, pa.string())}

        return work

    cut = append_columns(frame, {"__kept": "string"}, make_cut, ("__spans",))
    return cut.select(*(F.col("__kept").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns))
