"""Benchmark decontamination on templates.

A text becomes a sequence of words without outer punctuation, in lower case, in which numbers, names and units are
replaced by typed placeholders. Windows of `WINDOW` template words of the documents are hash-joined with those of the
benchmark. A match along one alignment counts if its slots agree: each value of the benchmark stands for one value of the
document and the other way round. So a question with other numbers or names is found, and a text that merely has numbers
in the same places is not.

A window with fewer literal words than slots says little as a template. It is matched on its lower-cased words instead,
whether it is the document's or the benchmark's window that has so many slots; so are whole items of at most `WINDOW`
words, in addition to their template. A verbatim copy is found whatever its share of slots.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.blocks import Block, blocks, mix, per_document, prefix, signed, span, symbol_values, words
from attestry.llm.lmscore import build_filter

WINDOW = 8
#: An item shorter than `WINDOW` is one window; below this many words it has no template and is found verbatim only.
SHORTEST = 4
#: The share of an item's words that matching windows must cover.
COVERED = 0.5
FILTER_BITS = 1 << 24

# Words that stand for numbers and units.
NUMBER_WORDS = """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen
seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion
half third quarter dozen""".split()
UNIT_WORDS = """mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres mg g kg gram grams
kilogram kilograms pound pounds ounce ounces ton tons ml l liter liters litre litres s sec second seconds minute minutes
min h hour hours day days week weeks month months year years dollar dollars cent cents euro euros usd eur percent
degree degrees mph kmh watt watts volt volts joule joules newton newtons""".split()

_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD1B54A32D192ED03))
#: Tell hashes of the words themselves from those of templates. `_ANY` is what any window of a document may meet, `_HEAVY`
#: what only its windows of many slots may.
_ANY, _HEAVY = np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0x3C79AC492BA7B653)
_SOLID = np.zeros(256, dtype=bool)
_SOLID[48:58] = _SOLID[65:91] = _SOLID[97:123] = _SOLID[128:] = True
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) < 58)
_UPPER = (np.arange(256) >= 65) & (np.arange(256) < 91)
_STOP = np.isin(np.arange(256), [ord(c) for c in ".!?:"])


def _word_set(listed: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(listed).encode(), np.uint8)
    ends = np.cumsum([len(x) for x in listed])
    return np.sort(span(prefix(symbol_values(13, lower=True)[data]), np.r_[0, ends[:-1]], ends))


def _in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


@dataclass
class Template:
    """Of the words of a block: template symbol, value, whether it is a slot; `offsets` by document."""

    symbols: np.ndarray
    values: np.ndarray
    slots: np.ndarray
    offsets: np.ndarray


def template(block: Block) -> Template:
    found = words(block)
    solid = np.flatnonzero(_SOLID[block.data])
    low, high = np.searchsorted(solid, found.starts), np.searchsorted(solid, found.ends)
    real = high > low
    doc = per_document(found.counts)[real]
    last = block.data[found.ends[real] - 1] if real.any() else np.zeros(0, np.uint8)
    starts = solid[low[real]]
    ends = solid[high[real] - 1] + 1
    values = span(prefix(symbol_values(13, lower=True)[block.data]), starts, ends)
    head = block.data[starts]
    number = _DIGIT[head] | _in(values, _word_set(NUMBER_WORDS))
    opens = np.ones(len(doc), dtype=bool)
    opens[1:] = (doc[1:] != doc[:-1]) | _STOP[last[:-1]]
    unit = np.r_[False, number[:-1]][: len(doc)] & ~opens & _in(values, _word_set(UNIT_WORDS))
    name = _UPPER[head] & ~opens & ~number & ~unit
    symbols = values.copy()
    symbols[number], symbols[name], symbols[unit] = _NUMBER, _NAME, _UNIT
    return Template(symbols, values, number | name | unit, np.searchsorted(doc, np.arange(len(found.offsets))))


def _windows(of: Template, size: int, whole: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and document of the windows, and which have enough literal words; `whole`: documents of just this size."""
    n = np.diff(of.offsets)
    fits = n == size if whole else n >= size
    count = np.where(fits, n - size + 1, 0)
    doc = per_document(count)
    at = of.offsets[:-1][doc] + np.arange(len(doc)) - np.r_[0, np.cumsum(count)][doc]
    literal = np.r_[0, np.cumsum(~of.slots)]
    return at, doc, 2 * (literal[at + size] - literal[at]) >= size


_OUT = "key long, at int, n_words int, size int, window long, slots array<long>"


def _rows(
    keys: pa.Array, of: Template, at: np.ndarray, doc: np.ndarray, size: int, hashes: np.ndarray, template: bool
):
    """Rows of windows; those matched on their words have no slots."""
    slot = of.slots[at[:, None] + np.arange(size)] & template
    values = of.values[at[:, None] + np.arange(size)][slot]
    ends = np.r_[0, np.cumsum(slot.sum(axis=1))].astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            keys.take(pa.array(doc)),
            pa.array((at - of.offsets[:-1][doc]).astype(np.int32)),
            pa.array(np.diff(of.offsets)[doc].astype(np.int32)),
            pa.array(np.full(len(at), size, np.int32)),
            pa.array(signed(hashes)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(values))),
        ],
        names=["key", "at", "n_words", "size", "window", "slots"],
    )


def _window_rows(
    texts: DataFrame, key: str, text: str, sizes: list[int], whole_below: int, keep: Callable | None
) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = keep() if keep else None
        for batch in batches:
            for block in blocks(batch.column(1)):
                of = template(block)
                sums, plain = prefix(of.symbols), prefix(of.values)
                keys = batch.column(0).slice(block.low, block.high - block.low)
                for size in sizes:
                    at, doc, rich = _windows(of, size, size < whole_below)
                    words_of = span(plain, at, at + size) ^ np.uint64(size)
                    if keep:
                        literal = ((np.ones(len(at), dtype=bool), _ANY), (~rich, _HEAVY))
                    else:
                        any_of = ~rich | (np.diff(of.offsets)[doc] <= whole_below)
                        literal = ((any_of, _ANY), (~any_of, _HEAVY))
                    found = [(ok, mix(words_of[ok] ^ salt), False) for ok, salt in literal]
                    if size >= SHORTEST:
                        found.append((rich, span(sums, at[rich], at[rich] + size) ^ np.uint64(size), True))
                    for chosen, hashes, templates in found:
                        chosen = np.flatnonzero(chosen)
                        if wanted is not None:
                            ok = wanted(hashes)
                            chosen, hashes = chosen[ok], hashes[ok]
                        if len(chosen):
                            yield _rows(keys, of, at[chosen], doc[chosen], size, hashes, templates)

    return texts.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text}`")).mapInArrow(run, _OUT)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    covered: float = COVERED,
) -> DataFrame:
    """(key, item, covered_words, item_words, exact): the benchmark items found in each document.

    `exact` tells that all slots have the benchmark's own values. Null and empty texts and items hold nothing; a null key
    or item id is a value like any other; repeated rows give the same row once. Documents meet the benchmark through a
    filter of fixed size, so only windows that are likely in it are shuffled.
    """
    sizes = list(range(window, 0, -1))
    items = _window_rows(benchmark, item, item_text, sizes, window, None)
    known = build_filter(items.select(F.col("window").alias("key"), F.lit(1).alias("n")), FILTER_BITS)
    used = [r[0] for r in items.select("size").distinct().collect()]  # at most one for each window size
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def keep() -> Callable[[np.ndarray], np.ndarray]:
        return lambda hashes: shared.value.has(hashes, 0)

    found = _window_rows(docs, key, text, sorted(used, reverse=True), 0, keep)
    left = found.select(F.col("key").alias("doc"), F.col("at").alias("doc_at"), "window", F.col("slots").alias("has"))
    right = items.select(F.col("key").alias("item"), "at", "n_words", "size", "window", "slots").distinct()
    met = left.join(right, "window").filter(F.size("has") == F.size("slots"))
    met = met.select("doc", "item", (F.col("doc_at") - F.col("at")).alias("shift"), "at", "n_words", "size", "has", "slots")
    # One alignment has at most as many windows as the item.
    lines = met.groupBy("doc", "item", "shift").agg(
        F.max("n_words").alias("n_words"),
        F.collect_set(F.struct("at", "size", "has", "slots")).alias("windows"),
    )
    pairs = F.array_distinct(F.flatten(F.transform("windows", lambda w: F.arrays_zip(w["has"], w["slots"]))))
    lines = lines.withColumn("pairs", pairs)
    one_to_one = (F.size("pairs") == F.size(F.array_distinct("pairs.has"))) & (
        F.size("pairs") == F.size(F.array_distinct("pairs.slots"))
    )
    counted = F.when(one_to_one, F.col("windows")).otherwise(F.filter("windows", lambda w: F.size(w["has"]) == 0))
    places = F.flatten(F.transform(counted, lambda w: F.sequence(w["at"], w["at"] + w["size"] - 1)))
    same = F.forall("pairs", lambda p: p["has"] == p["slots"])
    return (
        lines.select("doc", "item", "n_words", places.alias("places"), same.alias("same"))
        .groupBy("doc", "item")
        .agg(
            F.max("n_words").alias("item_words"),
            F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("covered_words"),
            F.min("same").alias("exact"),
        )
        .filter(F.col("covered_words") >= covered * F.col("item_words"))
        .select(F.col("doc").alias(key), F.col("item").alias(item), "covered_words", "item_words", "exact")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of `docs` that hold no leak. Each row is judged by its own text, also among rows of one key or none; only rows
    equal in key and text are judged together, by a 64-bit fingerprint of both."""
    own = "__id"
    while own.lower() in {c.lower() for c in docs.columns}:
        own = f"_{own}"
    marked = docs.withColumn(own, F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")))
    bad = leaks(marked.select(own, text), benchmark, own, text).select(own).distinct()
    return marked.join(bad, own, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
