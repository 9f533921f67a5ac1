"""Language-model scores from a log-frequency Bloom filter.

Bigram counts are gathered from all training texts and quantised by powers of two: a pair counted n times is stored at
the levels 0..floor(log2 n), one filter entry for each level. A stored count is read back by probing levels until one is
missing. The filter never reads less than what was stored; a false probe may read more, so a count is also bounded by
those of its two words. The probability of a word after another is

    p(w | h) = (n(h, w) + weight * p(w)) / (n(h) + weight),    p(w) = (n(w) + 1) / (N + V + 1)

with the add-one unigram estimate p(w) as the base. Counts of words are exact. Every pair of the training texts is stored,
those seen once too. The filter is sized from the distinct pairs; beyond `filter_bits` it is cut into shards by the pair's
hash, and the texts go through one shard after the other. The logarithm is a sum over words and pairs,

    log p(w | h) = log p(w) + log(weight / (n(h) + weight)) + log(1 + n(h, w) / (weight * p(w))),

so a shard adds what its pairs give, and a word's part needs its count alone. The table of the `hot_words` most frequent
words, of bounded size, is broadcast with a shard; other words, and stored pairs that hold one, get their counts by joins.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.blocks import (
    append_columns,
    blocks,
    mix,
    per_document,
    signed,
    sums_by,
    word_hashes,
    words,
)
from attestry.llm.store import stored

HOT_WORDS = 1 << 18
#: The largest shard of the filter.
FILTER_BITS = 1 << 28
PROBES = 3
#: No count of a long has more levels.
MAX_LEVEL = 63
WEIGHT = 200.0
#: Stands for the end of a text among the words' hashes.
END = np.uint64(0x5851F42D4C957F2D)
_SEED = 7


def _tokens(block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all documents, each document closed by END, and the documents' offsets."""
    found = words(block)
    hashes = word_hashes(block, found, _SEED, lower=True)
    counts = found.counts
    offsets = np.r_[0, np.cumsum(counts + 1)]
    out = np.empty(len(hashes) + len(counts), dtype=np.uint64)
    out[offsets[1:] - 1] = END
    out[np.arange(len(hashes)) + per_document(counts)] = hashes
    return out, offsets


class _Tally:
    """Counts of keys in a task, given out whenever `limit` distinct ones are held."""

    def __init__(self, limit: int = 1 << 20) -> None:
        self.limit, self.parts, self.held = limit, [], 0

    def add(self, key: np.ndarray, n: np.ndarray | None = None):
        key, n = _summed(key, n)
        self.parts.append((key, n))
        self.held += len(key)
        if self.held >= self.limit:
            key, n = _summed(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))
            self.parts, self.held = [(key, n)], len(key)
            if self.held >= self.limit // 2:
                yield from self.flush()

    def flush(self):
        if self.parts:
            key, n = _summed(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))
            self.parts, self.held = [], 0
            for low in range(0, len(key), 1 << 17):
                part = slice(low, low + (1 << 17))
                yield pa.RecordBatch.from_arrays([pa.array(signed(key[part])), pa.array(n[part])], names=["key", "n"])


def _summed(key: np.ndarray, n: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    if n is None:
        return np.unique(key, return_counts=True)
    key, at = np.unique(key, return_inverse=True)
    return key, np.bincount(at, weights=n, minlength=len(key)).astype(np.int64)


def _counted(docs: DataFrame, text: str, keys: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(key, n) over all texts; tasks add up what they see before the shuffle."""

    def run(batches):
        tally = _Tally()
        for batch in batches:
            for block in blocks(batch.column(0)):
                yield from tally.add(keys(*_tokens(block)))
        yield from tally.flush()

    return docs.select(text).mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _pairs(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def _probe_bits(key: np.ndarray, level: int, bits: int) -> list[np.ndarray]:
    one = mix(key ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
    two = mix(one ^ np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)
    return [(one + np.uint64(i) * two) % np.uint64(bits) for i in range(PROBES)]


@dataclass
class LogBloom:
    """A bit array that holds keys at count levels."""

    bits: np.ndarray

    @property
    def size(self) -> int:
        return 8 * len(self.bits)

    def has(self, key: np.ndarray, level: int) -> np.ndarray:
        out = np.ones(len(key), dtype=bool)
        for at in _probe_bits(key, level, self.size):
            out &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out

    def counts(self, key: np.ndarray) -> np.ndarray:
        """The lower end of the range that a stored count was quantised to; 0 for a key not stored."""
        out = np.zeros(len(key))
        left = np.arange(len(key))
        for level in range(MAX_LEVEL):
            left = left[self.has(key[left], level)]
            if not len(left):
                break
            out[left] = 1 << level
        return out


def build_filter(counts: DataFrame, bits: int) -> LogBloom:
    """The filter of (key, n), made of partial bit arrays that are joined by slice. Every key is stored."""
    slice_bits = min(bits, 1 << 16)

    def positions(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 1 << 19:
                yield placed(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            yield placed(pa.Table.from_batches(held))

    def placed(rows):
        key = rows.column(0).to_numpy().view(np.uint64)
        top = np.minimum(np.log2(rows.column(1).to_numpy()).astype(int), MAX_LEVEL - 1)
        found = [at for x in range(int(top.max()) + 1) for at in _probe_bits(key[top >= x], x, bits)]
        at = np.sort(np.concatenate(found))
        part, first = np.unique(at // np.uint64(slice_bits), return_index=True)
        ends = np.r_[first[1:], len(at)]
        low = (at % np.uint64(slice_bits)).astype(np.uint16)
        held = [low[a:b].tobytes() for a, b in zip(first, ends)]
        return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)), pa.array(held)], names=["part", "held"])

    def join(keys, table):
        out = np.zeros(slice_bits, dtype=bool)
        for value in table.column("held"):
            out[np.frombuffer(value.as_py(), dtype=np.uint16)] = True
        packed = np.packbits(out, bitorder="little").tobytes()
        return pa.table({"part": pa.array([keys[0].as_py()], pa.int64()), "held": pa.array([packed])})

    rows = (
        counts.select("key", "n")
        .mapInArrow(positions, "part long, held binary")
        .groupBy("part")
        .applyInArrow(join, "part long, held binary")
        .collect()
    )
    out = np.zeros(bits // 8, dtype=np.uint8)
    for part, held in rows:
        out[part * slice_bits // 8 : (part + 1) * slice_bits // 8] = np.frombuffer(held, dtype=np.uint8)
    return LogBloom(out)


@dataclass
class Words:
    hot: np.ndarray  # sorted hashes of the frequent words
    hot_counts: np.ndarray
    total: int
    kinds: int
    weight: float


@dataclass
class Model(Words):
    pairs: DataFrame  # (key, n) of all pairs, stored
    shards: int
    bits: int  # of a shard's filter

    def filter(self, shard: int) -> LogBloom:
        own = F.pmod("key", F.lit(self.shards)) == shard
        return build_filter(self.pairs.filter(own) if self.shards > 1 else self.pairs, self.bits)


def _find(model: Words, hashes: np.ndarray) -> np.ndarray:
    """Index of each word among the hot ones, or -1."""
    if not len(model.hot):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(model.hot, hashes), len(model.hot) - 1)
    return np.where(model.hot[at] == hashes, at, -1)


def word_counts(training: DataFrame, text: str = "text") -> DataFrame:
    return _counted(training, text, lambda tokens, offsets: tokens)


def _adjacent(offsets: np.ndarray, n: int) -> np.ndarray:
    """Whether a token and the next one stand in the same document."""
    out = np.ones(max(n - 1, 0), dtype=bool)
    out[offsets[1:-1] - 1] = False
    return out


def fit(
    training: DataFrame,
    counts: DataFrame,
    text: str = "text",
    hot_words: int = HOT_WORDS,
    filter_bits: int = FILTER_BITS,
    weight: float = WEIGHT,
) -> Model:
    """`counts` is `word_counts(training)`, stored; pairs are counted over all training texts.

    The filters are about half full: there are as many shards of `filter_bits` at most as the entries need.
    """
    whole = counts.agg(F.sum("n"), F.count("*")).first()
    hot = counts.orderBy(F.desc("n"), "key").limit(hot_words).toPandas()
    key = hot["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(key)

    def pairs(tokens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        both = _adjacent(offsets, len(tokens))
        return _pairs(tokens[:-1][both], tokens[1:][both])

    held = stored(_counted(training, text, pairs), "pairs")
    level = F.least(F.floor(F.log2("n")), F.lit(MAX_LEVEL - 1))
    needed = int((held.agg(F.sum(level + 1)).first()[0] or 0) * PROBES / 0.69)
    shards = max(1, -(-needed // filter_bits))
    bits = min(filter_bits, max(1 << 16, 1 << (-(-needed // shards)).bit_length()))
    return Model(
        key[order], hot["n"].to_numpy(np.int64)[order], int(whole[0] or 0), whole[1], weight, held, shards, bits
    )


def score(docs: DataFrame, model: Model, counts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, base_score, score), a row for each row of `docs`.

    A null text is scored as an empty one: its one token is the end. Null and repeated keys stay apart by a row number of
    the scan, which is stored with the scores of the hot words. Without training texts N and V are 0, and every token has
    probability 1.
    """
    whole = float(model.total + model.kinds + 1)
    weight = float(model.weight)
    table = Words(model.hot, model.hot_counts, model.total, model.kinds, weight)
    context = docs.sparkSession.sparkContext
    by_word = {
        "n_tokens": "long", "n_known": "long", "base_score": "double", "score": "double",
        "__rare": "array<struct<word:long,times:int>>",
    }
    by_pair = {"__gain": "double", "__open": "array<struct<before:long,now:long,seen:long>>"}

    def word_part(held: Words, tokens: np.ndarray, offsets: np.ndarray, at: np.ndarray) -> dict:
        hot = at >= 0
        n = held.hot_counts[at] if len(held.hot) else np.zeros(len(tokens), np.int64)
        base = np.where(hot, np.log10((n + 1) / whole), 0.0)
        leads = hot & (tokens != END)
        best = base + np.where(leads, np.log10(weight / (n + weight)), 0.0)
        rows = per_document(np.diff(offsets))[~hot]
        order = np.lexsort((tokens[~hot], rows))
        word, row = tokens[~hot][order], rows[order]
        new = np.ones(len(word), dtype=bool)
        new[1:] = (word[1:] != word[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        times = np.diff(np.r_[first, len(word)]).astype(np.int32)
        return {
            "n_tokens": np.diff(offsets),
            "n_known": sums_by(hot, offsets).astype(np.int64),
            "base_score": sums_by(base, offsets),
            "score": sums_by(best, offsets),
            "__rare": (np.bincount(row[first], minlength=len(offsets) - 1), {"word": signed(word[first]), "times": times}),
        }

    def pair_part(
        held: Words, pairs: LogBloom, shard: int, tokens: np.ndarray, offsets: np.ndarray, at: np.ndarray
    ) -> dict:
        second = np.flatnonzero(_adjacent(offsets, len(tokens))) + 1
        hashes = _pairs(tokens[second - 1], tokens[second])
        if model_shards > 1:
            own = np.mod(signed(hashes), model_shards) == shard
            second, hashes = second[own], hashes[own]
        kind, of = np.unique(hashes, return_inverse=True)
        seen = pairs.counts(kind)[of]
        second, seen = second[seen > 0], seen[seen > 0]
        hot = (at[second - 1] >= 0) & (at[second] >= 0)
        gain = np.zeros(len(tokens))
        one = second[hot]
        if len(one):
            before, now = held.hot_counts[at[one - 1]], held.hot_counts[at[one]]
            gain[one] = np.log10(1 + np.minimum(seen[hot], np.minimum(before, now)) / (weight * ((now + 1) / whole)))
        two = second[~hot]
        row = per_document(np.diff(offsets))[two]
        left = {
            "before": signed(tokens[two - 1]), "now": signed(tokens[two]), "seen": seen[~hot].astype(np.int64),
        }
        return {"__gain": sums_by(gain, offsets), "__open": (np.bincount(row, minlength=len(offsets) - 1), left)}

    model_shards = model.shards

    def make(shared, shard: int, fields: dict[str, str]) -> Callable[[], Callable[[pa.RecordBatch], dict]]:
        def start() -> Callable[[pa.RecordBatch], dict]:
            held, pairs = shared.value

            def work(batch: pa.RecordBatch) -> dict:
                parts: dict[str, list] = {name: [] for name in fields}
                for block in blocks(batch.column(batch.schema.get_field_index("__text"))):
                    tokens, offsets = _tokens(block)
                    at = _find(held, tokens)
                    found = pair_part(held, pairs, shard, tokens, offsets, at)
                    if "n_tokens" in fields:
                        found |= word_part(held, tokens, offsets, at)
                    for name in fields:
                        parts[name].append(found[name])
                return {name: _column(x) for name, x in parts.items()}

            return work

        return start

    rows = docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"))
    rows = rows.withColumn("__row", F.monotonically_increasing_id())
    if model.shards > 1:
        rows = stored(rows, "lmrows")
    passes = []
    for shard in range(model.shards):
        shared = context.broadcast((table, model.filter(shard)))
        fields = by_pair if shard else by_word | by_pair
        taken = rows.drop("__key") if shard else rows
        passes.append(stored(append_columns(taken, fields, make(shared, shard, fields), ("__text",)), "lmscore"))
        shared.destroy()
    scored = passes[0]
    none = F.lit(0).cast("long")
    rare = scored.select("__row", F.inline("__rare")).join(
        counts.select(F.col("key").alias("word"), "n"), "word", "left"
    )
    known = F.coalesce("n", F.lit(0))
    base = F.col("times") * F.log10((known + 1) / F.lit(whole))
    leads = F.when(F.col("word") != F.lit(int(signed(np.array([END]))[0])), F.col("times")).otherwise(0)
    added = rare.select(
        "__row",
        F.when(known > 0, F.col("times")).otherwise(0).cast("long").alias("more"),
        base.alias("bits"),
        (leads * F.log10(weight / (known + weight))).alias("gain"),
    )
    opened = passes[0].select("__row", F.inline("__open"))
    for one in passes[1:]:
        opened = opened.unionByName(one.select("__row", F.inline("__open")))
    for name in ("before", "now"):
        opened = opened.join(counts.select(F.col("key").alias(name), F.col("n").alias(f"n_{name}")), name)
    seen = F.least("seen", "n_before", "n_now")
    gain = F.log10(1 + seen / (weight * ((F.col("n_now") + 1) / F.lit(whole))))
    added = added.unionByName(opened.select("__row", none.alias("more"), F.lit(0.0).alias("bits"), gain.alias("gain")))
    for one in passes[1:]:
        added = added.unionByName(
            one.select("__row", none.alias("more"), F.lit(0.0).alias("bits"), F.col("__gain").alias("gain"))
        )
    added = added.groupBy("__row").agg(F.sum("more").alias("more"), F.sum("bits").alias("bits"), F.sum("gain").alias("gain"))
    more, bits, gain = F.coalesce("more", F.lit(0)), F.coalesce("bits", F.lit(0.0)), F.coalesce("gain", F.lit(0.0))
    return scored.join(added, "__row", "left").select(
        F.col("__key").alias(key),
        "n_tokens",
        (F.col("n_known") + more).alias("n_known"),
        (F.col("base_score") + bits).alias("base_score"),
        (F.col("score") + F.col("__gain") + bits + gain).alias("score"),
    )


def _column(parts: list) -> pa.Array:
    """Plain values, or (sizes, fields) of lists of structs, of the blocks of a batch."""
    if not isinstance(parts[0], tuple):
        return pa.array(np.concatenate(parts))
    sizes = np.concatenate([x for x, _ in parts])
    fields = {name: np.concatenate([x[name] for _, x in parts]) for name in parts[0][1]}
    items = pa.StructArray.from_arrays([pa.array(x) for x in fields.values()], names=list(fields))
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), items)
