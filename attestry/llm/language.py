"""Language identification by prediction by partial matching (PPM) over bytes.

Each language has a variable-order byte context tree. The code length of a byte is taken at the longest context seen
in training: a symbol seen there costs -log2(n / (total + kinds)), any other first pays the escape
-log2(kinds / (total + kinds)) and is then coded one order lower; below order 0 all 256 bytes are alike. The statistics
are frozen after training and exclude nothing, so the code length of a byte is a function of the byte and the three
before it. The trees of all languages are therefore laid out as tables of code lengths, and a whole text is scored by
looking its bytes up and adding: the four bytes that end there, if any language has seen them; else the escapes from the
three before, and the code length at order two.

The model is fitted on a bounded sample (`rows_per_language`, drawn by hash) and holds all contexts that occur in it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.blocks import append_columns, blocks

ROWS_PER_LANGUAGE = 600
UNKNOWN = "und"
GRACE = 64
FIELDS = {"lang_pred": "string", "score": "double", "bits_per_byte": "double"}


@dataclass
class PpmModel:
    """Code lengths in bits for each language: `low` of a symbol after two others, `four` of the runs of four bytes in
    `grams` (sorted), `escape` from the contexts of three bytes in `contexts` (sorted; 0 where a language lacks it).
    `symbol` maps bytes to symbols (0: never seen)."""

    languages: list[str]
    symbol: np.ndarray
    kinds: int
    low: np.ndarray
    grams: np.ndarray
    four: np.ndarray
    contexts: np.ndarray
    escape: np.ndarray


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each byte with the three before it, packed; zeros stand before a text."""
    wide = data.astype(np.uint32)
    out = wide.copy()
    starts, lengths = offsets[:-1], np.diff(offsets)
    for back in (1, 2, 3):
        before = np.zeros_like(wide)
        before[back:] = wide[:-back] if back < len(wide) else 0
        for step in range(back):
            before[starts[lengths > step] + step] = 0
        out |= before << np.uint32(8 * back)
    return out


def count_grams(samples: DataFrame, text: str, label: str) -> DataFrame:
    """(label, gram, n): packed four-byte runs of the sample, counted."""

    def run(batches):
        for batch in batches:
            names = batch.column(1).to_pylist()
            for block in blocks(batch.column(0)):
                grams = _grams(block.data, block.offsets)
                held = np.array(names[block.low : block.high], dtype=object)
                for name in set(held):
                    rows = np.repeat(held == name, block.lengths)
                    gram, n = np.unique(grams[rows], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(gram), pa.string()), pa.array(gram.astype(np.int64)), pa.array(n)],
                        names=["label", "gram", "n"],
                    )

    counted = samples.select(F.col(text), F.col(label)).mapInArrow(run, "label string, gram long, n long")
    return counted.groupBy("label", "gram").agg(F.sum("n").alias("n"))


def sample_rows(labelled: DataFrame, key: str, label: str, rows: int) -> DataFrame:
    """About `rows` rows of each label, drawn by a hash of the key (all rows of a rarer label)."""
    share = {x[0]: min(1.0, rows / x[1]) for x in labelled.groupBy(label).count().collect()}
    if not share:
        return labelled.limit(0)
    limit = F.create_map(*(F.lit(x) for pair in share.items() for x in pair))[F.col(label)]
    drawn = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(1 << 20)) / (1 << 20)
    return labelled.filter(drawn < limit)


def _costs(languages: list[str], frames: dict[str, tuple[np.ndarray, np.ndarray]]) -> PpmModel:
    # Zero stands before a text, so it has a symbol of its own.
    seen = np.unique(np.concatenate([[0], *(g & 0xFF for g, _ in frames.values())]))
    symbol = np.zeros(256, dtype=np.int32)
    symbol[seen] = np.arange(1, len(seen) + 1)
    kinds = len(seen) + 1
    grams = np.unique(np.concatenate([g for g, _ in frames.values()])).astype(np.uint32)
    contexts, of = np.unique(grams >> np.uint32(8), return_inverse=True)
    b, c, s = (symbol[(grams >> np.uint32(shift)) & np.uint32(0xFF)] for shift in (16, 8, 0))
    low = np.empty((kinds**3, len(languages)), dtype=np.float32)
    four = np.empty((len(grams), len(languages)), dtype=np.float32)
    escape = np.empty((len(contexts), len(languages)), dtype=np.float32)

    def order(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
        total = counts.sum(axis=-1, keepdims=True)
        distinct = (counts > 0).sum(axis=-1, keepdims=True)
        whole = np.maximum(total + distinct, 1)
        return np.where(total == 0, below, np.where(counts > 0, counts / whole, distinct / whole * below))

    for k, name in enumerate(languages):
        n = np.zeros(len(grams))
        n[np.searchsorted(grams, frames[name][0].astype(np.uint32))] = frames[name][1]
        two = np.zeros((kinds, kinds, kinds))
        np.add.at(two, (b, c, s), n)
        zero = order(two.sum(axis=(0, 1)), np.full(kinds, 1 / 256))
        second = order(two, order(two.sum(axis=0), zero))
        low[:, k] = -np.log2(second.ravel())
        total = np.bincount(of, n, len(contexts))
        distinct = np.bincount(of, n > 0, len(contexts))
        left = np.where(total == 0, 1.0, distinct / np.maximum(total + distinct, 1))
        escape[:, k] = -np.log2(left)
        held = np.where(n > 0, n / np.maximum(total + distinct, 1)[of], left[of] * second[b, c, s])
        four[:, k] = -np.log2(held)
    return PpmModel(languages, symbol, kinds, low, grams, four, contexts, escape)


def fit(
    labelled: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> PpmModel | None:
    """Fit on the rows with a text and a label; None where there are none.

    What comes to the driver are the grams of the sample, so their number is bounded by its bytes.
    """
    usable = labelled.filter(F.col(text).isNotNull() & F.col(label).isNotNull() & (F.length(text) > 0))
    rows = count_grams(sample_rows(usable, key, label, rows_per_language), text, label).toArrow()
    if not rows.num_rows:
        return None
    names = np.array(rows.column("label").to_pylist(), dtype=object)
    gram, n = (rows.column(x).to_numpy() for x in ("gram", "n"))
    frames = {name: (gram[names == name], n[names == name]) for name in set(names)}
    return _costs(sorted(frames), frames)


def code_lengths(model: PpmModel, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each whole document under each language."""
    lengths = np.diff(offsets)
    bits = np.zeros((len(lengths), len(model.languages)))
    if not len(data):
        return bits
    grams = _grams(data, offsets)
    kinds = model.kinds
    before = [model.symbol[(grams >> np.uint32(8 * back)) & np.uint32(0xFF)] for back in (2, 1)]
    cost = model.low[(before[0].astype(np.int64) * kinds + before[1]) * kinds + model.symbol[data]]
    at = np.minimum(np.searchsorted(model.grams, grams), len(model.grams) - 1)
    known = model.grams[at] == grams
    cost[known] = model.four[at[known]]
    rest = np.flatnonzero(~known)
    context = grams[rest] >> np.uint32(8)
    at = np.minimum(np.searchsorted(model.contexts, context), len(model.contexts) - 1)
    met = model.contexts[at] == context
    cost[rest[met]] += model.escape[at[met]]
    full = lengths > 0
    bits[full] = np.add.reduceat(cost, offsets[:-1][full], axis=0, dtype=np.float64)
    return bits


_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each document holds a Unicode letter; only documents without an ASCII letter are decoded."""
    lengths = np.diff(offsets)
    out = np.zeros(len(lengths), dtype=bool)
    full = lengths > 0
    if full.any():
        out[full] = np.logical_or.reduceat(_LETTER[data], offsets[:-1][full])
    for i in np.flatnonzero(full & ~out):
        out[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def predict(df: DataFrame, model: PpmModel | None, text: str = "text", drop: tuple = ()) -> DataFrame:
    """`df` with `lang_pred`, `score` and `bits_per_byte`; columns of these names are replaced.

    `lang_pred` is the language with the shortest code (ties: first by name), `score` its posterior at equal priors.
    A null text, one without a letter, and every text where there is no model get `und`, score 0 and null bits.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[pa.RecordBatch], dict]:
        held = shared.value

        def work(batch: pa.RecordBatch) -> dict:
            names, scores, rates = [], [], []
            for block in blocks(batch.column(batch.schema.get_field_index(text))):
                letters = has_letter(block.data, block.offsets)
                if held is None:
                    letters[:] = False
                    best = score = np.zeros(len(letters))
                else:
                    bits = code_lengths(held, block.data, block.offsets)
                    best = bits.min(axis=1)
                    score = 1 / np.exp2(np.maximum(best[:, None] - bits, -1000)).sum(axis=1)
                    pick = bits.argmin(axis=1)
                names += [held.languages[pick[i]] if ok else UNKNOWN for i, ok in enumerate(letters)]
                scores.append(np.where(letters, score, 0.0))
                rates.append(np.where(letters, best / np.maximum(block.lengths, 1), np.nan))
            rate = np.concatenate(rates)
            return {
                "lang_pred": pa.array(names, pa.string()),
                "score": pa.array(np.concatenate(scores)),
                "bits_per_byte": pa.array(rate, mask=np.isnan(rate)),
            }

        return work

    return append_columns(df, FIELDS, make, drop)


def keep_known(df: DataFrame, model: PpmModel | None, text: str = "text") -> DataFrame:
    """Rows of `df`, with its own columns, whose text some language explains.

    Rejected are texts without a letter (null and empty ones among them) and texts that no language codes in fewer than
    eight bits a byte, with `GRACE` bits for short texts. Without a model only the letters count.
    """
    if model is None:
        return df.filter(F.col(text).rlike(r"\p{L}"))
    judged = predict(df.withColumnsRenamed({c: f"own_{c}" for c in df.columns}), model, f"own_{text}")
    bits = F.col("bits_per_byte") * F.octet_length(f"own_{text}")
    kept = judged.filter((F.col("lang_pred") != UNKNOWN) & (bits < 8 * F.octet_length(f"own_{text}") + GRACE))
    return kept.select(*(F.col(f"`own_{c}`").alias(c) for c in df.columns))
