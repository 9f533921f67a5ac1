"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, trained from document labels.

A sentence has the probability sigmoid(bias + sum of the weights of its distinct words), a document
1 - prod(1 - p(sentence)): it is toxic if any sentence is. Weights are trained on document labels alone and afterwards
point at the sentences that caused the label.

Sentences end at `.`, `!`, `?` or a line break. Words are runs of letters and digits (ASCII letters in lower case, all
non-ASCII bytes count as letters). A word counts with its whole form and its first 4 and 6 bytes, hashed to 2**18
weights. Only forms whose share of documents differs between the labels by `MIN_Z` standard errors are trained.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.blocks import Block, append_columns, blocks, prefix, span, sums_by, symbol_values
from attestry.llm.language import sample_rows

SLOTS = 1 << 18
TRAIN_ROWS_PER_LABEL = 2500
MIN_Z = 3.5
FIELDS = {"score": "double", "predicted": "int"}
_SPANS = "array<struct<start:int,length:int,score:double>>"

_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[0x2E, 0x21, 0x3F, 0x0A]] = True


@dataclass
class Sentences:
    """Words as weight slots, the sentence of each word, and the byte range and document of each sentence."""

    slots: np.ndarray
    of: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray  # first sentence of each document


def sentences(block: Block) -> Sentences:
    """Every document has at least one sentence if it has a byte; none crosses a document."""
    data, n = block.data, len(block.data)
    solid = _WORD[data]
    first, last = solid.copy(), solid.copy()
    new = np.zeros(n + 1, dtype=bool)
    new[block.offsets] = True
    if n:
        first[1:] &= ~solid[:-1]
        last[:-1] &= ~solid[1:]
        inner = block.offsets[(block.offsets > 0) & (block.offsets < n)]
        first[inner], last[inner - 1] = solid[inner], solid[inner - 1]
        stop = _STOP[data]
        new[1:] |= stop & ~np.r_[stop[1:], False]
    starts = np.flatnonzero(new[:-1])
    word, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = prefix(symbol_values(11, lower=True)[data])
    of = np.searchsorted(starts, word, side="right") - 1
    forms = [(word, end, of)]
    for size in (4, 6):
        longer = end - word > size
        forms.append((word[longer], word[longer] + size, of[longer]))
    # A stem gets other slots than the same bytes as a whole word.
    slots = np.concatenate([span(sums, a, b) + np.uint64(k << 46) for k, (a, b, _) in enumerate(forms)])
    slots = (slots >> np.uint64(46)).astype(np.int64)
    of = np.concatenate([x for _, _, x in forms])
    return Sentences(slots, of, starts, np.r_[starts[1:], n][: len(starts)], np.searchsorted(starts, block.offsets))


def _distinct(found: Sentences) -> tuple[np.ndarray, np.ndarray]:
    """(sentence, slot) without repeats, in order."""
    pair = np.unique(found.of * SLOTS + found.slots)
    return pair // SLOTS, pair % SLOTS


@dataclass
class NoisyOr:
    weights: np.ndarray
    bias: float

    def sentence_scores(self, found: Sentences) -> np.ndarray:
        of, slots = _distinct(found)
        total = np.bincount(of, weights=self.weights[slots], minlength=len(found.starts))
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -30, 30)))


def _features(sample: DataFrame, text: str, label: str):
    """Distinct slots of each sentence of the sampled rows, as three arrays a row."""

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            sizes, slots = [], []
            for block in blocks(batch.column(batch.schema.get_field_index(text))):
                found = sentences(block)
                of, slot = _distinct(found)
                count = np.bincount(of, minlength=len(found.starts))
                ends = np.r_[0, np.cumsum(count)]
                for i in range(len(block.offsets) - 1):
                    a, b = found.offsets[i], found.offsets[i + 1]
                    sizes.append(count[a:b].astype(np.int32).tobytes())
                    slots.append(slot[ends[a] : ends[b]].astype(np.int32).tobytes())
            return {"sizes": pa.array(sizes, pa.binary()), "slots": pa.array(slots, pa.binary())}

        return work

    return append_columns(sample.select(label, text), {"sizes": "binary", "slots": "binary"}, make, (text,))


def fit(
    labelled: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows_per_label: int = TRAIN_ROWS_PER_LABEL,
    rounds: int = 150,
    penalty: float = 0.02,
) -> NoisyOr:
    """Fit on a sample of `rows_per_label` rows of each label (0 and 1), drawn by hash: the only data that come to the
    driver. With no rows of one label, every text gets the share of label 1 there (0.0 without any rows).

    Weights are trained by gradient steps (Adam, with `penalty` as weight decay) on the log likelihood of the noisy-or;
    each label has half of the weight in it, so the threshold of 0.5 treats both alike.
    """
    usable = labelled.filter(F.col(label).isin(0, 1))
    drawn = _features(sample_rows(usable, key, label, rows_per_label), text, label).toPandas()
    weights = np.zeros(SLOTS)
    y = drawn[label].to_numpy(np.float64) if len(drawn) else np.zeros(0)
    if not len(y) or y.min() == y.max():
        return NoisyOr(weights, 30.0 if len(y) and y[0] == 1 else -30.0)
    size = [np.frombuffer(x, np.int32) for x in drawn["sizes"]]
    count = np.concatenate(size)
    doc = np.repeat(np.arange(len(size)), [len(x) for x in size])
    slot = np.concatenate([np.frombuffer(x, np.int32) for x in drawn["slots"]])
    of = np.repeat(np.arange(len(count)), count)
    pairs = np.unique(doc[of].astype(np.int64) * SLOTS + slot)
    docs_of = [np.bincount(pairs[y[pairs // SLOTS] == k] % SLOTS, minlength=SLOTS) + 0.5 for k in (0, 1)]
    odds = [np.log(n / ((y == k).sum() + 1 - n)) for k, n in enumerate(docs_of)]
    known = (np.abs(odds[1] - odds[0]) / np.sqrt(1 / docs_of[0] + 1 / docs_of[1]) > MIN_Z)[slot]
    slot, of = slot[known], of[known]
    names, slot = np.unique(slot, return_inverse=True)
    w, bias = np.zeros(len(names)), -4.0
    balance = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    m, v, mb, vb = np.zeros(len(w)), np.zeros(len(w)), 0.0, 0.0
    for step in range(1, rounds + 1):
        z = np.clip(np.bincount(of, weights=w[slot], minlength=len(count)) + bias, -30, 30)
        p = 1 / (1 + np.exp(-z))
        log_clean = np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y))
        clean = np.exp(log_clean)
        # d loss / d log_clean, then d log_clean / dz = -p
        outer = np.where(y == 1, clean / np.maximum(1 - clean, 1e-9), -1.0) * balance
        dz = -(p * outer[doc])
        g, gb = np.bincount(slot, weights=dz[of], minlength=len(w)), dz.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = 0.2 / (1 + step / 100)
        scale = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w -= scale * m / (np.sqrt(v) + 1e-8)
        w *= 1 - rate * penalty
        bias = min(bias - scale * mb / (np.sqrt(vb) + 1e-8), -1.0)
    weights[names] = w
    return NoisyOr(weights, float(bias))


def predict(df: DataFrame, model: NoisyOr, text: str = "text", spans: bool = False, drop: tuple = ()) -> DataFrame:
    """`df` with `score` (0 to 1) and `predicted`; columns of these names are replaced.

    Null and empty texts have no sentence and score 0. `spans` adds `toxic_spans`: byte ranges of the sentences that
    score at least 0.5 alone.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = FIELDS | ({"toxic_spans": _SPANS} if spans else {})

    def make() -> Callable[[pa.RecordBatch], dict]:
        held = shared.value

        def work(batch: pa.RecordBatch) -> dict:
            scores, where = [], []
            for block in blocks(batch.column(batch.schema.get_field_index(text))):
                found = sentences(block)
                p = held.sentence_scores(found)
                scores.append(-np.expm1(sums_by(np.log1p(-np.minimum(p, 1 - 1e-12)), found.offsets)))
                for i in range(len(block.offsets) - 1) if spans else ():
                    a, b = found.offsets[i], found.offsets[i + 1]
                    where.append(
                        [
                            {
                                "start": int(found.starts[k] - block.offsets[i]),
                                "length": int(found.ends[k] - found.starts[k]),
                                "score": float(p[k]),
                            }
                            for k in a + np.flatnonzero(p[a:b] >= 0.5)
                        ]
                    )
            score = np.clip(np.concatenate(scores), 0.0, 1.0)
            out = {"score": pa.array(score), "predicted": pa.array((score >= 0.5).astype(np.int32))}
            if spans:
                kind = pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("score", pa.float64())]))
                out["toxic_spans"] = pa.array(where, kind)
            return out

        return work

    return append_columns(df, fields, make, drop)
