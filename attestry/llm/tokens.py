"""Token ids of whole texts with a byte-level BPE file of the tokenizers library.

The library spends most of its time on merges of words that it has met before. Here a block of texts is first cut into the
pieces that the file's splitting pattern gives, by vector operations, and the library encodes each distinct piece once;
ids of frequent pieces stay in a bounded cache. A text that the vector rules don't cover (letters beyond Cyrillic, an
apostrophe that may begin a contraction) is encoded whole by the library, as are all texts if the file has another pattern
or kind. So is a text that holds the string of an added token, such as `<|endoftext|>`, which the library turns into that
token's id by default; a plain encoder takes such strings as ordinary text. Pieces are told apart by 64-bit fingerprints.
"""

from __future__ import annotations

import json
import os
import unicodedata
from dataclasses import dataclass

import numpy as np

from attestry.llm.blocks import Block, per_document, prefix, span, symbol_values

CACHED_PIECES = 1 << 19
ENCODE_BYTES = 1 << 20
_HIGH = 0x500  # code points below are split here; the texts with others go to the library

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_KIND = np.full(_HIGH, _OTHER, dtype=np.uint8)
for _c in range(_HIGH):
    _first = unicodedata.category(chr(_c))[0]
    _KIND[_c] = {"L": _LETTER, "N": _NUMBER}.get(_first, _OTHER)
_KIND[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = _SPACE
_SUFFIX = np.isin(np.arange(256), [ord(c) for c in "stmdlrv"])


@dataclass
class Pieces:
    starts: np.ndarray  # byte offsets; a piece ends where the next one starts, or its document ends
    offsets: np.ndarray  # first piece of each document
    whole: np.ndarray  # documents to be encoded by the library


def pieces(block: Block) -> Pieces:
    data, n = block.data, len(block.data)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = data[lead].astype(np.int32)
    after = data[np.minimum(lead + 1, n - 1)].astype(np.int32) if n else first
    point = np.where(first < 0x80, first, ((first & 0x1F) << 6) | (after & 0x3F))
    high = first >= 0xD4
    kind = _KIND[np.where(high, 0, point)]
    edges = np.searchsorted(lead, block.offsets)
    begins = np.zeros(len(lead) + 1, dtype=bool)
    begins[edges] = True
    begins, ends = begins[:-1], begins[1:]
    blank = kind == _SPACE
    before = np.r_[np.uint8(255), kind[:-1]] if len(kind) else kind
    after_space = np.r_[False, point[:-1] == 32][: len(kind)] & ~begins
    joined = ~blank & after_space
    followed = ~ends & np.r_[~blank[1:], False][: len(kind)]
    start = ((begins | (kind != before)) & ~joined) | (blank & followed)
    doubtful = high | (start & (first == 0x27) & _SUFFIX[after] & ~ends)
    of = np.searchsorted(edges, np.flatnonzero(doubtful), side="right") - 1
    whole = np.zeros(len(block.offsets) - 1, dtype=bool)
    whole[of] = True
    at = np.flatnonzero(start)
    return Pieces(lead[at], np.searchsorted(at, edges), whole)


class Encoder:
    """Encodes blocks of texts; one per task. `plain`: strings of added tokens are ordinary text."""

    def __init__(self, path: str, cached: int = CACHED_PIECES, plain: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.added = [] if plain else [x["content"].encode() for x in told.get("added_tokens", [])]
        split = told.get("pre_tokenizer") or {}
        self.by_piece = (
            split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and told.get("normalizer") is None
        )
        self.cached = cached
        # The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = iter(range(256, 512))
        self.shown = np.array([b if b in shown else next(hidden) for b in range(256)], dtype="<u2")
        self.known = np.zeros(0, np.uint64)
        self.at, self.size, self.uses = (np.zeros(0, np.int64) for _ in range(3))
        self.ids = np.zeros(0, np.uint32)

    def _library_ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        """`texts` are single pieces, so the library's model can be asked without the steps before it."""
        merged = self.library.model.tokenize
        found = [[x.id for x in merged(text)] for text in texts]
        size = np.fromiter(map(len, found), np.int64, len(found))
        at = len(self.ids) + np.r_[0, np.cumsum(size)[:-1]]
        self.ids = np.concatenate([self.ids, np.fromiter((i for x in found for i in x), np.uint32, int(size.sum()))])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.at = np.concatenate([self.at, at])[order]
        self.size = np.concatenate([self.size, size])[order]
        self.uses = np.concatenate([self.uses, np.zeros(len(size), np.int64)])[order]

    def _forget(self) -> None:
        """Keep the half of the cache that was used most."""
        keep = np.sort(np.argsort(-self.uses, kind="stable")[: self.cached // 2])
        self.known, size, at = self.known[keep], self.size[keep], self.at[keep]
        self.uses = self.uses[keep] // 2
        new = np.r_[0, np.cumsum(size)]
        self.ids = self.ids[np.repeat(at - new[:-1], size) + np.arange(new[-1])]
        self.at, self.size = new[:-1], size

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a block in one array, and the documents' offsets in it."""
        n = len(block.offsets) - 1
        if not self.by_piece:
            return _joined([np.array(x, np.uint32) for x in self._library_ids(self._texts(block, range(n)))])
        cut = pieces(block)
        self._mark_added(block, cut.whole)
        if len(cut.starts):
            ends = np.r_[cut.starts[1:], len(block.data)]
            hashes = span(prefix(symbol_values(5)[block.data]), cut.starts, ends)
            keys, first, piece = np.unique(hashes, return_index=True, return_inverse=True)
            at = np.searchsorted(self.known, keys)
            missing = np.ones(len(keys), dtype=bool)
            inside = at < len(self.known)
            missing[inside] = self.known[at[inside]] != keys[inside]
            if missing.any():
                lows, text = first[missing], self.shown[block.data].tobytes().decode("utf-16-le")
                texts = [text[a:b] for a, b in zip(cut.starts[lows].tolist(), ends[lows].tolist(), strict=True)]
                self._learn(keys[missing], texts)
                at = np.searchsorted(self.known, keys)
            self.uses[at] += 1
            size = self.size[at][piece]
            total = np.r_[0, np.cumsum(size)]
            ids = self.ids[np.repeat(self.at[at][piece] - total[:-1], size) + np.arange(total[-1])]
            offsets = total[cut.offsets]
            if len(self.known) > self.cached:
                self._forget()
        else:
            ids, offsets = np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        if cut.whole.any():
            parts = [ids[offsets[i] : offsets[i + 1]] for i in range(n)]
            todo = np.flatnonzero(cut.whole)
            for i, x in zip(todo, self._library_ids(self._texts(block, todo)), strict=True):
                parts[i] = np.array(x, np.uint32)
            return _joined(parts)
        return ids, offsets

    def _mark_added(self, block: Block, whole: np.ndarray) -> None:
        """Mark the documents that hold an added token's string."""
        raw = block.data.tobytes() if self.added else b""
        for string in self.added:
            at = raw.find(string)
            while at >= 0:
                whole[np.searchsorted(block.offsets, at, side="right") - 1] = True
                at = raw.find(string, at + 1)

    @staticmethod
    def _texts(block: Block, rows) -> list[str]:
        return [block.text(i).decode("utf-8", "replace") for i in rows]


_MADE: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, plain: bool = False) -> Encoder:
    """The encoder of a file, kept with its cache for all tasks of a Python worker."""
    if (path, plain) not in _MADE:
        _MADE[path, plain] = Encoder(path, plain=plain)
    return _MADE[path, plain]


def _joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.r_[0, np.cumsum([len(x) for x in parts], dtype=np.int64)].astype(np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)), offsets


def with_end(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Close each document with the id `end`."""
    counts = np.diff(offsets)
    new = np.r_[0, np.cumsum(counts + 1)]
    out = np.empty(new[-1], np.uint32)
    out[new[1:] - 1] = end
    out[np.arange(len(ids)) + per_document(counts)] = ids
    return out, new
