"""Encoding, packing, id files and the pipeline."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from attestry.llm import decontaminate, idfiles, packing
from attestry.llm.blocks import blocks
from attestry.llm.queries import tokenizer
from attestry.llm.tokens import Encoder


@pytest.fixture(scope="module")
def library():
    held = Tokenizer.from_file(tokenizer())
    return lambda text: held.encode(text or "", add_special_tokens=False).ids


ENCODER = Encoder(tokenizer(), cached=64)
PLAIN = Encoder(tokenizer(), cached=64, plain=True)
REFERENCE, PLAIN_REFERENCE = Tokenizer.from_file(tokenizer()), Tokenizer.from_file(tokenizer())
PLAIN_REFERENCE.encode_special_tokens = True


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.text(alphabet=st.sampled_from("ab'stre12 \n\t éßЖ中.,!<|>\u0085²"), max_size=40),
            st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext", "|>", " ", "a"]), max_size=5).map("".join),
        ),
        max_size=6,
    )
)
def test_pieces_give_the_librarys_ids(texts):
    for ours, library in ((ENCODER, REFERENCE), (PLAIN, PLAIN_REFERENCE)):
        for block in blocks(pa.array(texts, pa.string())):
            ids, offsets = ours.encode(block)
            for i, text in enumerate(texts[block.low : block.high]):
                want = library.encode(text, add_special_tokens=False).ids
                assert ids[offsets[i] : offsets[i + 1]].tolist() == want


def test_added_tokens_are_the_librarys_by_default():
    (block,) = blocks(pa.array(["a <|endoftext|> b"]))
    assert ENCODER.encode(block)[0].tolist() == [64, 220, 50256, 275]
    assert PLAIN.encode(block)[0].tolist() == [64, 1279, 91, 437, 1659, 5239, 91, 29, 275]


def test_payload_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 127, 128, 129, 5000):
        ids = rng.integers(0, 50_000, n).astype(np.uint32)
        ids[rng.random(n) < 0.02] = 2**32 - 1
        held = idfiles.Reader(idfiles.encode(ids))
        assert (held.ids() == ids).all()
        if n > 300:
            assert (held.slice(100, 300) == ids[100:300]).all()
    assert len(idfiles.encode(np.full(1280, 7, np.uint32))) < 200


def order(row):
    return (row["doc_id"] is not None, row["doc_id"], row["text"] is not None, row["text"])


def test_id_files(spark, odd, empty, library, tmp_path):
    for name, frame in (("odd", odd), ("empty", empty)):
        idfiles.write(frame, f"{tmp_path}/{name}", tokenizer(), end=2)
        got = sorted(idfiles.read(spark, f"{tmp_path}/{name}").collect(), key=lambda r: r["start"])
        start, want = 0, []
        for r in sorted(frame.collect(), key=order):
            ids = np.array([*library(r["text"]), 2], "<u4")
            want.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
        assert [tuple(r) for r in got] == want


def check_packing(frame, rows, library):
    whole = {}
    for r in frame.collect():
        whole.setdefault(r["doc_id"], []).append(np.array([*library(r["text"]), 0], "<u4"))
    sequences = {}
    for r in rows:
        ids = next(x for x in whole[r["doc_id"]] if len(x) == r["doc_tokens"])
        part = ids[r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(r["length"] for r in rows) == sum(len(x) for xs in whole.values() for x in xs)
    for held in sequences.values():
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(held, held[1:]))
        assert sum(held[-1]) <= 1024
    assert sorted(sequences) == list(range(len(sequences)))
    return sum(r["length"] for r in rows) / (1024 * max(len(sequences), 1))


def test_packing(odd, empty, documents, library):
    assert check_packing(odd, packing.pack(odd, tokenizer()).collect(), library) > 0.9
    assert check_packing(documents, packing.pack(documents, tokenizer()).collect(), library) > 0.95
    assert packing.pack(empty, tokenizer()).count() == 0
    held = packing.pack(odd, tokenizer(), with_ids=True).first()
    assert zlib.crc32(held["ids"]) == held["ids_crc32"]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(0, 9), max_size=12))
def test_every_piece_has_its_own_slot(counts):
    plan = packing.shortest_pack_first(counts, 32)
    taken = set()
    for length, n in counts.items():
        if n:
            sequence, offset = plan.place(np.full(n, length), np.arange(n))
            for s, o in zip(sequence.tolist(), offset.tolist(), strict=True):
                slots = {(s, o + k) for k in range(length)}
                assert o + length <= 32 and not slots & taken
                taken |= slots


def test_queries(query, documents, library):
    texts = sorted(documents.collect(), key=order)
    start = 0
    for r, d in zip(sorted(query("op8_token_files"), key=lambda r: r["doc_id"]), texts, strict=True):
        ids = np.array([*library(d["text"]), 2], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d["doc_id"], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    check_packing(documents, query("op5_packing"), library)


def test_pipeline(spark, odd, empty, documents, library, tmp_path):
    folder = "/root/testdata/sf0.001"
    docs = documents.unionByName(odd.drop("score").withColumns({"source": F.lit("s"), "n_chars": F.lit(1).cast("long")}))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert out.columns == documents.columns, name
            assert out.count() <= docs.count()
            if name == "decontaminate":
                bad = {r["doc_id"] for r in decontaminate.leaks(docs, spark.read.parquet(f"{folder}/benchmark.parquet")).collect()}
                assert {r["doc_id"] for r in docs.collect()} - bad == {r["doc_id"] for r in out.collect()}
            docs = out
    check_packing(docs, out.collect(), library)
    none = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0
