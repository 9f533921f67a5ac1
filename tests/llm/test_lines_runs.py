"""Line dedup, periodic runs and tokenizer alignment against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from attestry.llm import alignment, linededup, periodic, queries
from attestry.llm.blocks import blocks, words
from attestry.llm.queries import piece_model, tokenizer

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\v\f\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- lines


def line_key(line):
    key = line.strip(SPACE)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in key) if len(key) >= 10 else None


def brute_lines(rows):
    """(doc, lines, dropped, kept text) of each row."""
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if line_key(line):
                holders[line_key(line)].add(doc)
    first = {k: None if None in v else min(v) for k, v in holders.items() if len(v) > 1}
    out = []
    for doc, text in rows:
        cut = (text or "").split("\n")
        kept = [x for x in cut if line_key(x) not in first or first[line_key(x)] == doc]
        out.append((doc, len(cut), len(cut) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def line_rows():
    common = ["A common line of text", "  a COMMON line of text\t", "short", "über zehn Zeichen", "zehn Punkt", "neun Pun.", ""]
    rnd = random.Random(3)
    rows = [(i, "\n".join(rnd.choice([*common, f"own line number {i} {j}"]) for j in range(rnd.randint(0, 9)))) for i in range(60)]
    rows += [(5, "a common line of text\na common line of text"), (5, rows[5][1]), (None, "own line number 7 1\nzehn Punkt"), (None, None)]
    rows += [(70, None), (71, ""), (72, "\n\n"), (73, "zehn Punkt\r\nzehn Punkt"), (74, "　zehn Punkt"), (75, "\n".join(["a common line of text"] * 5000))]
    return rows


@pytest.mark.parametrize("max_bits", [linededup.MAX_BITS, 0])
def test_lines_agree_with_brute_force(spark, line_rows, max_bits):
    docs = spark.createDataFrame(line_rows, "doc_id long, text string").repartition(5)
    got = linededup.remove(docs, max_bits=max_bits).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got), key=repr) == brute_lines(line_rows)
    assert sum(r.n_dropped for r in got) > 5000


def test_line_odd_rows(spark, odd, empty):
    got = linededup.remove(odd.withColumn("n_lines", odd["score"])).collect()
    assert len(got) == odd.count() and {r.score for r in got} == {9}
    assert {(r.doc_id, r.n_lines) for r in got if r.doc_id in (4, 5)} == {(4, 1), (5, 1)}
    assert [r.text for r in got if r.doc_id == 4] == [None]
    assert [r.n_dropped for r in got if r.doc_id == 2] == [1, 1]  # the line of document 1
    assert linededup.remove(empty).columns == ["doc_id", "lang", "score", "text", "n_lines", "n_dropped"]
    assert linededup.remove(empty).count() == 0
    clash = odd.selectExpr("string(doc_id) as key", "text as body", "1 as doc", "2 as print", "3 as __gone", "4 as __print")
    got = linededup.remove(clash, "key", "body").collect()
    assert {(r["doc"], r["print"], r["__gone"], r["__print"]) for r in got} == {(1, 2, 3, 4)}


def test_line_filters_have_no_false_negative():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 1 << 63, 500, dtype=np.uint64) for _ in range(6)]
    shared = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    whole = linededup.Filters(linededup.filter_words(4000))
    for i, own in enumerate(parts):
        one = linededup.Filters(len(whole.once))
        one.add(own, np.arange(500) % 50)
        if i in (1, 4):
            one.add(shared, np.zeros(40, np.int64))
        one.add(np.repeat(own[:20], 2), np.zeros(40, np.int64))  # once in the task before
        word = np.flatnonzero(one.once)
        whole.merge(word, one.once[word], one.twice[word])
    seen = np.concatenate([shared, *(p[:20] for p in parts)])
    word, bits = linededup.word_and_bits(seen, len(whole.twice))
    assert ((whole.twice[word] & bits) == bits).all()
    word, bits = linededup.word_and_bits(np.concatenate([p[20:] for p in parts]), len(whole.twice))
    assert ((whole.twice[word] & bits) == bits).mean() < 0.05


def test_line_query(documents, query):
    want = {r[0]: r[1:] for r in brute_lines([tuple(r) for r in documents.select("doc_id", "text").collect()])}
    got = query("op13_line_dedup")
    assert len(got) == len(want)
    assert all((r.n_lines, r.n_dropped, r.kept_sha256) == (*want[r.doc_id][:2], sha(want[r.doc_id][2])) for r in got)


# --- runs


def brute_runs(found, least=24, exponent=3):
    """(start, length, period) of all runs."""
    n, out = len(found), {}
    for period in range(1, n // exponent + 1):
        i = 0
        while i + period < n:
            start = i
            while i + period < n and found[i] == found[i + period]:
                i += 1
            if i > start and i + period - start >= max(least, exponent * period):
                out.setdefault((start, i + period - start), period)
            i += i == start
    return sorted((s, x, p) for (s, x), p in out.items())


def brute_collapsed(found, runs):
    gone = {i for s, x, p in runs for i in range(s + p, s + x)}
    return " ".join(w for i, w in enumerate(found) if i not in gone)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 6)), max_size=6), max_size=4),
    st.sampled_from([(24, 3), (2, 2), (6, 2), (9, 3), (40, 4)]),
)
def test_runs_agree_with_brute_force(told, limits):
    texts = [" \n".join(f"w{w}" for unit, times in doc for w in unit * times) for doc in told]
    for block in blocks(pa.array(texts, pa.string())):
        found = words(block)
        catchers = periodic.Catchers(periodic.word_hashes(block, found), found.offsets, *limits)
        runs = catchers.runs()
        data, offsets = periodic.collapsed(block, found, runs)
        got = []
        for i, text in enumerate(texts[block.low : block.high]):
            low, high = found.offsets[i], found.offsets[i + 1]
            own = [(s - low, e - s, p) for s, e, p in runs.tolist() if low <= s < high]
            assert own == brute_runs(WORDS.findall(text), *limits)
            got.append(data[offsets[i] : offsets[i + 1]].tobytes().decode())
            assert got[-1] == brute_collapsed(WORDS.findall(text), own)


def test_sequences_that_linear_fingerprints_confuse():
    """Rolling fingerprints modulo a power of two agree for long Thue-Morse sequences and their complements."""
    morse = [bin(i).count("1") & 1 for i in range(1 << 11)]
    ids = np.array([3, 5], np.uint64)[morse + [1 - x for x in morse] * 3 + morse[:50] * 5]
    got = periodic.Catchers(ids, np.array([0, len(ids)]), 24, 3).runs()
    assert [(s, e - s, p) for s, e, p in got.tolist()] == brute_runs(ids.tolist())


def test_stretches_whose_names_agree_by_chance_are_compared_by_word(monkeypatch):
    rnd = np.random.default_rng(4)
    ids = np.r_[np.tile(rnd.integers(0, 9, 7), 9), rnd.integers(0, 9, 90)].astype(np.uint64)
    right = periodic.Catchers(ids, np.array([0, 40, len(ids)]), 24, 3).runs().tolist()
    monkeypatch.setattr(periodic, "mix", lambda x: x % np.uint64(2))
    assert periodic.Catchers(ids, np.array([0, 40, len(ids)]), 24, 3).runs().tolist() == right != []


def test_run_odd_rows(spark, odd, empty):
    got = periodic.find(odd.withColumn("Runs", odd["score"])).collect()
    assert len(got) == odd.count() and "Runs" not in got[0].asDict()
    own = {r.doc_id: r for r in got}
    assert [tuple(x) for x in own[12].runs] == [(0, 300, 1)] and own[12].collapsed == "aaaa"
    assert (own[4].n_words, own[4].runs, own[4].collapsed) == (0, [], "")
    assert (own[6].n_words, own[6].collapsed) == (0, "") and own[8].n_words == 20_001
    assert periodic.find(empty).count() == 0
    with pytest.raises(ValueError):
        periodic.find(odd, min_exponent=1)


def test_run_query(documents, query):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in query("op12_periodic_runs")}
    assert len(got) == len(rows)
    planted = 0
    for doc, text in rows:
        found = WORDS.findall(text or "")
        h, n = zlib.crc32(str(doc).encode()), len(found)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            found = [w if i < a else found[a + (i - a) % p] for i, w in enumerate(found)]
        runs = brute_runs(found)
        planted += bool(runs)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        r = got[doc]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{x},{q}\n" for s, x, q in runs))
        assert r.collapsed_sha256 == sha(brute_collapsed(found, runs))
    assert planted > 10


def test_run_query_of_null_ids(spark):
    rows = [(None, "a b c"), (None, None)]
    assert [r.text for r in queries.with_periods(spark.createDataFrame(rows, "doc_id long, text string")).collect()] == ["a b c", None]


# --- alignment


@pytest.fixture(scope="module")
def brute_alignment():
    a, b = Tokenizer.from_file(tokenizer()), sentencepiece.SentencePieceProcessor(model_file=piece_model())
    a.encode_special_tokens = True
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    byte = {chr(x if x in shown else next(hidden)): x for x in range(256)}
    entry = {i: bytes(byte[c] for c in e) for e, i in a.get_vocab().items() if i != 50256}

    def piece(i):
        x = b.id_to_piece(i)
        return bytes([int(x[3:5], 16)]) if b.is_byte(i) else x.replace("▁", " ").encode()

    def one(text):
        """Groups [(A ids, B ids)] and links Counter((a, b)) of a text."""
        if not text:
            return [], Counter()
        want = (" " + text).encode()
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        held = [entry[i] for i in ids[0]], [piece(i) for i in ids[1]]
        if any(b"".join(x) != want for x in held):
            return [], Counter()
        spans = []
        for own, pieces in zip(ids, held):
            at = np.r_[0, np.cumsum([len(x) for x in pieces])].tolist()
            spans.append(list(zip(own, at[:-1], at[1:])))
        links = Counter()
        j = 0
        for x, start, end in spans[0]:
            while spans[1][j][2] <= start:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < end:
                links[x, spans[1][k][0]] += 1
                k += 1
        common = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups = []
        for high in common:
            groups.append(([], []))
            for side, out in zip(spans, groups[-1]):
                while side and side[0][2] <= high:
                    out.append(side.pop(0)[0])
        return groups, links

    return one


def written(groups):
    return ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)


def aligned_rows(rows, one):
    found = [(doc, *one(text)) for doc, text in rows]
    counts = Counter(p for _, _, links in found for p in links)
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for doc, groups, links in found:
        n_best = sum(n for p, n in links.items() if counts[p] == most[p[0]])
        sizes = [sum(len(g[i]) for g in groups) for i in (0, 1)]
        text = written(groups)
        out.append((doc, *sizes, len(groups), sum(links.values()), n_best, sum(n * counts[p] for p, n in links.items()), sha(text) if groups else ""))
    return sorted(out, key=repr)


TEXTS = [
    "Hello world, this is the alignment.", "  two  spaces   and\n\nnew\tlines\r\n ", "don't it's", "<|endoftext|> <s> </s> <unk> <0x41>",
    "中文 ①ﬁ é é Ж😀", "a▁b", "", None, " ", " ", "\x00\x01", "x" * 500, "die Äpfel und die Öfen " * 40,
    "Hello world, this is the alignment.", "﻿abc", "word " * 3000,
]


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 0])
def test_alignment_agrees_with_brute_force(spark, brute_alignment, limit):
    rows = [(i if i % 5 else None, x) for i, x in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    links = alignment.numbered_links(alignment.align(docs, tokenizer(), piece_model()))
    got = alignment.score(links, alignment.vocabulary(piece_model()), limit).collect()
    seen = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, sha(r.groups) if r.groups else "") for r in got]
    assert sorted(seen, key=repr) == aligned_rows(rows, brute_alignment)
    assert [r.groups for r in got if r.text == "a▁b"] == [""]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab the\n\t éß中.,<|>▁́😀"), max_size=30), max_size=5))
def test_alignment_of_any_text(brute_alignment, texts):
    work = alignment.aligner(tokenizer(), piece_model())
    for block in blocks(pa.array([f" {x}" if x else None for x in texts], pa.string())):
        got = work(block)
        for i, text in enumerate(texts[block.low : block.high]):
            groups, links = brute_alignment(text)
            assert got["groups"][i].as_py() == written(groups)
            pairs = {(p // 32000, p % 32000): n for p, n in zip(got["pairs"][i].as_py(), got["times"][i].as_py())}
            assert pairs == links


def test_remembered_pieces_are_bounded():
    held = alignment.PieceModel(piece_model(), cached=50)
    texts = [" " + " ".join(f"word{i * 40 + j}" for j in range(40)) for i in range(20)]
    for text in texts + texts[:2]:
        for block in blocks(pa.array([text])):
            ids, _, good = held.encode(block)
            assert ids.tolist() == held.model.encode(text[1:]) and good.all()
        assert len(held.known) <= 50


def test_alignment_odd_rows(spark, odd, empty):
    got = alignment.align(odd.withColumn("N_A", odd["score"]), tokenizer(), piece_model()).collect()
    assert len(got) == odd.count() and "N_A" not in got[0].asDict()
    own = {r.doc_id: r for r in got}
    assert (own[4].n_a, own[4].pairs, own[4].groups) == (0, [], "") and own[6].n_a > 0 and own[7].n_links > 20_000
    assert alignment.align(empty, tokenizer(), piece_model()).count() == 0
    links = alignment.numbered_links(alignment.align(empty, tokenizer(), piece_model()))
    assert alignment.score(links, 32000).count() == 0


def test_alignment_query(documents, query, brute_alignment):
    want = aligned_rows([tuple(r) for r in documents.select("doc_id", "text").collect()], brute_alignment)
    assert sorted((tuple(r) for r in query("op11_tokenizer_alignment")), key=repr) == want
