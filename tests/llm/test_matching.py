"""Search, Jaccard join, substring operators and decontamination against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from attestry.llm import automata, decontaminate, jaccard, repeats, search, suffixes
from attestry.llm.blocks import Block, per_document
from attestry.llm.components import components

WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


def bm25(docs, queries, top=10):
    words = [Counter((t or "").encode().translate(LOWER).split()) for _, t in docs]
    df = Counter(x for w in words for x in w)
    n, mean = len(docs), (sum(sum(w.values()) for w in words) / len(docs)) or 1.0
    for key, text in queries:
        found = []
        for (doc, _), w in zip(docs, words, strict=True):
            norm = 1.2 * (0.25 + 0.75 * sum(w.values()) / mean)
            s = 0.0
            for t in set((text or "").encode().translate(LOWER).split()):
                if w[t]:
                    s += math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * w[t] * 2.2 / (w[t] + norm)
            if s > 0:
                found.append(s)
        yield key, sorted(found, reverse=True)[:top]


@pytest.mark.parametrize("size", [1 << 24, 2000])
def test_search_is_exact(spark, documents, monkeypatch, size):
    monkeypatch.setattr(search, "SHARD_BYTES", size)
    docs = pairs(documents)
    got = defaultdict(list)
    for r in search.search(documents, documents.filter("doc_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["score"])
    want = dict(bm25(docs, [x for x in docs if x[0] % 50 == 0]))
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_search_ties_of_several_shards(spark, monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(search, "SHARD_BYTES", 60_000)
    copy = " ".join(f"s{rng.randrange(60)}" for _ in range(60))
    # The words of the copy are frequent in some shards and rare in others.
    filler = lambda i: " ".join(f"s{rng.randrange(rng.choice([60, 9000]) if rng.random() < (i % 997) / 997 else 9000)}" for _ in range(40))
    rows = [(i, copy if i % 60 == 0 else filler(i)) for i in range(1, 2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    query = spark.createDataFrame([(1, copy)], "doc_id long, text string")
    got = search.search(docs, query).orderBy("rank").collect()
    assert len({r["score"] for r in got}) == 1
    assert [r["doc_id"] for r in got] == list(range(60, 660, 60))


def test_search_scores_candidates_without_a_step_per_term(monkeypatch):
    rng = np.random.default_rng(6)
    n, terms = 300, 900
    held = [np.flatnonzero(rng.random(n) < rng.choice([0.02, 0.3])) for _ in range(terms)]
    df = np.array([len(x) for x in held], np.int32)
    row = {"keys": np.arange(n), "lengths": rng.integers(50, 300, n).astype(np.int32), "df": df, "docs": np.concatenate(held).astype(np.int32),
           "terms": np.arange(terms, dtype=np.uint64) * np.uint64(7), "times": rng.integers(1, 9, df.sum()).astype(np.int32)}
    shard, idf = search.Shard(row, 150.0), rng.random(terms) + 0.1
    calls, real = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda *a, **k: calls.append(1) or real(*a, **k))
    tops = [(np.zeros(0), np.zeros(0, np.int64))]
    shard.score(search.Queries(np.array([1]), np.array([0, terms]), row["terms"], idf), tops, 10)
    want = np.zeros(n)
    for t in range(terms):
        own = slice(shard.start[t], shard.start[t + 1])
        want[shard.docs[own]] += shard.part[own] * idf[t]
    order = np.lexsort((np.arange(n), -want))[:10]
    assert list(tops[0][1]) == list(order) and list(tops[0][0]) == list(want[order])
    assert len(calls) <= 2


def test_search_hands_on_the_best_only(spark, monkeypatch):
    """The best of each task, ten rows for each query and task, would grow with the square of the input."""
    for name, value in (("SHARD_BYTES", 3000), ("FIRST", 1), ("GROWTH", 1), ("TOGETHER", 3)):
        monkeypatch.setattr(search, name, value, raising=False)
    rng = random.Random(8)
    text = lambda: " ".join(rng.choice(WORDS[: rng.choice([9, 150])]) for _ in range(rng.randrange(1, 60)))
    rows = [(i, text()) for i in range(700)] + [(i, None if i % 2 else " ") for i in range(700, 720)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8, "doc_id")
    hits, real = [], search.stored

    def stored(df, purpose):
        out = real(df, purpose)
        hits.extend([out.count()] if purpose == "hits" else [])
        return out

    monkeypatch.setattr(search, "stored", stored)
    got = defaultdict(list)
    for r in search.search(docs, docs.filter("doc_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["score"])
    want = dict(bm25(rows, [x for x in rows if x[0] % 50 == 0 and x[0] < 700]))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)
    assert hits and max(hits) <= 10 * len(want)


def test_search_scores_queries_together(monkeypatch):
    rng = np.random.default_rng(9)
    n, terms, top = 700, 400, 10
    held = [np.sort(rng.choice(n, rng.choice([1, 20, 200, 600]), replace=False)) for _ in range(terms)]
    df = np.array([len(x) for x in held], np.int32)
    row = {"keys": np.arange(n) * 3, "lengths": rng.integers(50, 300, n).astype(np.int32), "df": df, "docs": np.concatenate(held).astype(np.int32),
           "terms": np.arange(terms, dtype=np.uint64) * np.uint64(2), "times": rng.integers(1, 9, df.sum()).astype(np.int32)}
    idf = rng.random(2 * terms) + 0.1
    chosen = [np.sort(rng.choice(2 * terms, k, replace=False)) for k in (1, 5, 100, 300, 2, 600, 1)]  # odd ones are unknown
    queries = search.Queries(np.arange(7), np.r_[0, np.cumsum([len(x) for x in chosen])], np.concatenate(chosen).astype(np.uint64), idf[np.concatenate(chosen)])
    shard, own = search.Shard(row, 150.0), per_document(df)
    wanted = []
    for x in chosen:
        weight = np.zeros(2 * terms)
        weight[x] = idf[x]
        score = np.bincount(row["docs"], shard.part * weight[2 * own], minlength=n)
        order = np.lexsort((row["keys"], -score))[:top]
        wanted.append((score[order][score[order] > 0], row["keys"][order][score[order] > 0]))
    floor = np.array([x[0][4] if len(x[0]) > 4 else 0.0 for x in wanted])
    for least in (None, floor):
        tops = [(np.zeros(0), np.zeros(0, np.int64)) for _ in chosen]
        shard.score(queries, tops, top, *([] if least is None else [least]))
        for (score, keys), (best, own_keys), low in zip(tops, wanted, np.zeros(7) if least is None else least, strict=True):
            assert list(keys) == list(own_keys[best >= low]) and list(score) == list(best[best >= low])


def test_search_of_odd_rows(odd, empty):
    queries = odd.filter("doc_id IN (1, 4, 5, 7, 12)")
    rows = search.search(odd, queries).collect()
    assert {r["query_id"] for r in rows} == {1, 7, 12}
    tied = [r["doc_id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == 1][:3]
    assert tied == [1, 2, 2]
    assert search.search(empty, queries).count() == 0 and search.search(odd, empty).count() == 0


def shingles(text):
    w = (text or "").encode().translate(LOWER).split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def brute_components(docs):
    sets, root = [shingles(t) for _, t in docs], list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                root[top(i)] = top(j)
    least = {}
    order = lambda k: (k is not None, k)
    for i, (k, _) in enumerate(docs):
        least[top(i)] = min(least.get(top(i), k), k, key=order)
    return sorted(((k, len(s), least[top(i)]) for i, ((k, _), s) in enumerate(zip(docs, sets, strict=True))), key=repr)


def edited(seed, n):
    """Families of texts with few edits, some above and some below the threshold."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([4, 6, 12, 40, 90]))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = f"w{rng.randrange(400)}"
            out.append(" ".join(copy))
    return list(enumerate(out))


@pytest.mark.parametrize("tile", [512, 2])
def test_jaccard_components(spark, odd, empty, documents, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    for frame in (spark.createDataFrame(edited(tile, 60), "doc_id long, text string").repartition(4), odd, documents):
        got = sorted((tuple(r) for r in jaccard.join(frame).collect()), key=repr)
        assert got == brute_components(pairs(frame))
    assert jaccard.join(empty).count() == 0
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] in (1, 2, 3, 7, 8)) == [1, 7]


@pytest.mark.parametrize("block", [1 << 18, 7])
def test_components_of_several_blocks(spark, block):
    rng = random.Random(block)
    links = [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)]
    links += [(200, i) for i in range(201, 230)] + [(5, 5), (300, 300), (-4, 3), (-4, 3), (3, -4)]
    best = {x: x for pair in links for x in pair}
    for _ in best:
        for a, b in links:
            best[a] = best[b] = min(best[a], best[b])
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = components(spark.createDataFrame(links, "u long, v long").repartition(3), block=block)
    assert sorted(map(tuple, got.collect())) == sorted((x, best[x]) for x in linked)
    assert components(spark.createDataFrame([], "u long, v long"), block=block).count() == 0


def brute_words(docs):
    seen, out = {}, []
    for k, t in sorted(docs, key=lambda x: (x[0] is not None, x[0])):
        w = (t or "").encode().split()
        gone = set()
        for p in range(len(w) - 19):
            run = tuple(w[p : p + 20])
            first = seen.setdefault(run, (k, p))
            if first != (k, p):
                gone.update(range(p, p + 20))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def brute_bytes(docs, size=400):
    count, out = Counter(), []
    for _, t in docs:
        b = (t or "").encode()
        count.update(b[p : p + size] for p in range(len(b) - size + 1))
    for k, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            if count[b[p : p + size]] > 1:
                gone[p : p + size] = b"\1" * size
        runs = sum(1 for i, x in enumerate(gone) if x and (not i or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((k, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def shared(seed, n):
    """Texts with a passage that all share, others that a few share, and periodic parts."""
    rng = random.Random(seed)
    draw = lambda k: " ".join(f"v{rng.randrange(5000)}" for _ in range(k))
    hot, few = draw(120), [draw(rng.randrange(15, 150)) for _ in range(12)]
    out = []
    for i in range(n):
        parts = [draw(rng.randrange(0, 60)) for _ in range(3)]
        if i % 3:
            parts.insert(1, hot)
        parts.insert(rng.randrange(4), rng.choice(few))
        if i % 7 == 0:
            parts.append("ab cd " * rng.randrange(5, 200))
        out.append((i, " ".join(parts)))
    return out


def test_substrings(spark, odd, empty, documents):
    made = spark.createDataFrame(shared(1, 200), "doc_id long, text string").repartition(5)
    for frame in (made, documents):
        assert sorted((tuple(r) for r in automata.summary(frame).collect()), key=repr) == brute_words(pairs(frame))
        assert sorted((tuple(r) for r in suffixes.summary(frame).collect()), key=repr) == brute_bytes(pairs(frame))
    assert suffixes.summary(odd).count() == automata.summary(odd).count() == 14
    assert sorted((tuple(r) for r in suffixes.summary(odd).collect()), key=repr) == brute_bytes(pairs(odd))
    assert suffixes.summary(empty).count() == automata.summary(empty).count() == 0
    left = suffixes.remove(odd)
    assert left.columns == odd.columns and left.count() == 14
    # Repeated rows count as one document for the words.
    once = odd.dropDuplicates(["doc_id"])
    assert sorted((tuple(r) for r in automata.summary(once).collect()), key=repr) == brute_words(pairs(once))


def test_rows_of_one_key_are_apart(spark):
    rng = random.Random(9)
    draw = lambda k: " ".join(f"u{rng.randrange(5000)}" for _ in range(k))
    passage, second = draw(150), draw(150)
    texts = [(None, f"{draw(500)} {passage} {draw(5)}"), (None, f"{passage} {draw(30)}"), (None, draw(300)),
             (7, f"{draw(40)} {second}"), (7, f"{second} {draw(200)}"), (7, f"{draw(40)} {second}"),
             (8, passage), (8, passage), (8, "short"), (None, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    assert sorted((tuple(r) for r in suffixes.summary(docs).collect()), key=repr) == brute_bytes(texts)
    # As documents with keys of their own, in the order of the rows, nulls first.
    apart = list(enumerate(t for _, t in texts))
    assert sorted(tuple(r)[1:] for r in automata.summary(docs).collect()) == sorted(r[1:] for r in brute_words(apart))
    left = Counter(r["text"] for r in suffixes.remove(docs).collect())
    assert left[texts[2][1]] == 1 and left["short"] == 1 and left[""] == 2


def test_a_block_of_chunks_or_shingles_stays_small(monkeypatch):
    """No step of the Jaccard join or of the substring operators sees more of a batch at once than a small block."""
    seen = []
    for module, name in ((jaccard, "shingle_sets"), (repeats, "chunks_of")):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, f=real: seen.append(max(len(x.data) for x in a if isinstance(x, Block))) or f(*a))
    batch = pa.RecordBatch.from_pydict({"text": [f"{i} " + "some words of a text " * 500 for i in range(200)], "doc": range(200), "row": range(200)})

    class Frame:
        """Stands for a DataFrame: hands the batch to the function of the tasks."""

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return sum(x.num_rows for x in run(iter([batch])))

    assert jaccard._prefixes(Frame(), 5, 80, True) and jaccard._sets(Frame(), 5) == 200
    assert repeats._chunks(Frame(), repeats.Frame(False, 400, 128, False), True)
    assert max(seen) <= 1 << 18 and batch.nbytes > 1 << 20


def test_passages_of_words_go(spark):
    """Passages of 51 words go in every document though they have less than 400 bytes; those of 50 stay, as do 399 bytes."""
    rng = random.Random(11)
    draw = lambda k, n=9: " ".join(f"{rng.randrange(10**n):0{n}d}" for _ in range(k))
    short, below, long = draw(51, 5), draw(50, 5), draw(45)  # 305, 299 and 449 bytes
    wide = "  \n".join(short.split())  # the same words with other white space
    many = draw(51, 4)  # its anchor occurs with more than 64 contents
    rows = [(1, f"{draw(30)} {short}\n{draw(20)}"), (2, f"\u00c4 {wide} {draw(9)}"), (None, f"{below} {draw(60)}"), (4, f"{draw(3)} {below}"),
            (5, f"{draw(8)} {long} {short} {draw(4)}"), (5, f"{long} q{draw(7)}"), (6, None), (7, ""), (8, "x " * 60), (9, short)]
    rows += [(10 + i, f"{draw(2)} {many} {draw(2)}") for i in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    seen = Counter(tuple(w[i : i + 51]) for _, t in rows for w in [(t or "").split()] for i in range(len(w) - 50))
    want = []
    for _, t in rows:
        w = (t or "").split()
        gone = {j for i in range(len(w) - 50) if seen[tuple(w[i : i + 51])] > 1 for j in range(i, i + 51)}
        want.append([x for j, x in enumerate(w) if j not in gone and x not in long.split()])
    got = suffixes.remove(docs, passage=51).collect()
    assert sorted((r["text"] or "").split() for r in got) == sorted(want)
    assert short in Counter(r["text"] for r in suffixes.remove(docs).collect())  # by bytes alone it stays
    texts = {r["doc_id"]: r["text"] for r in got}
    assert texts[6] is None and texts[9] == "" and texts[2].startswith("\u00c4  ") and below in texts[4]


def test_pipeline_takes_out_passages_of_over_50_words(spark):
    draw = lambda seed, k: " ".join(random.Random(seed).choices(WORDS, k=k))
    passage = draw(0, 52)
    rows = [(i, f"{draw(i, 40)} {passage} {draw(-i, 40)}", "en", "s", 1) for i in (1, 2, 3)] + [(4, draw(4, 200), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in corpus_pipeline.without_repeats(spark, docs, "a folder").collect()}
    assert len(passage) < 400 and not any(passage in r["text"] for r in got.values())
    assert got[4]["text"] == rows[3][1] and all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert got[1]["text"] == f"{draw(1, 40)}  {draw(-1, 40)}"


def test_one_of_each_by_rows(spark):
    near = " ".join(f"n{i}" for i in range(100))
    rows = [(None, near), (None, near + " end"), (None, "other words"), (1, near), (1, "its own text of one"), (2, "its own text of one"), (3, None)]
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    want = [(None, near), (None, "other words"), (1, "its own text of one"), (3, None)]
    assert sorted(map(tuple, kept), key=repr) == sorted(want, key=repr)


def test_families_of_any_size_agree(spark):
    docs = shared(3, 120)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = sorted((r[0], r[2]) for r in brute_bytes(docs, 60))
    got = sorted((r["doc_id"], r["n_removed"]) for r in suffixes.summary(frame, size=60).collect())
    assert got == want


@pytest.mark.parametrize("entries", [1, 40, 300])
def test_closed_families_lose_no_match(entries):
    """Families that are closed early, over batches of any size, mark what brute force marks inside each anchor."""
    rng = random.Random(entries)
    rows = []
    for i in range(60):
        anchor = rng.randrange(6)  # windows of different anchors differ
        body = bytes(rng.choice((2 * anchor, 2 * anchor + 1)) for _ in range(rng.randint(8, 40)))
        rows.append((anchor, i, 100 * i, rng.random() < 0.8, body))
    rows.sort()
    names = ["anchor", "row", "a", "query", "body"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
    cut = [rows[i : i + 7] for i in range(0, len(rows), 7)]
    batches = [pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*c), kinds)], names=names) for c in cut]
    got = set()
    for out in suffixes.index(8, batch_bytes=50, family_entries=entries)(iter(batches)):
        for row, a, b in zip(*(c.to_pylist() for c in out.columns)):
            got |= {(row, x) for x in range(a, b + 1)}
    seen = Counter((anchor, body[i : i + 8]) for anchor, _, _, _, body in rows for i in range(len(body) - 7))
    want = {
        (row, a + i)
        for anchor, row, a, query, body in rows
        for i in range(len(body) - 7)
        if query and seen[anchor, body[i : i + 8]] > 1
    }
    assert got == want


def test_automaton_statistics():
    rng = random.Random(5)
    text = [rng.choice("ab") for _ in range(300)]
    automaton, seen = automata.Automaton(), []
    for i, c in enumerate(text):
        longest = max((k for k in range(i + 1) if "".join(text[i - k : i + 1]) in "".join(text[:i])), default=-1) + 1
        assert automaton.extend(c) == longest
        seen.append(c)
    probe = [rng.choice("abc") for _ in range(100)]
    for i, n in enumerate(automaton.statistics(probe)):
        assert n == max(k for k in range(i + 2) if "".join(probe[i + 1 - k : i + 1]) in "".join(text))


def test_remove_known(spark, odd):
    passage = " ".join(f"p{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"a b {passage} c"), (2, f"a {passage[:40]}"), (3, None)], "doc_id long, text string")
    reference = spark.createDataFrame([(f"x {passage} y",), (None,), ("other words",)], "text string")
    for shard_words in (10, 10_000):
        out = automata.remove_known(docs, reference, shard_words=shard_words)
        assert dict(pairs(out)) == {1: "a b c", 2: f"a {passage[:40]}", 3: None}


def test_leaks(spark, odd, empty, documents):
    question = "If Anna buys 12 apples for 3 dollars each and sells 5 of them to Bob, how many apples are left?"
    items = spark.createDataFrame([(1, question), (2, None), (3, "")], "item_id long, text string")
    other = question.replace("Anna", "Maria").replace("12", "47").replace("3", "8").replace("5", "9").replace("Bob", "Karl")
    rows = [(1, f"Before. {other} After."), (2, question), (3, question.replace("12", "7").replace("3", "7")),
            (4, "clean words of no question at all that go on for a while"), (None, question.lower()), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["exact"] for r in decontaminate.leaks(docs, items).collect()}
    assert got.keys() == {1, 2, None} and got[1] is False and got[2] is True
    assert {r["doc_id"] for r in decontaminate.without_leaks(docs, items).collect()} == {3, 4, 5}
    assert decontaminate.leaks(odd, items).count() == decontaminate.leaks(empty, items).count() == 0
    assert decontaminate.leaks(docs, empty.selectExpr("doc_id AS item_id", "text")).count() == 0
    assert decontaminate.without_leaks(odd, items).columns == odd.columns


def test_leaks_of_many_slots(spark):
    question = "If Anna buys 12 apples for 3 dollars each and sells 5 of them to Bob, how many apples are left?"
    sums = "What is 12 45 7 3 88 19 20 41 5 6 75"
    texts = ["What is 12 45 7 3", "Who Wrote The Old Man And The Sea", sums, question, "Moby Dick", "Call me Ishmael now",
             "Anna has a red dog and a cat"]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows = [f"we asked. {t} and more" for t in texts] + [t.upper() for t in texts] + [t.lower() for t in texts]
    want = {(i, i % 7) for i in range(21)} | {(2, 0), (9, 0), (16, 0)}
    others = ["What is 13 46 8 4", "Who Read The Young Boy And The Lake", sums.replace("7", "9"), "Moby is Dick"]
    rows += [*others, "so said Anna has a red dog and a cat", "he saw that Moby Dick"]
    want |= {(25, 6), (26, 4)}
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).collect()}
    assert got == want


def test_leaks_query(spark, query, documents):
    items = pairs(spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
    squeeze = lambda t: " ".join(t.split())
    want = {(k, i) for k, t in pairs(documents) for i, x in items if squeeze(x) in squeeze(t)}
    assert {(r["doc_id"], r["item_id"]) for r in query("op9_decontaminate")} == want


def test_a_leak_takes_its_own_row_only(spark):
    question = "If Anna buys 12 apples for 3 dollars each and sells 5 of them to Bob, how many apples are left in the basket?"
    benchmark = spark.createDataFrame([(1, question)], "item_id long, text string")
    rows = [(None, question, 1), (None, "clean text of no key", 2), (None, None, 3), (7, question, 4), (7, "clean", 5), (7, question, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id int")
    kept = decontaminate.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r["__id"] for r in kept.collect()) == [2, 3, 5]
    assert decontaminate.without_leaks(docs.limit(0), benchmark).count() == 0
