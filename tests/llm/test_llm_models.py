"""Language ID, LM scoring and toxicity."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from attestry.llm import language, lmscore, toxicity
from attestry.llm.blocks import blocks, fold
from attestry.llm.store import stored


def ppm_bits(counts, text: bytes) -> float:
    """Code length by the definition: order 3 to 0 with escapes, then 256 bytes alike."""
    total = 0.0
    padded = b"\0\0\0" + text
    for i in range(3, len(padded)):
        p, done = 1.0, False
        for order in (3, 2, 1, 0):
            seen = counts[order].get(padded[i - order : i])
            if not seen:
                continue
            whole = sum(seen.values()) + len(seen)
            if padded[i] in seen:
                p, done = p * seen[padded[i]] / whole, True
                break
            p *= len(seen) / whole
        total -= math.log2(p if done else p / 256)
    return total


def test_code_lengths_follow_the_definition(spark):
    texts = [("abra cadabra abra", "a"), ("simsalabim sim", "b"), ("abba", "a")]
    model = language.fit(spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(texts)], "doc_id int, text string, lang string"))
    for column, name in enumerate(model.languages):
        counts = [{} for _ in range(4)]
        for t in (t.encode() for t, g in texts if g == name):
            padded = b"\0\0\0" + t
            for i in range(3, len(padded)):
                for order in range(4):
                    counts[order].setdefault(padded[i - order : i], Counter())[padded[i]] += 1
        for probe in (b"abra sim", b"zz", b"abracadabra abba \xc3\xa4"):
            data = np.frombuffer(probe, np.uint8)
            got = language.code_lengths(model, data, np.array([0, len(data)]))[0, column]
            assert got == pytest.approx(ppm_bits(counts, probe), rel=1e-5)


def test_language_of_odd_rows(odd, empty):
    model = language.fit(odd)
    rows = language.predict(odd, model).collect()
    assert len(rows) == 14 and language.predict(odd, model).columns.count("score") == 1
    for r in rows:
        letters = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    assert language.fit(empty) is None
    assert {r["lang_pred"] for r in language.predict(odd, None).collect()} == {"und"}
    assert language.predict(empty, model).count() == 0
    kept = language.keep_known(odd, model)
    assert kept.columns == odd.columns
    assert all(r["text"] and any(c.isalpha() for c in r["text"]) for r in kept.collect())
    assert language.keep_known(odd, None).count() == kept.count()


def test_language_query(query, documents, remainder):
    langs = {r["doc_id"]: r["lang"] for r in documents.collect()}
    rows = query("op1_language_id")
    assert len(rows) == len(langs)
    assert all(r["held_out"] == (remainder(r["doc_id"], 4) == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.95 * len(held)


WORD = re.compile(rb"[^\x20\x09-\x0d]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokens(text):
    return [*WORD.findall((text or "").encode().translate(LOWER)), None]


def check_base(rows, texts, training, total):
    counts = Counter(t for x in training for t in tokens(x))
    whole = sum(counts.values())
    assert total == whole
    for key, n, known, base, score in rows:
        t = tokens(texts[key])
        assert n == len(t) and known == sum(counts[x] > 0 for x in t)
        want = sum(math.log10((counts[x] + 1) / (whole + len(counts) + 1)) for x in t)
        assert base == pytest.approx(want, rel=1e-9, abs=1e-9) and score <= 0


def test_lm_query(query, documents, remainder):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = query("op7_lm_score")
    training = [t for k, t in texts.items() if remainder(k, 7) != 2]
    got = [(r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in rows]
    check_base(got, texts, training, rows[0]["train_tokens"])
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_lm_with_rare_words_joined(odd, empty):
    counts = stored(lmscore.word_counts(odd), "words")
    model = lmscore.fit(odd, counts, hot_words=5)
    keyed = stored(odd.withColumn("doc_id", F.monotonically_increasing_id()), "keyed")
    texts = {r["doc_id"]: r["text"] for r in keyed.collect()}
    rows = [tuple(r) for r in lmscore.score(keyed, model, counts).collect()]
    assert len(rows) == 14
    check_base(rows, texts, texts.values(), model.total)
    none = stored(lmscore.word_counts(empty), "words")
    blank = lmscore.fit(empty, none)
    assert all(r["score"] == 0 and r["n_known"] == 0 for r in lmscore.score(odd, blank, none).collect())
    assert lmscore.score(empty, model, counts).count() == 0


@pytest.mark.parametrize("hot, bits", [(1 << 18, 1 << 20), (7, 1 << 20), (7, 1 << 9)])
def test_lm_scores_follow_the_definition(spark, hot, bits):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.5, 30) % 50) for _ in range(40)] + ["only here", "", "w1 unseen w2"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    training = frame.filter("doc_id < 42")
    words = Counter(t for x in texts[:42] for t in tokens(x))
    pairs = Counter(p for x in texts[:42] for p in zip(tokens(x), tokens(x)[1:], strict=False))
    assert sum(n == 1 for n in pairs.values()) > 50
    total, whole = sum(words.values()), sum(words.values()) + len(words) + 1
    counts = stored(lmscore.word_counts(training), "words")
    model = lmscore.fit(training, counts, hot_words=hot, filter_bits=bits, weight=5.0)
    assert model.total == total and (model.shards > 1) == (bits < 1 << 16)
    got = {r["doc_id"]: r["score"] for r in lmscore.score(frame, model, counts).collect()}
    exact = 0
    for i, text in enumerate(texts):
        want, last = 0.0, None
        for at, t in enumerate(tokens(text)):
            p = (words[t] + 1) / whole
            if at:
                seen = pairs[last, t] and 2 ** int(math.log2(pairs[last, t]))
                p = (seen + 5.0 * p) / (words[last] + 5.0)
            want, last = want + math.log10(p), t
        assert got[i] >= want - 1e-9
        exact += got[i] == pytest.approx(want, rel=1e-9)
    # The others met a false probe.
    assert exact >= (0.9 if bits > 1 << 16 else 0.05) * len(texts)


def test_filter_never_reads_less(spark):
    keys = np.random.default_rng(3).integers(0, 1 << 62, 5000)
    n = np.random.default_rng(4).integers(1, 3000, 5000)
    held = lmscore.build_filter(spark.createDataFrame(list(zip(keys.tolist(), n.tolist())), "key long, n long"), 1 << 20)
    got = held.counts(keys.astype(np.uint64))
    low = 2.0 ** np.floor(np.log2(n))
    assert (got >= low).all() and (got == low).mean() > 0.95
    others = np.random.default_rng(5).integers(0, 1 << 62, 5000).astype(np.uint64)
    assert (held.counts(others) > 0).mean() < 0.05


def test_toxic_sentences_are_found(spark, empty):
    good = ["a fine day in town. we walk home.", "trees grow tall here. birds sing.", "rain falls. rivers run."]
    rows = [(i, good[i % 3] + (" you utter scoundrel go." if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(200)]
    rows += [(200, None, 0), (201, "", 0)]
    table = spark.createDataFrame(rows, "doc_id int, text string, toxic int")
    model = toxicity.fit(table)
    out = {r["doc_id"]: r for r in toxicity.predict(table, model, spans=True).collect()}
    assert all(out[i]["predicted"] == (i % 4 == 0) for i in range(200))
    span = out[0]["toxic_spans"][0]
    assert len(out[0]["toxic_spans"]) == 1 and "scoundrel" in rows[0][1][span["start"] : span["start"] + span["length"]]
    assert out[200]["score"] == out[201]["score"] == 0.0
    nothing = toxicity.fit(empty.withColumn("toxic", F.lit(1)))
    assert {r["predicted"] for r in toxicity.predict(table, nothing).collect()} == {0}


def test_toxicity_query(spark, query, documents, remainder):
    """Each score is the noisy-or of the document's sentences scored alone, and the spans are those that reach 0.5."""
    rows = query("op10_toxicity")
    assert sorted(r["doc_id"] for r in rows) == sorted(r[0] for r in documents.select("doc_id").collect())
    assert all(r["held_out"] == (remainder(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(documents.select("doc_id", "text").join(labels.filter(~(fold("doc_id", 5) == 0)), "doc_id"))
    parts = []
    for doc, text in documents.select("doc_id", "text").collect():
        for block in blocks(pa.array([text], pa.string())):
            found = toxicity.sentences(block)
            cut = zip(found.starts.tolist(), found.ends.tolist(), strict=True)
            parts += [(doc, a, b - a, block.data[a:b].tobytes().decode()) for a, b in cut]
    alone = toxicity.predict(spark.createDataFrame(parts, "doc_id long, start int, length int, text string"), model).collect()
    clean, spans = {}, {}
    for p in alone:
        clean[p.doc_id] = clean.get(p.doc_id, 1.0) * (1 - p.score)
        spans.setdefault(p.doc_id, []).extend([(p.start, p.length)] if p.score >= 0.5 else [])
    for r in rows:
        assert r["score"] == pytest.approx(1 - clean.get(r["doc_id"], 1.0), abs=1e-9)
        assert sorted((x.start, x.length) for x in r["toxic_spans"]) == sorted(spans.get(r["doc_id"], []))


def test_toxicity_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in entry.queries()["op10_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in truth]
    right = [r for r in rows if r.predicted == truth[r.doc_id]]
    toxic = [r for r in rows if truth[r.doc_id] == 1]
    assert len(rows) > 500 and len(right) >= 0.96 * len(rows)
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic)
