"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm import (
    alignment,
    automata,
    decontaminate,
    idfiles,
    jaccard,
    language,
    linededup,
    lmscore,
    packing,
    periodic,
    search,
    suffixes,
    toxicity,
)
from attestry.llm.blocks import append_columns, fold
from attestry.llm.store import drop, stored
from attestry.session import configure, work_dir


_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def tokenizer() -> str:
    """The file of the public byte-level BPE."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model() -> str:
    """The file of the public piece model."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, a lower limit for broadcasts by measured size, as the operators here run
    many joins in a row whose broadcasts would add up on the driver, and smaller Arrow batches of texts."""
    configure(spark).conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "2MB")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold("doc_id", 4) == 2
    model = language.fit(docs.filter(~held_out))
    scored = language.predict(docs.select("doc_id", "text"), model, drop=("text",))
    return scored.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 7) == 2
    training = docs.filter(~held_out)
    counts = stored(lmscore.word_counts(training), "words")
    model = lmscore.fit(training, counts)
    scored = lmscore.score(docs, model, counts)
    drop(model.pairs)  # the texts have been through all filters
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.total).alias("train_tokens"),
        "base_score", "score",
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = fold("doc_id", 5) == 0
    model = toxicity.fit(docs.join(labels.filter(~held_out), "doc_id"))
    scored = toxicity.predict(docs, model, spans=True, drop=("text",))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "toxic_spans")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer())


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_dir(spark, "ids")
    idfiles.write(table(spark, sf_dir, "documents"), folder, tokenizer(), end=2)
    return idfiles.read(spark, folder)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return automata.summary(table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.summary(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search.search(docs, docs.filter("doc_id % 50 = 0"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = alignment.align(docs, tokenizer(), piece_model(), drop=("text",))
    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    links = alignment.numbered_links(aligned.withColumn("groups_sha256", digest).drop("groups"))
    return alignment.score(links, alignment.vocabulary(piece_model())).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def with_periods(docs: DataFrame) -> DataFrame:
    """Documents whose h = crc32(decimal doc_id) ends in 0 with a periodic end: each word i >= a becomes the original word
    a + (i - a) % p. Null ids have no h; their texts, and those without words, stay."""

    def make() -> Callable[[pa.RecordBatch], dict]:
        def work(batch: pa.RecordBatch) -> dict:
            ids = batch.column("doc_id").to_pylist()
            texts = batch.column("text").to_pylist()
            for row, key in enumerate(ids):
                h = 1 if key is None else zlib.crc32(str(key).encode())
                found = _WORDS.findall(texts[row] or "") if h % 10 == 0 else []
                if found:
                    n, g = len(found), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    texts[row] = " ".join(found[:a] + [found[a + i % p] for i in range(n - a)])
            return {"text": pa.array(texts, pa.string())}

        return work

    return append_columns(docs, {"text": "string"}, make, ("text",))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic.find(docs, drop=("text",))
    # Exact order by length / period, then by start and period.
    ratios = "x.length * y.period - y.length * x.period"
    ranked = F.expr(
        f"array_sort(runs, (x, y) -> CAST(CASE WHEN {ratios} <> 0 THEN -sign({ratios}) "
        "WHEN x.start <> y.start THEN sign(x.start - y.start) ELSE sign(x.period - y.period) END AS INT))"
    )
    best = F.get(ranked, F.lit(0))
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit("")).cast("binary")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_topk_search": op2_topk_search,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_packing": op5_packing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_lm_score": op7_lm_score,
    "op8_token_files": op8_token_files,
    "op9_decontaminate": op9_decontaminate,
    "op10_toxicity": op10_toxicity,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_line_dedup": op13_line_dedup,
}
#: None of these operators can be put as SQL; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {}
