"""Ranked text search and the term index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions import text as X
from attestry.session import work_dir

K1 = 1.2
B = 0.75


def _terms(queries: dict[str, str]) -> list[str]:
    return list(dict.fromkeys(w for q in queries.values() for w in X.word_list(q)))


def word_counts(texts: DataFrame, text: str, queries: dict[str, str]) -> DataFrame:
    """The columns of ``texts`` with the length of each text and how often each word of the queries stands in it."""
    kept = [F.col(f"`{c}`") for c in texts.columns]
    return X.with_words(texts, text).select(
        *kept,
        X.word_count(F.col("_words")).cast("double").alias("_len"),
        *[X.term_frequency(F.col("_words"), w).cast("double").alias(f"_tf_{w}") for w in _terms(queries)],
    )


def _scored(
    counted: DataFrame, corpus: DataFrame, queries: dict[str, str], k1: float, b: float
) -> DataFrame:
    """Scores in place of the counts; ``corpus`` is one row of the corpus figures."""

    def part(word: str) -> Column:
        tf, df = F.col(f"_tf_{word}"), F.col(f"_c.df_{word}")
        idf = F.ln((F.col("_c.n") - df + 0.5) / (df + 0.5) + 1.0)
        norm = k1 * (1.0 - b + b * F.col("_len") / F.col("_c.avg"))
        return F.when(tf > 0, idf * tf * (k1 + 1.0) / (tf + norm)).otherwise(F.lit(0.0))

    def score(query: str) -> Column:
        words = X.word_list(query)
        hit = X.any_of([F.col(f"_tf_{w}") > 0 for w in words])
        return F.when(hit, reduce(lambda x, y: x + y, [part(w) for w in words]))

    dropped = {"_len", *(f"_tf_{w}" for w in _terms(queries))}
    kept = [F.col(f"`{c}`") for c in counted.columns if c not in dropped]
    return counted.withColumn("_c", corpus.scalar()).select(
        *kept, *[score(q).alias(name) for name, q in queries.items()]
    )


def bm25_scores(
    texts: DataFrame, text: str, queries: dict[str, str], k1: float = K1, b: float = B
) -> DataFrame:
    """Add one BM25 score column per named query; NULL where no word occurs.

    Word and length counts stay in the row. Only the corpus figures (number of
    texts, average length, texts holding each word) are aggregated, into one
    row, which is joined back by broadcast. Queries are OR lists of words.
    """
    corpus = X.with_words(texts.select(text), text).agg(
        F.struct(
            F.count("*").cast("double").alias("n"),
            F.avg(X.word_count(F.col("_words"))).alias("avg"),
            *[
                F.expr(f"double(count_if(contains(_words, ' {w} ')))").alias(f"df_{w}")
                for w in _terms(queries)
            ],
        )
    )
    return _scored(word_counts(texts, text, queries), corpus, queries, k1, b)


def stored_scores(
    texts: DataFrame, text: str, queries: dict[str, str], k1: float = K1, b: float = B
) -> DataFrame:
    """``bm25_scores`` without the text, which is split into words once.

    The counts of each text are stored, a few numbers a row; the corpus figures and the scores are taken from those.
    """
    spark = texts.sparkSession
    path = work_dir(spark, "word-counts")
    counted = word_counts(texts, text, queries).drop(text)
    counted.write.parquet(path)
    counted = spark.read.schema(counted.schema).parquet(path)
    corpus = counted.agg(
        F.struct(
            F.count("*").cast("double").alias("n"),
            F.avg("_len").alias("avg"),
            *[F.expr(f"double(count_if(`_tf_{w}` > 0))").alias(f"df_{w}") for w in _terms(queries)],
        )
    )
    return _scored(counted, corpus, queries, k1, b)


def ranked_search(
    texts: DataFrame,
    key: str,
    text: str,
    queries: dict[str, str],
    limit: int = 50,
    digits: int | None = None,
) -> DataFrame:
    """The best texts by the first score, then the next ones; no-hit rows drop out."""
    scored = stored_scores(texts, text, queries)
    hits = scored.filter(X.any_of([F.col(name).isNotNull() for name in queries]))
    if digits is not None:
        hits = hits.withColumns({n: F.round(n, digits) for n in queries})
    return hits.orderBy(*[F.col(n).desc_nulls_last() for n in queries], F.col(key)).limit(limit)


def workflow_search(
    workflows: DataFrame,
    repositories: DataFrame,
    scores: dict[str, str],
    where: str,
    limit: int = 50,
    digits: int | None = None,
) -> DataFrame:
    """The best workflows with their repositories: those that hold a word of ``where``, by the scores in their order.

    The search is one pass over the texts; only the hits are joined with the repositories, whose other workflows and
    workflows of unknown repositories drop out.
    """
    texts = workflows.select(F.col("id").alias("workflow_id"), "repository_id", "filename", "content")
    hits = stored_scores(texts, "content", {**scores, "_where": where}).filter("_where IS NOT NULL")
    if digits is not None:
        hits = hits.withColumns({n: F.round(n, digits) for n in scores})
    repos = repositories.select(F.col("id").alias("repository_id"), "nameWithOwner", "description")
    order = [F.col(n).desc_nulls_last() for n in scores]
    return (
        hits.join(repos, "repository_id")
        .select("nameWithOwner", "filename", "workflow_id", *scores, "description")
        .orderBy(*order, "nameWithOwner", "filename", "workflow_id")
        .limit(limit)
    )


def _counted(rows: DataFrame, fields: list[str]) -> DataFrame:
    """``(id, field, term, tf)`` of each row by itself: the sorted words of a text, cut where a new word begins."""
    fields_of = F.array(
        *[F.struct(F.lit(f).alias("field"), F.sort_array(X.tokens(F.col(f))).alias("terms")) for f in fields]
    )
    begins = "filter(sequence(1, size(terms)), i -> i = 1 OR terms[i - 1] != terms[greatest(i - 2, 0)])"
    ends = "coalesce(get(begins, n + 1), size(terms) + 1)"
    counts = f"transform(begins, (at, n) -> struct(terms[at - 1] AS term, bigint({ends} - at) AS tf))"
    # Rows leave the last step without the arrays; a generator copies all that it keeps of a row into each of its rows.
    return (
        rows.select("id", F.inline(fields_of))
        .select("id", "field", "terms", F.expr(f"IF(size(terms) > 0, {begins}, NULL)").alias("begins"))
        .select("id", "field", F.inline(F.expr(counts)))
    )


def term_index(texts: DataFrame, table: str, key: str, fields: list[str]) -> DataFrame:
    """Postings ``(table_name, id, field, term, tf)`` of the given text columns.

    Texts are dealt out by id, before they are split, and counted row by row; their postings are not shuffled. Only those
    of ids that several rows share are added up, by id and term, so a word or an id found everywhere does not gather in one
    task.
    """
    rows = texts.select(F.col(key).cast("string").alias("id"), *fields)
    shared = rows.groupBy("id").count().filter("count > 1").select(F.col("id").alias("_shared"))
    met = F.col("id").eqNullSafe(F.col("_shared"))
    alone = _counted(rows.join(shared, met, "left_anti"), fields)
    added = (
        _counted(rows.join(shared, met, "left_semi"), fields).groupBy("id", "field", "term").agg(F.sum("tf").alias("tf"))
    )
    return alone.unionByName(added).select(F.lit(table).alias("table_name"), "id", "field", "term", "tf")


def save_term_index(postings: DataFrame, table: str, path: str, buckets: int = 256, salts: int = 8) -> None:
    """Store postings as a catalogue table in Spark's own buckets of the term, sorted by it.

    Lookups and joins by term then read the index without a shuffle of it, and a lookup of some terms reads their buckets
    only. A bucket is written by several tasks, chosen by text id, so that a very common term is not one task's work;
    ``pmod(hash(term))`` is Spark's own bucket number, so each of those tasks writes one file.
    """
    (
        postings.withColumns(
            {
                "_bucket": F.expr(f"pmod(hash(term), {buckets})"),
                "_salt": F.pmod(F.xxhash64("id"), F.lit(salts)),
            }
        )
        .repartition(buckets * salts, "_bucket", "_salt")
        .drop("_bucket", "_salt")
        .write.mode("overwrite")
        .bucketBy(buckets, "term")
        .sortBy("term")
        .option("path", path)
        .option("compression", "zstd")
        .saveAsTable(table)
    )


def term_hits(index: DataFrame, query: str) -> DataFrame:
    """Texts that hold any word of the query; only the buckets of its words are read from a saved index."""
    found = index.filter(F.col("term").isin(X.word_list(query)))
    return found.groupBy("table_name", "id", "field").agg(F.sum("tf").alias("hits"))


def term_totals(index: DataFrame) -> DataFrame:
    """Texts and hits of each term; a saved index is aggregated where it lies, without a shuffle."""
    return index.groupBy("term").agg(F.count("*").alias("texts"), F.sum("tf").alias("hits"))


def match_terms(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """Postings, or totals, of the terms that a table of named queries ``(query, term)`` asks for.

    A plain join: with a saved index only the queries move, to the index's buckets or to all executors.
    """
    return wanted.distinct().join(index, "term")


def keyword_search(
    texts: DataFrame, fields: list[str], query: str, mode: str = "any_token"
) -> DataFrame:
    """Rows where any of several text columns matches."""
    joined = texts.withColumn("_text", F.concat_ws("\n", *fields))
    marked = X.with_words(joined, "_text")
    return marked.filter(X.match_sql("_words", query, mode)).drop("_words", "_text")
