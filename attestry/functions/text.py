"""Keyword matching on text columns, all inside whole-stage code generation.

A text is reduced once to lower-case words with one blank on either side. A
word-bounded phrase is then a plain substring test on that form, so thirty
rules cost one regular-expression pass and thirty substring scans.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words(text: Column) -> Column:
    """``' word word '``: ASCII letters only, lower case; all else separates.

    Non-letters go first, so lower-casing never meets a character whose lower
    case form would turn into an ASCII letter.
    """
    only_letters = F.regexp_replace(text, "[^A-Za-z]+", " ")
    return F.concat(F.lit(" "), F.lower(only_letters), F.lit(" "))


def with_words(frame: DataFrame, text: str, name: str = "_words") -> DataFrame:
    """Add the ``words`` form of a text column.

    It is added as a generated column. The optimiser moves a filter on a computed
    column below the computation by repeating it, once per keyword here; it does
    not do so for generated columns, so the text is prepared once per row.
    """
    return frame.select("*", F.explode(F.array(words(F.col(text)))).alias(name))


def phrase(term: str) -> str:
    """The word form of one search term: ``spdx-sbom`` -> ``spdx sbom``."""
    return " ".join(re.findall("[a-z]+", term.lower()))


def terms_of(query: str) -> list[str]:
    """Split ``'a OR b'`` into its terms."""
    return [t.strip() for t in re.split(r"\s+OR\s+", query) if t.strip()]


def word_list(query: str) -> list[str]:
    """All single words of a query, first occurrence order, without ``or``."""
    found = [w for t in terms_of(query) for w in phrase(t).split()]
    return [w for w in dict.fromkeys(found) if w != "or"]


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def needles(query: str, mode: str = "phrase") -> list[str]:
    """What to look for in the ``words`` form.

    ``phrase`` wants a term's words next to each other; ``any_token`` is
    content with any single word of any term.
    """
    if mode == "phrase":
        return [phrase(t) for t in terms_of(query)]
    if mode == "any_token":
        return word_list(query)
    raise ValueError(f"unknown match mode: {mode}")


def match_sql(words_column: str, query: str, mode: str = "phrase") -> str:
    """The test as SQL text over a ``words`` column; see ``matches``."""
    tests = [f"contains({words_column}, ' {n} ')" for n in needles(query, mode)]
    return f"coalesce({' OR '.join(tests)}, false)"


def matches(word_text: Column, query: str, mode: str = "phrase") -> Column:
    """True when the text holds any term of the query. A NULL text matches nothing."""
    hit = any_of([F.contains(word_text, F.lit(f" {n} ")) for n in needles(query, mode)])
    return F.coalesce(hit, F.lit(False))


def known_words_sql(words_column: str, queries: list[str], mode: str = "phrase") -> str:
    """The words of a text that occur in any of the queries, each once.

    One pass over a long text with a hash lookup per word. Many rules are then
    tried against this short list by ``listed_match_sql`` instead of scanning the
    text once per rule.
    """
    vocabulary = sorted({w for q in queries for n in needles(q, mode) for w in n.split()})
    listed = ", ".join(f"'{w}'" for w in vocabulary)
    return f"array_intersect(split({words_column}, ' '), array({listed}))"


def listed_match_sql(
    known_column: str, words_column: str, query: str, mode: str = "phrase"
) -> str:
    """The test of ``matches`` over the known words of a text.

    A single word is decided by the list. A longer phrase scans the text only if
    all its words are in the list.
    """
    tests = []
    for needle in needles(query, mode):
        parts = [f"array_contains({known_column}, '{w}')" for w in dict.fromkeys(needle.split())]
        if " " in needle:
            parts.append(f"contains({words_column}, ' {needle} ')")
        tests.append("(" + " AND ".join(parts) + ")")
    return f"coalesce({' OR '.join(tests)}, false)"


def extension_sql(name: str, extensions: list[str]) -> str:
    """File-name ending test without regard to case, as SQL; NULL stays NULL."""
    return " OR ".join(f"endswith(lower(`{name}`), '.{e}')" for e in extensions)


def tokens(text: Column) -> Column:
    """The words of a text as an array (empty for a text without letters)."""
    return F.array_remove(F.split(F.trim(words(text)), " "), "")


def term_frequency(word_text: Column, word: str) -> Column:
    """Occurrences of one word in the ``words`` form."""
    return F.regexp_count(word_text, F.lit(f" {word}(?= )"))


def word_count(word_text: Column) -> Column:
    """Number of words in the ``words`` form."""
    return F.regexp_count(word_text, F.lit(" [a-z]"))
