"""Tokenisers. Each returns an array column; none leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commentlens import rules
from commentlens.functions.text import col


def tokenize_words(c: Column | str, stop_words: list[str] = rules.ALL_STOP_WORDS) -> Column:
    """Distinct lower-case words of more than two letters that are no stop words."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(col(c)), F.lit("[a-zA-Z']+"), F.lit(0)))
    return F.filter(words, lambda w: (F.length(w) > 2) & ~w.isin(stop_words))


def keyword_words(c: Column | str) -> Column:
    """Distinct lower-case words of three or more letters."""
    return F.array_distinct(
        F.regexp_extract_all(F.lower(col(c)), F.lit("[a-zA-Z]{3,}"), F.lit(0))
    )


def unigrams(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(col(c)), F.lit("[\\p{L}\\p{N}_]{2,}"), F.lit(0))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, also where a lambda refers to it."""
    return F.get(F.transform(F.array(value), use), 0)


def bigrams(tokens: Column) -> Column:
    """Neighbouring tokens joined by a space."""
    pairs = F.zip_with(
        tokens, F.slice(tokens, 2, F.size(tokens)), lambda a, b: F.concat_ws(" ", a, b)
    )
    return F.slice(pairs, 1, F.greatest(F.size(tokens) - 1, F.lit(0)))


def tokenize_tfidf(c: Column | str, ngram_max: int = rules.NGRAM_MAX) -> Column:
    if ngram_max == 1:
        return unigrams(c)
    return _bound(unigrams(c), lambda tokens: F.concat(tokens, bigrams(tokens)))


def term_counts(terms: Column) -> Column:
    """``array<struct<term, tf>>`` of one text, counted inside the row: no shuffle by document.

    Equal terms are neighbours after sorting; each run's length is its term's frequency.
    """

    def run_starts(ordered: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(ordered) - 1)
        first = F.filter(
            places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
        )
        return F.when(F.size(ordered) > 0, first).otherwise(F.array().cast("array<int>"))

    def runs(ordered: Column, starts: Column) -> Column:
        return F.transform(
            starts,
            lambda i, k: F.struct(
                F.get(ordered, i).alias("term"),
                (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - i).alias("tf"),
            ),
        )

    return _bound(
        F.sort_array(terms),
        lambda ordered: _bound(run_starts(ordered), lambda starts: runs(ordered, starts)),
    )
