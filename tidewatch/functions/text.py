"""Keyword matching on report text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The usual English stop words of search analyzers.
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it",
    "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these",
    "they", "this", "to", "was", "will", "with",
]


def terms(text: Column) -> Column:
    """Distinct lower-case words of the whole text, without stop words."""
    words = F.array_distinct(F.split(F.lower(text), r"[^a-z0-9]+"))
    return F.array_except(words, F.array(*[F.lit(w) for w in ["", *STOP_WORDS]]))


def matches_any(text: Column, query: str) -> Column:
    return F.arrays_overlap(terms(text), terms(F.lit(query)))


def matches_all(text: Column, query: str) -> Column:
    return F.size(F.array_except(terms(F.lit(query)), terms(text))) == 0
