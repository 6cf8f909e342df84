"""Topic relevance of records (F1-F3) and extraction outcome predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidmap.functions.text import blank_to_null
from evidmap.schemas import CONDITION_KEYWORDS, CONDITION_TERMS


def matches_terms(mesh_terms: Column, terms: Sequence[str] = CONDITION_TERMS) -> Column:
    """a whole index term is one of ``terms``, whatever the case."""
    wanted = F.array(*[F.lit(t.lower()) for t in terms])
    # NULL elements make the overlap NULL when nothing matches
    return F.coalesce(F.arrays_overlap(F.transform(mesh_terms, F.lower), wanted), F.lit(False))


def matches_keywords(
    title: Column, abstract: Column, keywords: Sequence[str] = CONDITION_KEYWORDS
) -> Column:
    """a keyword occurs in title or abstract, whatever the case."""
    text = F.lower(F.concat_ws(" ", blank_to_null(title), blank_to_null(abstract)))
    return reduce(lambda a, b: a | b, [text.contains(k) for k in keywords])


def is_relevant(
    terms: Sequence[str] = CONDITION_TERMS, keywords: Sequence[str] = CONDITION_KEYWORDS
) -> Column:
    """F3 as a predicate over article columns."""
    return matches_terms(F.col("mesh_terms"), terms) | matches_keywords(
        F.col("title"), F.col("abstract"), keywords
    )


def relevant_articles(articles: DataFrame, **vocabulary) -> DataFrame:
    """F3"""
    return articles.where(is_relevant(**vocabulary))


def with_value(df: DataFrame, *columns: str) -> DataFrame:
    """rows where none of ``columns`` is NULL.

    As separate conditions, which a Parquet scan takes over; ``dropna`` is not.
    """
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def without_error(extractions: DataFrame) -> DataFrame:
    """F4 as the analytics use it: only a NULL error counts as success."""
    return extractions.where(F.col("extraction_error").isNull())


def succeeded() -> Column:
    """F5 as the reports use it: no error text, and at least one pair."""
    return blank_to_null(F.col("extraction_error")).isNull() & (
        F.coalesce(F.size("treatment_outcomes"), F.lit(0)) > 0
    )


def failed() -> Column:
    """an error text that is not empty."""
    return blank_to_null(F.col("extraction_error")).isNotNull()
