"""Data-quality checks (C1-C5) as rows (check_name, passed, metric, value).

``value`` is a double; a check reports one row per metric. All checks of a table
are made from one pass over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidmap.functions.text import count_where

# Thresholds.
MAX_FAILURE_RATE = 0.2
MIN_ARTICLES = 500


def _entries(name: str, passed: Column, **metrics: Column) -> list[Column]:
    return [
        F.struct(
            F.lit(name).alias("check_name"),
            passed.alias("passed"),
            F.lit(metric).alias("metric"),
            value.cast("double").alias("value"),
        )
        for metric, value in metrics.items()
    ]


def _report(totals: DataFrame, *checks: list[Column]) -> DataFrame:
    return totals.select(F.inline(F.array(*[entry for check in checks for entry in check])))


def _article_totals(articles: DataFrame) -> DataFrame:
    """Totals that no check uses are not computed."""
    return articles.agg(
        F.count("*").alias("articles"),
        F.count_distinct("pubmed_id").alias("ids"),
        count_where(F.col("title").isNull()).alias("null_titles"),
    )


def _extraction_totals(extractions: DataFrame) -> DataFrame:
    confidence = F.col("extraction_confidence")
    return extractions.agg(
        F.count("*").alias("extractions"),
        F.count("extraction_error").alias("failed"),
        count_where((confidence < 0) | (confidence > 1)).alias("out_of_range"),
    )


def _failure_rate() -> list[Column]:
    total, failed = F.col("extractions"), F.col("failed")
    rate = F.try_divide(failed, total)
    return _entries(
        "extraction_failure_rate",
        F.coalesce(rate < MAX_FAILURE_RATE, F.lit(False)),
        total=total,
        failed=failed,
        failure_rate=F.round(rate, 3),
    )


def _volume(minimum: int) -> list[Column]:
    count = F.col("articles")
    return _entries("minimum_article_volume", count >= minimum, article_count=count)


def _duplicates() -> list[Column]:
    total, ids = F.col("articles"), F.col("ids")
    return _entries(
        "no_duplicate_ids", total == ids, total=total, unique_pubmed_id=ids, duplicates=total - ids
    )


def _null_titles() -> list[Column]:
    nulls = F.col("null_titles")
    return _entries("no_null_titles", nulls == 0, null_titles=nulls)


def _confidence_range() -> list[Column]:
    outside = F.col("out_of_range")
    return _entries("confidence_range", outside == 0, out_of_range_confidence=outside)


def failure_rate_check(extractions: DataFrame) -> DataFrame:
    """Fewer than 20 % failed; no extraction at all does not pass."""
    return _report(_extraction_totals(extractions), _failure_rate())


def article_volume_check(articles: DataFrame, minimum: int = MIN_ARTICLES) -> DataFrame:
    """C2"""
    return _report(_article_totals(articles), _volume(minimum))


def duplicate_id_check(articles: DataFrame) -> DataFrame:
    """C3"""
    return _report(_article_totals(articles), _duplicates())


def null_title_check(articles: DataFrame) -> DataFrame:
    """C4"""
    return _report(_article_totals(articles), _null_titles())


def confidence_range_check(extractions: DataFrame) -> DataFrame:
    """A NULL confidence passes."""
    return _report(_extraction_totals(extractions), _confidence_range())


def run_checks(articles: DataFrame, extractions: DataFrame) -> DataFrame:
    """All five checks, one pass over each table."""
    return _report(
        _article_totals(articles), _volume(MIN_ARTICLES), _duplicates(), _null_titles()
    ).unionByName(_report(_extraction_totals(extractions), _failure_rate(), _confidence_range()))
