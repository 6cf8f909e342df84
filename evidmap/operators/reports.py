"""Report queries (R1-R5) and dashboard views (V1-V6)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidmap.operators.relevance import failed, succeeded

SAMPLE_COLUMNS = (
    "pubmed_id",
    "treatments",
    "outcomes",
    "treatment_outcomes",
    "study_design",
    "extraction_confidence",
    "extraction_error",
)


def success_sample(extractions: DataFrame, rows: int = 3) -> DataFrame:
    """R1"""
    return _sample(extractions, succeeded(), rows)


def failure_sample(extractions: DataFrame, rows: int = 3) -> DataFrame:
    """R2"""
    return _sample(extractions, failed(), rows)


def _sample(extractions: DataFrame, condition: Column, rows: int) -> DataFrame:
    kept = extractions.where(condition).select(*SAMPLE_COLUMNS)
    return kept.orderBy("pubmed_id").limit(rows)


def _one_row(*totals: DataFrame) -> DataFrame:
    """One-row frames side by side, without a cross join."""
    wide = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), totals)
    return wide.agg(*[F.max(c).alias(c) for c in wide.columns])


def store_state(
    articles: DataFrame, extractions: DataFrame, results: DataFrame, need_pairs: bool = True
) -> DataFrame:
    """Articles, successes, errors and saved results in one row.

    With ``need_pairs`` a success has at least one pair and blank errors count
    as none; without it a success is any extraction whose error is NULL.
    """
    error = F.col("extraction_error")
    good, bad = (succeeded(), failed()) if need_pairs else (error.isNull(), error.isNotNull())
    return _one_row(
        articles.agg(F.count("*").alias("total_articles")),
        extractions.agg(
            F.count_if(good).alias("extraction_success"),
            F.count_if(bad).alias("extraction_errors"),
        ),
        results.agg(F.count("*").alias("analytics_results")),
    )


def output_summary(
    articles: DataFrame, authors: DataFrame, extractions: DataFrame, term_pairs: DataFrame
) -> DataFrame:
    """R4 in one row; pairs are compared as written, case included."""
    pairs = (
        extractions.where(succeeded())
        .select(F.explode("treatment_outcomes").alias("pair"))
        .select("pair.treatment", "pair.outcome")
        .distinct()
    )
    years = F.year(F.max("pub_date")) - F.year(F.min("pub_date")) + 1
    return _one_row(
        pairs.agg(F.count("*").alias("treatment_outcome_pairs")),
        articles.agg(years.alias("years_of_data")),
        term_pairs.agg(F.count("*").alias("mesh_cooccurrence_pairs")),
        authors.agg(F.count_distinct("country").alias("unique_countries")),
    )


def end_to_end_sample(articles: DataFrame, extractions: DataFrame, rows: int = 3) -> DataFrame:
    """Successful extractions with the metadata of their article."""
    found = extractions.where(succeeded()).select(
        "pubmed_id",
        "treatments",
        "outcomes",
        "treatment_outcomes",
        "study_design",
        "population",
        "extraction_confidence",
        "extracted_ts",
    )
    described = articles.select("pubmed_id", "title", "journal", "pub_date")
    return found.join(described, "pubmed_id").orderBy("pubmed_id").limit(rows)


def heat_map(matrix: DataFrame, top: int = 20) -> DataFrame:
    """V1: frequency of every outcome for the ``top`` treatments, 0 where they never meet.

    The unbounded side (outcomes) stays in rows: treatments are pivoted by rank,
    so the number of columns is ``top`` whatever the data.
    """
    totals = (
        matrix.groupBy("treatment")
        .agg(F.sum("frequency").alias("total"))
        .orderBy(F.desc("total"), "treatment")
        .limit(top)
    )
    # at most ``top`` rows, which also bounds the broadcasts below
    in_order = F.sort_array(F.collect_list(F.struct(-F.col("total"), "treatment")))
    ranked = totals.agg(F.transform(in_order, lambda t: t["treatment"]).alias("names")).select(
        F.posexplode("names").alias("rank", "treatment")
    )
    cells = [
        F.coalesce(F.sum(F.when(F.col("rank") == r, F.col("frequency"))), F.lit(0)).alias(f"r{r}")
        for r in range(top)
    ]
    by_outcome = (
        matrix.join(F.broadcast(ranked), "treatment", "left").groupBy("outcome").agg(*cells)
    )
    long = by_outcome.select(
        "outcome", F.posexplode(F.array(*[f"r{r}" for r in range(top)])).alias("rank", "frequency")
    )
    return long.join(F.broadcast(ranked), "rank").select("treatment", "outcome", "frequency")


def design_breakdown(trends: DataFrame) -> DataFrame:
    """V2: A2's design counts in long form."""
    return trends.unpivot(
        "year", ["rct_count", "review_count", "case_report_count"], "design", "articles"
    )


def top_countries(geography: DataFrame, rows: int = 30) -> DataFrame:
    """V3"""
    return geography.orderBy(F.desc("article_count"), "country").limit(rows)


def population_bars(profile: DataFrame) -> DataFrame:
    """V4: the labels to draw; dimensions without labels have none."""
    return profile.where(F.col("label").isNotNull()).select("dimension", "label", "count")


def top_agencies(funding: DataFrame, rows: int = 30) -> DataFrame:
    """V5: 30 for the chart, 50 for the table."""
    return funding.orderBy(F.desc("article_count"), "agency").limit(rows)


def top_pairs(matrix: DataFrame, rows: int = 50) -> DataFrame:
    """V6"""
    return matrix.orderBy(F.desc("frequency"), "treatment", "outcome").limit(rows)
