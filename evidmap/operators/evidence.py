"""The evidence analytics (A1-A9) and the two trend reports R6 and R7.

All of them aggregate partially before they shuffle. Orders end with the row
key, so that equal counts come out in one order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidmap.functions.text import blank_to_null, count_where, normalise, strip, year_of
from evidmap.operators.relevance import with_value, without_error
from evidmap.schemas import REVIEW_DESIGNS, STUDY_DESIGNS


def treatment_outcome_matrix(extractions: DataFrame) -> DataFrame:
    """A1: frequency and effect directions of each (treatment, outcome)."""
    pairs = without_error(extractions).select(F.explode("treatment_outcomes").alias("pair"))
    rows = pairs.select(
        F.lower("pair.treatment").alias("treatment"),
        F.lower("pair.outcome").alias("outcome"),
        F.col("pair.effect_direction").alias("direction"),
    )
    counted = ("positive", "negative", "neutral", "mixed")
    return (
        rows.groupBy("treatment", "outcome")
        .agg(
            F.count("*").alias("frequency"),
            *[count_where(F.col("direction") == d).alias(d) for d in counted],
        )
        .orderBy(F.desc("frequency"), "treatment", "outcome")
    )


def publication_trends(articles: DataFrame, extractions: DataFrame) -> DataFrame:
    """A2: articles per year with the designs of their extractions.

    Failed extractions are joined too; both sides are unique on ``pubmed_id``.
    """
    dated = with_value(articles, "pub_date").select(
        "pubmed_id", year_of(F.col("pub_date")).alias("year")
    )
    designs = extractions.select("pubmed_id", "study_design")
    design = F.col("study_design")
    return (
        dated.join(designs, "pubmed_id", "left")
        .groupBy("year")
        .agg(
            F.count("*").alias("article_count"),
            count_where(design == "randomized_controlled_trial").alias("rct_count"),
            count_where(design.isin(*REVIEW_DESIGNS)).alias("review_count"),
            count_where(design == "case_report").alias("case_report_count"),
        )
        .orderBy("year")
    )


def _designs_by_year(articles: DataFrame, extractions: DataFrame) -> DataFrame:
    design = F.coalesce(blank_to_null(F.col("study_design")), F.lit("unknown"))
    return (
        with_value(articles, "pub_date")
        .select("pubmed_id", year_of(F.col("pub_date")).alias("year"))
        .join(extractions.select("pubmed_id", design.alias("study_design")), "pubmed_id")
    )


def study_design_over_time(articles: DataFrame, extractions: DataFrame) -> DataFrame:
    """A3 as rows (year, study_design, article_count)."""
    return (
        _designs_by_year(articles, extractions)
        .groupBy("year", "study_design")
        .agg(F.count("*").alias("article_count"))
        .orderBy("year", "study_design")
    )


def study_design_maps(articles: DataFrame, extractions: DataFrame) -> DataFrame:
    """A3 as one row per year with a map design -> count.

    Articles are counted first, so a year's group holds a row per design, whatever the
    designs are.
    """
    counted = _designs_by_year(articles, extractions).groupBy("year", "study_design").agg(
        F.count("*").alias("n")
    )
    entries = F.array_sort(F.collect_list(F.struct("study_design", "n")))
    return (
        counted.groupBy("year").agg(F.map_from_entries(entries).alias("designs")).orderBy("year")
    )


def mesh_cooccurrence(
    articles: DataFrame, min_count: int = 3, block: int = 64
) -> DataFrame:
    """A4: pairs of index terms that share at least ``min_count`` articles.

    An article's distinct terms are cut into blocks of ``block`` terms. A row
    holds one block, or two different ones, so it never makes more than
    ``block``^2 pairs, and the rows of an article with very many terms are
    shuffled apart. That shuffle also counts equal rows: copies of an article
    are paired once, with a weight.
    """
    lowered = F.filter(F.transform("mesh_terms", F.lower), lambda t: t.isNotNull())
    terms = with_value(articles, "mesh_terms").select(
        F.array_sort(F.array_distinct(lowered)).alias("terms")
    )
    size = F.size("terms")
    starts = F.sequence(F.lit(1), size, F.lit(block))
    blocks = terms.select(
        F.when(
            size > 1, F.transform(starts, lambda i: F.slice("terms", i, block))
        ).alias("blocks")
    )
    # The outer form: the inner one would be given a filter that computes the
    # blocks a second time. second = NULL stands for the pairs inside the first block.
    rows = (
        blocks.select(F.posexplode_outer("blocks").alias("place", "first"), "blocks")
        .where(F.col("first").isNotNull())
        .select(
            "first",
            F.explode(
                F.concat(
                    F.array(F.lit(None).cast("array<string>")),
                    F.slice("blocks", F.col("place") + 2, F.size("blocks")),
                )
            ).alias("second"),
        )
        .groupBy("first", "second")
        .agg(F.count("*").alias("weight"))
    )

    def inside(first: Column) -> Column:
        return F.flatten(
            F.transform(
                first,
                lambda a, i: F.transform(
                    F.slice(first, i + 2, F.size(first)), lambda b: _pair(a, b)
                ),
            )
        )

    def between(first: Column, second: Column) -> Column:
        return F.flatten(
            F.transform(first, lambda a: F.transform(second, lambda b: _pair(a, b)))
        )

    pairs = F.when(F.col("second").isNull(), inside(F.col("first"))).otherwise(
        between(F.col("first"), F.col("second"))
    )
    return (
        rows.select(F.explode(pairs).alias("pair"), "weight")
        .groupBy(F.col("pair.term_a").alias("term_a"), F.col("pair.term_b").alias("term_b"))
        .agg(F.sum("weight").alias("co_occurrence_count"))
        .where(F.col("co_occurrence_count") >= min_count)
        .orderBy(F.desc("co_occurrence_count"), "term_a", "term_b")
    )


def _pair(a: Column, b: Column) -> Column:
    return F.struct(a.alias("term_a"), b.alias("term_b"))


def research_geography(authors: DataFrame, articles: DataFrame) -> DataFrame:
    """A5: distinct articles and their years by author country.

    Countries are made distinct per article before the join, so an article
    with very many authors brings one row per country.
    """
    countries = (
        authors.select("pubmed_id", strip(F.col("country")).alias("country"))
        .where(F.col("country") != "")
        .distinct()
    )
    return (
        countries.join(_article_years(articles), "pubmed_id")
        .groupBy("country")
        .agg(
            F.count("*").alias("article_count"),
            F.min("year").alias("earliest_year"),
            F.max("year").alias("latest_year"),
        )
        .orderBy(F.desc("article_count"), "country")
    )


def _article_years(articles: DataFrame) -> DataFrame:
    return articles.select("pubmed_id", year_of(F.col("pub_date")).alias("year"))


def funding_landscape(grants: DataFrame, articles: DataFrame) -> DataFrame:
    """Grants, country and years by agency.

    ``article_count`` counts grant rows; ``distinct_article_count`` does not.
    The country is that of the first grant that has one, in the order of
    (pubmed_id, grant_no). Grants are folded per article before the join.
    """
    return funding_of_parts(funding_parts(grants, articles))


def funding_parts(grants: DataFrame, articles: DataFrame) -> DataFrame:
    """What A6 knows of each agency; parts of different articles can be folded."""
    agency = strip(F.col("agency"))
    country = strip(F.col("country"))
    named = grants.select(
        "pubmed_id", agency.alias("agency"), "country", country.alias("place"), "grant_no"
    ).where(F.col("agency") != "")
    per_article = named.groupBy("pubmed_id", "agency").agg(
        F.count("*").alias("grant_rows"),
        # min_by passes over rows whose order value is NULL
        F.min_by("place", F.when(F.col("place") != "", F.col("grant_no"))).alias("place"),
        # a country of blanks only is shown as such when no better one follows
        F.max((F.col("country") != "") & (F.col("place") == "")).alias("blank_country"),
    )
    first = F.min(F.when(F.col("place").isNotNull(), F.struct("pubmed_id", "place")))
    return (
        per_article.join(_article_years(articles), "pubmed_id")
        .groupBy("agency")
        .agg(
            F.sum("grant_rows").alias("article_count"),
            F.count("*").alias("distinct_article_count"),
            first.alias("first"),
            F.max("blank_country").alias("blank_country"),
            F.min("year").alias("earliest_year"),
            F.max("year").alias("latest_year"),
        )
    )


def funding_of_parts(parts: DataFrame) -> DataFrame:
    country = F.coalesce("first.place", F.when(F.col("blank_country"), F.lit("")))
    return parts.select(
        "agency",
        "article_count",
        "distinct_article_count",
        country.alias("country"),
        "earliest_year",
        "latest_year",
    ).orderBy(F.desc("article_count"), "agency")


# Dimensions reported by default. ``disease_severity`` is no field
# of the stored population, so it stays empty unless a table brings it along.
POPULATION_DIMENSIONS = ("age_group", "sex", "disease_severity")


def population_profile(
    extractions: DataFrame, dimensions: Sequence[str] = POPULATION_DIMENSIONS
) -> DataFrame:
    """A7 as rows (dimension_no, dimension, label, count), labels by count.

    A dimension without any label keeps one row with a NULL label and count 0.
    """
    fields = extractions.schema["population"].dataType.fieldNames()

    def label(name: str) -> Column:
        if name not in fields:
            return F.lit(None).cast("string")
        return normalise(F.col(f"population.{name}"))

    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("dimension_no"),
                F.lit(name).alias("dimension"),
                label(name).alias("label"),
            )
            for i, name in enumerate(dimensions)
        ]
    )
    counts = (
        without_error(extractions)
        .select(F.inline(entries))
        .where(F.col("label").isNotNull())
        .groupBy("dimension_no", "dimension", "label")
        .agg(F.count("*").alias("count"))
    )
    wanted = extractions.sparkSession.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(i).alias("dimension_no"), F.lit(name).alias("dimension"))
                    for i, name in enumerate(dimensions)
                ]
            )
        )
    )
    empty = wanted.join(counts.select("dimension_no").distinct(), "dimension_no", "left_anti")
    return counts.unionByName(
        empty.select(
            "dimension_no",
            "dimension",
            F.lit(None).cast("string").alias("label"),
            F.lit(0).cast("bigint").alias("count"),
        )
    ).orderBy("dimension_no", F.desc("count"), "label")


def table_totals(articles: DataFrame, extractions: DataFrame) -> DataFrame:
    """Row and distinct totals as rows (metric, total)."""
    by_article = articles.agg(
        F.count("*").alias("articles"),
        F.count_distinct("pubmed_id").alias("distinct_articles"),
        count_where(F.col("title").isNull()).alias("null_titles"),
    )
    by_extraction = extractions.agg(
        F.count("*").alias("extractions"),
        F.count("extraction_error").alias("failed_extractions"),
    )
    return as_metrics(by_article).unionByName(as_metrics(by_extraction))


def as_metrics(totals: DataFrame) -> DataFrame:
    """Columns of a one-row frame as rows (metric, total)."""
    return totals.unpivot([], list(totals.columns), "metric", "total")


def result_row_count(result: DataFrame) -> DataFrame:
    """A9"""
    return result.agg(F.count("*").alias("row_count"))


def treatment_shifts(articles: DataFrame, extractions: DataFrame) -> DataFrame:
    """Articles that mention a treatment, by year, and their share of that
    year's articles with a successful extraction."""
    named = F.array_compact(F.transform("treatments", normalise))
    # treatments are made distinct inside the row: no distinct count is needed
    mentions = without_error(extractions).select(
        "pubmed_id", F.array_distinct(named).alias("treatments")
    )
    dated = with_value(articles, "pub_date").select(
        "pubmed_id", year_of(F.col("pub_date")).alias("year")
    )
    joined = dated.join(mentions, "pubmed_id")
    totals = joined.groupBy("year").agg(F.count("*").alias("year_articles"))
    counts = (
        joined.select("year", F.explode_outer("treatments").alias("treatment"))
        .where(F.col("treatment").isNotNull())
        .groupBy("year", "treatment")
        .agg(F.count("*").alias("article_count"))
    )
    share = F.round(F.col("article_count") / F.col("year_articles"), 4)
    return (
        counts.join(totals, "year")
        .select("year", "treatment", "article_count", share.alias("share"))
        .orderBy("year", F.desc("article_count"), "treatment")
    )


def evidence_gaps(
    extractions: DataFrame, min_case_reports: int = 2, max_rct: int = 0
) -> DataFrame:
    """Treatments with many case reports and few trials."""
    named = F.array_compact(F.transform("treatments", normalise))
    mentions = without_error(extractions).select(
        F.explode_outer(F.array_distinct(named)).alias("treatment"), "study_design"
    ).where(F.col("treatment").isNotNull())
    design = F.col("study_design")
    return (
        mentions.groupBy("treatment")
        .agg(
            count_where(design == "case_report").alias("case_report_count"),
            count_where(design == "randomized_controlled_trial").alias("rct_count"),
        )
        .where(
            (F.col("case_report_count") >= min_case_reports) & (F.col("rct_count") <= max_rct)
        )
        .orderBy(F.desc("case_report_count"), "treatment")
    )
