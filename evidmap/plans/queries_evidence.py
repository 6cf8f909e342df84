"""Catalogue: analytics (A), quality checks (C), trend reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidmap.operators import evidence, quality
from evidmap.plans.catalog import query
from evidmap.plans.oracle import with_tables
from evidmap.sources import testdata


@query("a1_treatment_outcome_matrix", with_tables("matrix", "SELECT * FROM matrix"))
def a1(spark, folder):
    return evidence.treatment_outcome_matrix(testdata.line_extractions(spark, folder))


PUBLICATION_TRENDS = with_tables(
    "articles extractions",
    """SELECT CAST(year(pub_date) AS INTEGER) AS year, count(*) AS article_count,
  count(*) FILTER (WHERE study_design = 'randomized_controlled_trial') AS rct_count,
  count(*) FILTER (WHERE study_design IN ('systematic_review', 'meta_analysis',
    'narrative_review')) AS review_count,
  count(*) FILTER (WHERE study_design = 'case_report') AS case_report_count
FROM articles LEFT JOIN extractions USING (pubmed_id) WHERE pub_date IS NOT NULL GROUP BY 1""",
)


@query("a2_publication_trends", PUBLICATION_TRENDS)
def a2(spark, folder):
    return evidence.publication_trends(
        testdata.articles(spark, folder), testdata.extractions(spark, folder)
    )


_A3 = """SELECT CAST(year(pub_date) AS INTEGER) AS year,
  coalesce(nullif(study_design, ''), 'unknown') AS study_design, count(*) AS article_count
FROM articles JOIN extractions USING (pubmed_id) WHERE pub_date IS NOT NULL GROUP BY 1, 2"""


@query("a3_study_design_over_time", with_tables("articles extractions", _A3))
def a3(spark, folder):
    return evidence.study_design_over_time(
        testdata.articles(spark, folder), testdata.extractions(spark, folder)
    )


@query("a3_study_design_maps", with_tables("articles extractions", _A3))
def a3_maps(spark, folder):
    maps = evidence.study_design_maps(
        testdata.articles(spark, folder), testdata.extractions(spark, folder)
    )
    return maps.select("year", F.explode("designs").alias("study_design", "article_count"))


A4_MIN_COUNT = 40


@query(
    "a4_mesh_cooccurrence",
    with_tables(
        "term_pairs", f"SELECT * FROM term_pairs WHERE co_occurrence_count >= {A4_MIN_COUNT}"
    ),
)
def a4(spark, folder):
    return evidence.mesh_cooccurrence(testdata.line_articles(spark, folder), A4_MIN_COUNT)


@query("a5_research_geography", with_tables("geography", "SELECT * FROM geography"))
def a5(spark, folder):
    return evidence.research_geography(
        testdata.authors(spark, folder), testdata.articles(spark, folder)
    )


@query("a6_funding_landscape", with_tables("funding", "SELECT * FROM funding"))
def a6(spark, folder):
    return evidence.funding_landscape(
        testdata.grants(spark, folder), testdata.articles(spark, folder)
    )


@query("a7_population_profile", with_tables("profile", "SELECT * FROM profile"))
def a7(spark, folder):
    return evidence.population_profile(testdata.extractions(spark, folder))


@query(
    "a7_population_profile_stored_fields",
    with_tables(
        "extractions",
        """SELECT 0 AS dimension_no, 'disease_stage' AS dimension, lower(disease_stage) AS label,
  count(*) AS count FROM extractions
WHERE extraction_error IS NULL AND disease_stage <> '' GROUP BY 3
UNION ALL SELECT 1, 'special_population', NULL, 0""",
    ),
)
def a7_stored(spark, folder):
    return evidence.population_profile(
        testdata.extractions(spark, folder), ("disease_stage", "special_population")
    )


@query(
    "a8_table_totals",
    with_tables(
        "articles extractions",
        """SELECT 'articles' AS metric, count(*) AS total FROM articles
UNION ALL SELECT 'distinct_articles', count(DISTINCT pubmed_id) FROM articles
UNION ALL SELECT 'null_titles', count(*) FROM articles WHERE title IS NULL
UNION ALL SELECT 'extractions', count(*) FROM extractions
UNION ALL SELECT 'failed_extractions', count(extraction_error) FROM extractions""",
    ),
)
def a8(spark, folder):
    return evidence.table_totals(
        testdata.articles(spark, folder), testdata.extractions(spark, folder)
    )


@query(
    "a9_result_row_count",
    with_tables("geography", "SELECT count(*) AS row_count FROM geography"),
)
def a9(spark, folder):
    return evidence.result_row_count(a5(spark, folder))


_MENTIONS = r"""
mentions AS (
  SELECT DISTINCT pubmed_id, study_design,
    lower(regexp_replace(unnest(treatments), '^\s+|\s+$', '', 'g')) AS treatment
  FROM extractions WHERE extraction_error IS NULL)"""


@query(
    "r6_treatment_shifts",
    with_tables(
        "articles extractions",
        "",
    ).rstrip()
    + ","
    + _MENTIONS
    + """,
totals AS (
  SELECT year(pub_date) AS year, count(*) AS n FROM articles JOIN extractions USING (pubmed_id)
  WHERE pub_date IS NOT NULL AND extraction_error IS NULL GROUP BY 1)
SELECT CAST(year(pub_date) AS INTEGER) AS year, treatment, count(*) AS article_count,
  round(count(*) / any_value(n), 4) AS share
FROM mentions JOIN articles USING (pubmed_id) JOIN totals ON totals.year = year(pub_date)
WHERE treatment <> '' GROUP BY 1, 2""",
)
def r6(spark, folder):
    return evidence.treatment_shifts(
        testdata.articles(spark, folder), testdata.extractions(spark, folder)
    )


@query(
    "r7_evidence_gaps",
    with_tables("extractions", "").rstrip()
    + ","
    + _MENTIONS
    + """
SELECT treatment, count(*) FILTER (WHERE study_design = 'case_report') AS case_report_count,
  count(*) FILTER (WHERE study_design = 'randomized_controlled_trial') AS rct_count
FROM mentions WHERE treatment <> '' GROUP BY 1
HAVING case_report_count >= 2 AND rct_count <= 0""",
)
def r7(spark, folder):
    return evidence.evidence_gaps(testdata.extractions(spark, folder))


C1_SQL = """
SELECT 'extraction_failure_rate' AS check_name,
  coalesce(count(extraction_error) / nullif(count(*), 0) < 0.2, false) AS passed,
  unnest(['total', 'failed', 'failure_rate']) AS metric,
  unnest([CAST(count(*) AS DOUBLE), CAST(count(extraction_error) AS DOUBLE),
    round(count(extraction_error) / nullif(count(*), 0), 3)]) AS value
FROM extractions"""
C2_SQL = """
SELECT 'minimum_article_volume' AS check_name, count(*) >= 500 AS passed,
  'article_count' AS metric, CAST(count(*) AS DOUBLE) AS value FROM articles"""
C3_SQL = """
SELECT 'no_duplicate_ids' AS check_name, count(*) = count(DISTINCT pubmed_id) AS passed,
  unnest(['total', 'unique_pubmed_id', 'duplicates']) AS metric,
  unnest([CAST(count(*) AS DOUBLE), CAST(count(DISTINCT pubmed_id) AS DOUBLE),
    CAST(count(*) - count(DISTINCT pubmed_id) AS DOUBLE)]) AS value FROM articles"""
C4_SQL = """
SELECT 'no_null_titles' AS check_name, count(*) FILTER (WHERE title IS NULL) = 0 AS passed,
  'null_titles' AS metric, CAST(count(*) FILTER (WHERE title IS NULL) AS DOUBLE) AS value
FROM articles"""
C5_SQL = """
SELECT 'confidence_range' AS check_name,
  count(*) FILTER (WHERE extraction_confidence < 0 OR extraction_confidence > 1) = 0 AS passed,
  'out_of_range_confidence' AS metric,
  CAST(count(*) FILTER (WHERE extraction_confidence < 0 OR extraction_confidence > 1)
    AS DOUBLE) AS value
FROM extractions"""


@query("c1_extraction_failure_rate", with_tables("extractions", C1_SQL))
def c1(spark, folder):
    return quality.failure_rate_check(testdata.extractions(spark, folder))


@query("c2_minimum_article_volume", with_tables("articles", C2_SQL))
def c2(spark, folder):
    return quality.article_volume_check(testdata.articles(spark, folder))


@query(
    "c3_no_duplicate_ids",
    with_tables("authors", C3_SQL.replace("FROM articles", "FROM authors")),
)
def c3(spark, folder):
    # the author rows repeat their article's id, so that duplicates are found
    authors = testdata.authors(spark, folder).withColumnRenamed("country", "title")
    return quality.duplicate_id_check(authors)


@query("c4_no_null_titles", with_tables("articles", C4_SQL))
def c4(spark, folder):
    return quality.null_title_check(testdata.articles(spark, folder))


@query("c5_confidence_range", with_tables("extractions", C5_SQL))
def c5(spark, folder):
    return quality.confidence_range_check(testdata.extractions(spark, folder))


@query(
    "c_all_checks",
    with_tables(
        "articles extractions", "\nUNION ALL".join([C1_SQL, C2_SQL, C3_SQL, C4_SQL, C5_SQL])
    ),
)
def all_checks(spark, folder):
    return quality.run_checks(
        testdata.articles(spark, folder), testdata.extractions(spark, folder)
    )
