"""Catalogue: report queries (R1-R5) and dashboard views (V1-V6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from evidmap.operators import evidence, reports
from evidmap.plans import queries_evidence as analytics
from evidmap.plans.catalog import query
from evidmap.plans.oracle import with_tables
from evidmap.sources import testdata

_SUCCESS = "coalesce(extraction_error, '') = '' AND len(treatment_outcomes) > 0"
_FAILURE = "extraction_error <> ''"
_SAMPLE = """SELECT pubmed_id, array_to_string(treatments, '|') AS treatments,
  array_to_string(outcomes, '|') AS outcomes,
  array_to_string(list_transform(treatment_outcomes,
    lambda p: p.treatment || '>' || p.outcome || ':' || p.effect_direction), '|')
    AS treatment_outcomes,
  study_design, extraction_confidence"""


def _flat(df):
    """Arrays as text, so that rows compare by plain values."""
    pair = F.transform(
        "treatment_outcomes",
        lambda p: F.concat(
            p["treatment"], F.lit(">"), p["outcome"], F.lit(":"), p["effect_direction"]
        ),
    )
    return (
        df.withColumn("treatments", F.array_join("treatments", "|"))
        .withColumn("outcomes", F.array_join("outcomes", "|"))
        .withColumn("treatment_outcomes", F.array_join(pair, "|"))
    )


@query(
    "r1_success_sample",
    with_tables(
        "extractions",
        f"{_SAMPLE}, extraction_error FROM extractions WHERE {_SUCCESS} ORDER BY pubmed_id LIMIT 3",
    ),
)
def r1(spark, folder):
    return _flat(reports.success_sample(testdata.extractions(spark, folder)))


@query(
    "r2_failure_sample",
    with_tables(
        "extractions",
        f"{_SAMPLE}, extraction_error FROM extractions WHERE {_FAILURE} ORDER BY pubmed_id LIMIT 3",
    ),
)
def r2(spark, folder):
    return _flat(reports.failure_sample(testdata.extractions(spark, folder)))


def _state(success: str, failure: str) -> str:
    return with_tables(
        "articles extractions",
        f"""SELECT (SELECT count(*) FROM articles) AS total_articles,
  (SELECT count(*) FROM extractions WHERE {success}) AS extraction_success,
  (SELECT count(*) FROM extractions WHERE {failure}) AS extraction_errors,
  (SELECT count(DISTINCT p_type) FROM part) AS analytics_results""",
    )


def _results(spark, folder):
    """A table with one row per saved result; part types stand for their names."""
    return testdata.table(spark, folder, "part").select("p_type").distinct()


@query("r3_store_state", _state(_SUCCESS, _FAILURE))
def r3(spark, folder):
    return reports.store_state(
        testdata.articles(spark, folder),
        testdata.extractions(spark, folder),
        _results(spark, folder),
    )


@query(
    "r3_store_state_null_errors",
    _state("extraction_error IS NULL", "extraction_error IS NOT NULL"),
)
def r3_nulls(spark, folder):
    return reports.store_state(
        testdata.articles(spark, folder),
        testdata.extractions(spark, folder),
        _results(spark, folder),
        need_pairs=False,
    )


@query(
    "r4_output_summary",
    with_tables(
        "articles authors extractions term_pairs",
        f"""SELECT (SELECT count(*) FROM (SELECT DISTINCT p.treatment, p.outcome FROM (
    SELECT unnest(treatment_outcomes) AS p FROM extractions WHERE {_SUCCESS})))
    AS treatment_outcome_pairs,
  (SELECT CAST(year(max(pub_date)) - year(min(pub_date)) + 1 AS INTEGER) FROM articles)
    AS years_of_data,
  (SELECT count(*) FROM term_pairs WHERE co_occurrence_count >= 3) AS mesh_cooccurrence_pairs,
  (SELECT count(DISTINCT country) FROM authors) AS unique_countries""",
    ),
)
def r4(spark, folder):
    return reports.output_summary(
        testdata.articles(spark, folder),
        testdata.authors(spark, folder),
        testdata.extractions(spark, folder),
        evidence.mesh_cooccurrence(testdata.line_articles(spark, folder)),
    )


@query(
    "r5_end_to_end_sample",
    with_tables(
        "articles extractions",
        f"""{_SAMPLE}, title, journal, strftime(pub_date, '%Y-%m-%d') AS pub_date,
  sex, age_group, disease_stage, sample_size,
  strftime(extracted_ts, '%Y-%m-%d %H:%M:%S') AS extracted_ts
FROM articles JOIN extractions USING (pubmed_id) WHERE {_SUCCESS} ORDER BY pubmed_id LIMIT 3""",
    ),
)
def r5(spark, folder):
    sample = reports.end_to_end_sample(
        testdata.articles(spark, folder), testdata.extractions(spark, folder)
    )
    flat = _flat(sample)
    population = ["sex", "age_group", "disease_stage", "sample_size"]
    plain = [c for c in flat.columns if c not in ("population", "pub_date", "extracted_ts")]
    return flat.select(
        *plain,
        *[F.col(f"population.{c}").alias(c) for c in population],
        F.date_format("pub_date", "yyyy-MM-dd").alias("pub_date"),
        F.date_format("extracted_ts", "yyyy-MM-dd HH:mm:ss").alias("extracted_ts"),
    )


@query(
    "v1_heat_map",
    with_tables(
        "matrix",
        """, top AS (SELECT treatment FROM matrix GROUP BY treatment
  ORDER BY sum(frequency) DESC, treatment LIMIT 20),
outcomes AS (SELECT DISTINCT outcome FROM matrix)
SELECT treatment, outcome, coalesce(frequency, 0) AS frequency
FROM top CROSS JOIN outcomes LEFT JOIN matrix USING (treatment, outcome)""",
    ),
)
def v1(spark, folder):
    return reports.heat_map(analytics.a1(spark, folder), top=20)


@query(
    "v2_design_breakdown",
    with_tables(
        "articles extractions",
        """, designs AS (SELECT * FROM (VALUES
  ('rct_count', ['randomized_controlled_trial']),
  ('review_count', ['systematic_review', 'meta_analysis', 'narrative_review']),
  ('case_report_count', ['case_report'])) d(design, members))
SELECT CAST(year(pub_date) AS INTEGER) AS year, design,
  count(*) FILTER (WHERE list_contains(members, study_design)) AS articles
FROM articles LEFT JOIN extractions USING (pubmed_id) CROSS JOIN designs
WHERE pub_date IS NOT NULL GROUP BY 1, 2""",
    ),
)
def v2(spark, folder):
    return reports.design_breakdown(analytics.a2(spark, folder))


@query(
    "v3_top_countries",
    with_tables(
        "geography", "SELECT * FROM geography ORDER BY article_count DESC, country LIMIT 30"
    ),
)
def v3(spark, folder):
    return reports.top_countries(analytics.a5(spark, folder))


@query(
    "v4_population_bars",
    with_tables(
        "profile", "SELECT dimension, label, count FROM profile WHERE label IS NOT NULL"
    ),
)
def v4(spark, folder):
    return reports.population_bars(analytics.a7(spark, folder))


@query(
    "v5_top_agencies",
    with_tables("funding", "SELECT * FROM funding ORDER BY article_count DESC, agency LIMIT 30"),
)
def v5(spark, folder):
    return reports.top_agencies(analytics.a6(spark, folder))


@query(
    "v6_top_pairs",
    with_tables(
        "matrix", "SELECT * FROM matrix ORDER BY frequency DESC, treatment, outcome LIMIT 50"
    ),
)
def v6(spark, folder):
    return reports.top_pairs(analytics.a1(spark, folder))
