"""Analytics (A, R6, R7), quality checks (C), reports and views (R, V)."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from evidmap.operators import evidence, quality, reports
from evidmap.schemas import EXTRACTION

PAIRS = "pubmed_id string, treatment_outcomes array<struct<treatment:string,outcome:string,effect_direction:string>>, extraction_error string"


def with_pairs(spark, *rows):
    return spark.createDataFrame([(str(i), pairs, error) for i, (pairs, error) in enumerate(rows)], PAIRS)


def test_matrix(spark):
    frame = with_pairs(
        spark,
        ([("dienogest", "pain", "positive"), ("Dienogest", "PAIN", "mixed")], None),
        ([("dienogest", "pain", "unknown")], None),
        ([("surgery", "recurrence", "negative")], None),
        ([("surgery", "recurrence", "neutral")], "LLM timeout"),
        ([(" surgery", "recurrence", "neutral")], None),
        ([], None),
        (None, None),
    )
    found = [tuple(r) for r in evidence.treatment_outcome_matrix(frame).collect()]
    assert found == [
        ("dienogest", "pain", 3, 1, 0, 0, 1),
        (" surgery", "recurrence", 1, 0, 0, 1, 0),
        ("surgery", "recurrence", 1, 0, 1, 0, 0),
    ]
    assert evidence.treatment_outcome_matrix(frame.limit(0)).count() == 0


def articles(spark, days):
    return spark.createDataFrame(
        [(str(i), d) for i, d in enumerate(days)], "pubmed_id string, pub_date date"
    )


def designs(spark, entries):
    return spark.createDataFrame(entries, "pubmed_id string, study_design string, extraction_error string")


def test_trends_and_designs(spark):
    days = [date(2020, 1, 1), date(2020, 5, 5), date(2021, 1, 1), date(2021, 2, 2), None, date(2019, 1, 1)]
    found = designs(
        spark,
        [
            ("0", "randomized_controlled_trial", None), ("1", "meta_analysis", "failed all the same"),
            ("2", "case_report", None), ("3", "", None), ("4", "case_report", None), ("9", "other", None),
        ],
    )
    table = articles(spark, days)
    assert [tuple(r) for r in evidence.publication_trends(table, found).collect()] == [
        (2019, 1, 0, 0, 0), (2020, 2, 1, 1, 0), (2021, 2, 0, 0, 1),
    ]
    assert [tuple(r) for r in evidence.study_design_over_time(table, found).collect()] == [
        (2020, "meta_analysis", 1), (2020, "randomized_controlled_trial", 1),
        (2021, "case_report", 1), (2021, "unknown", 1),
    ]
    assert [tuple(r) for r in evidence.study_design_maps(table, found).collect()] == [
        (2020, {"meta_analysis": 1, "randomized_controlled_trial": 1}),
        (2021, {"case_report": 1, "unknown": 1}),
    ]
    long = reports.design_breakdown(evidence.publication_trends(table, found))
    assert {(r.year, r.design): r.articles for r in long.collect()}[2021, "case_report_count"] == 1
    assert long.count() == 9


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_cooccurrence_against_pairs(spark, rows, block):
    random.seed(block)
    lists = [[f"T{random.randint(0, 9)}" for _ in range(random.randint(0, 9))] for _ in range(60)]
    lists += [["a", "B", "a", "b", None], None, [], ["x"], *[["hot", "copy", "c"]] * 50]
    frame = spark.createDataFrame([(x,) for x in lists], "mesh_terms array<string>")
    counts = Counter()
    for terms in lists:
        counts.update(combinations(sorted({t.lower() for t in terms or [] if t}), 2))
    for least in (1, 3, 12):
        expected = [(a, b, n) for (a, b), n in counts.items() if n >= least]
        found = evidence.mesh_cooccurrence(frame, least, block)
        assert rows(found) == sorted(expected, key=repr)


def test_one_article_with_very_many_terms(spark):
    frame = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(700)), lambda i: i.cast("string")).alias("mesh_terms"))
    found = evidence.mesh_cooccurrence(frame, 1)
    assert found.count() == 700 * 699 // 2
    assert found.agg(F.max("co_occurrence_count")).first()[0] == 1


def test_geography_counts_articles_once(spark):
    authors = spark.createDataFrame(
        [("0", "Italy"), ("0", " Italy\t"), ("1", "Italy"), ("2", "Spain"), ("2", " "), ("2", None), ("4", "Peru")],
        "pubmed_id string, country string",
    )
    table = articles(spark, [date(2020, 1, 1), date(2018, 1, 1), date(2021, 1, 1), date(2022, 1, 1), None])
    assert [tuple(r) for r in evidence.research_geography(authors, table).collect()] == [
        ("Italy", 2, 2018, 2020), ("Peru", 1, None, None), ("Spain", 1, 2021, 2021),
    ]


def test_funding_counts_grants_and_takes_the_first_country(spark):
    grants = spark.createDataFrame(
        [
            ("0", "NIH", None, 0), ("0", " NIH ", "", 1), ("0", "NIH", " US ", 2), ("0", "NIH", "UK", 3),
            ("1", "NIH", "FR", 0), ("1", "ERC", "  ", 0), ("4", "DFG", None, 0), ("4", " ", "X", 1), ("4", None, "X", 2),
        ],
        "pubmed_id string, agency string, country string, grant_no int",
    )
    table = articles(spark, [date(2020, 1, 1), date(2018, 1, 1), None, None, None])
    found = evidence.funding_landscape(grants, table)
    assert [tuple(r) for r in found.collect()] == [
        ("NIH", 5, 2, "US", 2018, 2020), ("DFG", 1, 1, None, None, None), ("ERC", 1, 1, "", 2018, 2018),
    ]


def test_one_article_with_a_third_of_all_rows(spark):
    """It brings one row per country or agency to the join, whatever its size."""
    hot = spark.range(20_000).select(F.lit("0").alias("pubmed_id"), (F.col("id") % 3).alias("n"), "id")
    rest = spark.range(40_000).select((F.col("id") % 500 + 1).cast("string").alias("pubmed_id"), (F.col("id") % 5).alias("n"), "id")
    rows = hot.unionByName(rest).select("pubmed_id", F.concat(F.lit("C"), "n").alias("country"),
                                        F.lit("NIH").alias("agency"), F.col("id").alias("grant_no"))
    table = spark.range(501).select(F.col("id").cast("string").alias("pubmed_id"), F.lit(date(2020, 1, 1)).alias("pub_date"))
    found = {r.country: r.article_count for r in evidence.research_geography(rows, table).collect()}
    assert found == {"C0": 101, "C1": 101, "C2": 101, "C3": 100, "C4": 100}
    (nih,) = evidence.funding_landscape(rows, table).collect()
    assert (nih.article_count, nih.distinct_article_count, nih.country) == (60_000, 501, "C0")
    plan = evidence.research_geography(rows, table)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate(keys=[pubmed_id") == 2


def populations(spark, entries):
    return spark.createDataFrame(
        [(str(i), p, e) for i, (p, e) in enumerate(entries)],
        "pubmed_id string, population struct<sex:string,age_group:string,disease_stage:string>, extraction_error string",
    )


def test_population_profile(spark):
    frame = populations(
        spark,
        [(("Female", "adult", "IV"), None), ((" female\n", None, "IV"), None), (("male", "", "II"), None),
         (("male", "adult", "II"), "failed"), (None, None)],
    )
    assert [tuple(r) for r in evidence.population_profile(frame).collect()] == [
        (0, "age_group", "adult", 1), (1, "sex", "female", 2), (1, "sex", "male", 1),
        (2, "disease_severity", None, 0),
    ]
    bars = reports.population_bars(evidence.population_profile(frame))
    assert {r.dimension for r in bars.collect()} == {"age_group", "sex"}
    stage = evidence.population_profile(frame, ["disease_stage"])
    assert [tuple(r)[2:] for r in stage.collect()] == [("iv", 2), ("ii", 1)]
    assert [r.dimension for r in evidence.population_profile(frame.limit(0)).collect()] == [
        "age_group", "sex", "disease_severity",
    ]


def test_shifts_and_gaps(spark):
    table = articles(spark, [date(2020, 1, 1), date(2020, 1, 1), date(2021, 1, 1), None, date(2021, 1, 1)])
    found = spark.createDataFrame(
        [
            ("0", ["Dienogest", " dienogest", "x"], "case_report", None), ("1", [], "case_report", None),
            ("2", ["dienogest", " "], "case_report", None), ("3", ["x"], "case_report", None),
            ("4", ["x"], "randomized_controlled_trial", "failed"),
        ],
        "pubmed_id string, treatments array<string>, study_design string, extraction_error string",
    )
    assert [tuple(r) for r in evidence.treatment_shifts(table, found).collect()] == [
        (2020, "dienogest", 1, 0.5), (2020, "x", 1, 0.5), (2021, "dienogest", 1, 1.0),
    ]
    assert [tuple(r) for r in evidence.evidence_gaps(found).collect()] == [("dienogest", 2, 0), ("x", 2, 0)]
    trial = found.where("pubmed_id = '4'").withColumn("extraction_error", F.lit(None).cast("string"))
    more = found.unionByName(trial)
    assert [r.treatment for r in evidence.evidence_gaps(more).collect()] == ["dienogest"]
    assert [r.treatment for r in evidence.evidence_gaps(more, max_rct=1).collect()] == ["dienogest", "x"]


CHECKED = "pubmed_id string, title string"
EXTRACTED = "pubmed_id string, extraction_error string, extraction_confidence double"


def test_checks(spark):
    table = spark.createDataFrame([("1", "a"), ("1", None), ("2", "b")], CHECKED)
    found = spark.createDataFrame(
        [("1", None, 0.5), ("2", "e", 1.5), ("3", None, None), ("4", None, 0.0), ("5", None, 1.0)], EXTRACTED
    )
    results = {(r.check_name, r.metric): (r.passed, r.value) for r in quality.run_checks(table, found).collect()}
    assert results["extraction_failure_rate", "failure_rate"] == (False, 0.2)
    assert results["minimum_article_volume", "article_count"] == (False, 3.0)
    assert results["no_duplicate_ids", "duplicates"] == (False, 1.0)
    assert results["no_null_titles", "null_titles"] == (False, 1.0)
    assert results["confidence_range", "out_of_range_confidence"] == (False, 1.0)
    assert quality.article_volume_check(table, 3).first().passed


def test_checks_on_empty_tables(spark):
    none = quality.failure_rate_check(spark.createDataFrame([], EXTRACTED))
    assert {(r.metric, r.passed, r.value) for r in none.collect()} == {
        ("total", False, 0.0), ("failed", False, 0.0), ("failure_rate", False, None),
    }
    assert quality.duplicate_id_check(spark.createDataFrame([], CHECKED)).first().passed


def test_reports(spark, rows):
    pair = [("T", "O", "positive")]
    at = datetime(2024, 1, 1)
    found = spark.createDataFrame(
        [
            ("1", ["T"], ["O"], pair, "other", None, 0.5, None, at),
            ("2", ["T"], ["O"], [("t", "O", "positive")], "other", None, 0.5, "", at),
            ("3", [], [], [], "other", None, 0.5, None, at),
            ("4", [], [], None, "other", None, 0.5, "failed", at),
            ("5", ["T"], ["O"], pair, "other", None, 0.5, "failed", at),
        ],
        EXTRACTION,
    )
    assert [r.pubmed_id for r in reports.success_sample(found).collect()] == ["1", "2"]
    assert [r.pubmed_id for r in reports.failure_sample(found).collect()] == ["4", "5"]
    table = spark.createDataFrame(
        [("1", "a", "J", date(2019, 1, 1)), ("2", "b", "J", date(2022, 1, 1)), ("3", "c", "J", None)],
        "pubmed_id string, title string, journal string, pub_date date",
    )
    saved = spark.createDataFrame([("x",), ("y",)], "name string")
    assert rows(reports.store_state(table, found, saved)) == [(3, 2, 2, 2)]
    assert rows(reports.store_state(table, found, saved, need_pairs=False)) == [(3, 2, 3, 2)]
    authors = spark.createDataFrame([("1", "Italy"), ("2", None)], "pubmed_id string, country string")
    assert rows(reports.output_summary(table, authors, found, saved)) == [(2, 4, 2, 1)]
    assert [r.title for r in reports.end_to_end_sample(table, found).collect()] == ["a", "b"]


def test_heat_map_against_a_pivot(spark, rows):
    random.seed(5)
    cells = {(f"t{random.randint(0, 8)}", f"o{random.randint(0, 6)}"): random.randint(1, 9) for _ in range(30)}
    cells["rare", "only here"] = 1
    totals = Counter()
    for (t, _), n in cells.items():
        totals[t] += n
    top = sorted(totals, key=lambda t: (-totals[t], t))[:3]
    outcomes = {o for _, o in cells}
    expected = sorted((t, o, cells.get((t, o), 0)) for t in top for o in outcomes)
    matrix = spark.createDataFrame([(t, o, n) for (t, o), n in cells.items()], "treatment string, outcome string, frequency bigint")
    assert rows(reports.heat_map(matrix, top=3)) == sorted(expected, key=repr)
    assert reports.heat_map(matrix, top=20).count() == len(totals) * len(outcomes)
