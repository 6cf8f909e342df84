"""Extraction: answers (E1), callers' functions (E2), tagging (E3), summary."""

from __future__ import annotations

import json

import pytest

from evidmap.operators import extract

GOOD = {
    "treatments": ["letrozole", "watchful waiting"],
    "outcomes": ["ovarian reserve"],
    "treatment_outcomes": [
        {"treatment": "letrozole", "outcome": "ovarian reserve", "effect_direction": "mixed"},
        {"treatment": "watchful waiting", "outcome": "ovarian reserve", "effect_direction": "neutral"},
    ],
    "study_design": "cohort_study",
    "population": {
        "sex": None, "age_group": "18 to 35", "disease_stage": None, "sample_size": 4312,
        "special_population": "after two failed cycles",
    },
    "extraction_confidence": 0.375,
    "extraction_error": None,
}


def parse(spark, *answers):
    texts = [a if isinstance(a, str) or a is None else json.dumps(a) for a in answers]
    frame = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "pubmed_id string, answer string")
    return [r.asDict(recursive=True) for r in extract.parse_extractions(frame).orderBy("pubmed_id").collect()]


def test_good_answer(spark):
    (row,) = parse(spark, GOOD)
    assert row == {"pubmed_id": "0", **GOOD}


def test_error_row(spark):
    (row,) = parse(spark, {"treatments": [], "study_design": "unknown", "population": {}, "extraction_error": "no answer in time"})
    assert (row["extraction_error"], row["treatments"], row["extraction_confidence"]) == ("no answer in time", [], 0.0)


@pytest.mark.parametrize(
    ("change", "expected"),
    [
        ({"treatments": None, "outcomes": None, "treatment_outcomes": None}, {"treatments": [], "treatment_outcomes": []}),
        ({"study_design": ""}, {"study_design": "unknown"}),
        ({"study_design": None}, {"study_design": "unknown"}),
        ({"extraction_confidence": None}, {"extraction_confidence": 0.0}),
        ({"extraction_confidence": "0.25"}, {"extraction_confidence": 0.25}),
        ({"extraction_confidence": 1}, {"extraction_confidence": 1.0}),
        ({"population": None}, {"extraction_error": None}),
        ({"treatment_outcomes": [{"treatment": "", "outcome": "x"}, {"outcome": "x"}, {"treatment": None, "outcome": "x"}]},
         {"treatment_outcomes": [], "extraction_error": None}),
        ({"treatment_outcomes": [{"treatment": "a", "outcome": "b"}]},
         {"treatment_outcomes": [{"treatment": "a", "outcome": "b", "effect_direction": "unknown"}]}),
        ({"treatment_outcomes": [{"treatment": "a", "outcome": "b", "effect_direction": None}]},
         {"treatment_outcomes": [], "extraction_error": "validation: effect_direction"}),
        ({"treatment_outcomes": [{"treatment": "a", "outcome": "b", "effect_direction": "good"}]},
         {"treatments": [], "extraction_error": "validation: effect_direction"}),
        ({"study_design": "trial"}, {"study_design": "unknown", "extraction_error": "validation: study_design"}),
        ({"extraction_confidence": 1.5}, {"extraction_confidence": 0.0, "extraction_error": "validation: extraction_confidence"}),
        ({"extraction_confidence": -0.1}, {"extraction_error": "validation: extraction_confidence"}),
        ({"extraction_confidence": "high"}, {"extraction_error": "validation: extraction_confidence"}),
    ],
)
def test_answers(spark, change, expected):
    (row,) = parse(spark, GOOD | change)
    assert {k: row[k] for k in expected} == expected


@pytest.mark.parametrize(
    ("size", "expected", "error"),
    [("100", 100, None), (100.0, 100, None), (None, None, None), ("many", None, "validation: sample_size"),
     (3.5, None, "validation: sample_size")],
)
def test_sample_sizes(spark, size, expected, error):
    (row,) = parse(spark, GOOD | {"population": {"sample_size": size}})
    assert (row["population"]["sample_size"], row["extraction_error"]) == (expected, error)


def test_answers_that_are_no_json(spark):
    rows = parse(spark, "{oops", "[1]", json.dumps(GOOD))
    assert [r["extraction_error"] for r in rows] == ["validation: answer", "validation: answer", None]


def test_extractor_errors_stay_in_their_row(spark):
    def extractor(text):
        if "boom" in text:
            raise RuntimeError("x" * 500)
        return json.dumps(GOOD) if "json" in text else GOOD

    frame = spark.createDataFrame(
        [("1", "fine"), ("2", "boom"), ("3", "json")], "pubmed_id string, abstract string"
    )
    found = {r.pubmed_id: r for r in extract.apply_extractor(frame, extractor, partitions=2).collect()}
    assert len(found) == 3
    assert found["1"].treatments == found["3"].treatments == GOOD["treatments"]
    assert found["2"].extraction_error == "x" * 200
    assert (found["2"].treatments, found["2"].study_design, found["2"].extraction_confidence) == ([], "unknown", 0.0)


def tag(spark, text, rules=None):
    frame = spark.createDataFrame([("1", text)], "pubmed_id string, abstract string")
    return extract.tag_abstracts(frame, rules).first().asDict(recursive=True)


def test_tagging(spark):
    row = tag(
        spark,
        "Cohort of 57 patients. After laparoscopy the men and women fared alike; GnRH agonists "
        "relieved dysmenorrhea! Recurrence was worse under placebo",
    )
    assert row["treatments"] == ["laparoscopic surgery", "GnRH agonist", "placebo"]
    assert row["outcomes"] == ["dysmenorrhea", "recurrence rate"]
    assert [tuple(p.values()) for p in row["treatment_outcomes"]] == [
        ("laparoscopic surgery", "dysmenorrhea", "positive"),
        ("GnRH agonist", "dysmenorrhea", "positive"),
        ("placebo", "recurrence rate", "negative"),
    ]
    assert row["study_design"] == "cohort_study"
    assert (row["population"]["sex"], row["population"]["sample_size"]) == ("female", 57)
    assert row["extraction_confidence"] == 1.0


@pytest.mark.parametrize(
    ("text", "direction"),
    [
        ("Dienogest reduced recurrence", "positive"),
        ("Dienogest worsened recurrence", "negative"),
        ("Dienogest reduced recurrence with adverse events", "mixed"),
        ("Dienogest: no difference in recurrence, improved or not", "neutral"),
        ("Dienogest and recurrence", "unknown"),
    ],
)
def test_directions(spark, text, direction):
    (pair,) = tag(spark, text)["treatment_outcomes"]
    assert pair["effect_direction"] == direction


def test_nothing_to_tag(spark):
    row = tag(spark, "Dienogestic menopause.\n\nRecurrences, 5women")
    assert (row["treatments"], row["outcomes"], row["treatment_outcomes"]) == ([], [], [])
    assert (row["study_design"], row["extraction_confidence"]) == ("unknown", 0.0)
    assert row["population"]["sample_size"] is None
    assert tag(spark, "")["treatments"] == []


def test_large_dictionary_and_overlaps(spark):
    terms = {f"drug {i}": f"name {i}" for i in range(50_000)} | {"drug 7 forte": "strong", "forte": "loud"}
    row = tag(spark, "Drug 7 forte, drug 49999 and drug 7. Forte drug 8", extract.TagRules(treatments=terms))
    assert row["treatments"] == ["strong", "name 49999", "name 7", "loud", "name 8"]
    assert tag(spark, "drug 7", extract.TagRules(treatments={}, outcomes={}))["treatments"] == []


@pytest.mark.parametrize("term", ["Dienogest", "gnrh-agonist", "pelvic  pain", "a_b"])
def test_terms_that_could_never_match_are_refused(spark, term):
    with pytest.raises(ValueError, match="words"):
        tag(spark, "x", extract.TagRules(treatments={term: "t"}))


@pytest.mark.parametrize("size", [99999999999, "-3000000000.0", "1" * 400, "1e400", float(10**12)])
def test_a_number_that_no_int_holds_is_a_row_error(spark, size):
    (row,) = parse(spark, GOOD | {"population": {"sample_size": size}})
    assert (row["extraction_error"], row["treatments"]) == ("validation: sample_size", [])


def test_extractor_of_batches(spark):
    def answers(rows):
        if any(text == "break" for _, text in rows):
            raise RuntimeError("broken")
        return [{"treatments": [f"{i}:{text}"]} for i, text in rows]

    frame = spark.createDataFrame([("1", "a"), ("2", "b")], "pubmed_id string, abstract string")
    found = {r.pubmed_id: r for r in extract.apply_extractor(frame, answers, 1, by_batch=True).collect()}
    assert [found[k].treatments for k in "12"] == [["1:a"], ["2:b"]]
    bad = extract.apply_extractor(frame.replace("b", "break"), answers, 1, by_batch=True)
    assert {r.extraction_error for r in bad.collect()} == {"broken"}
    few = extract.apply_extractor(frame, lambda rows: [], 1, by_batch=True)
    assert {r.extraction_error for r in few.collect()} == {"0 answers to 2 abstracts"}


def test_summary(spark, rows):
    frame = spark.createDataFrame([(None,), ("",), ("failed",)], "extraction_error string")
    assert rows(extract.extraction_summary(frame)) == [(3, 2, 1, 0.333)]
    assert rows(extract.extraction_summary(frame.limit(0))) == [(0, 0, 0, 0.0)]
