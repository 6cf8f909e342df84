"""The automaton, and effects read clause by clause."""

from __future__ import annotations

import random
import re

import pytest

from evidmap.operators import extract
from evidmap.operators.tagging import joined


def tag(spark, text, rules=None):
    frame = spark.createDataFrame([("1", text)], "pubmed_id string, abstract string")
    return extract.tag_abstracts(frame, rules).first().asDict(recursive=True)


def directions(row):
    return {(p["treatment"], p["outcome"]): p["effect_direction"] for p in row["treatment_outcomes"]}


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        # a fall is good for pain and bad for pregnancies
        ("Dienogest reduced pelvic pain and dysmenorrhea", {"pelvic pain": "positive", "dysmenorrhea": "positive"}),
        ("Dienogest reduced pregnancy rate", {"pregnancy rate": "negative"}),
        ("Dienogest reduced recurrence and increased pregnancy rate", {"recurrence rate": "positive", "pregnancy rate": "positive"}),
        ("With dienogest pelvic pain decreased and recurrence increased", {"pelvic pain": "positive", "recurrence rate": "negative"}),
        ("Pelvic pain and recurrence were lower with dienogest", {"pelvic pain": "positive", "recurrence rate": "positive"}),
        # negation reaches a few words and ends with its clause
        ("Dienogest did not clearly reduce or relieve; not improved pelvic pain", {"pelvic pain": "neutral"}),
        ("Dienogest did not seem to have improved pelvic pain", {"pelvic pain": "positive"}),
        ("Dienogest was not cheap but improved pelvic pain", {"pelvic pain": "positive"}),
        # clauses
        ("Dienogest improved pelvic pain but worsened fertility", {"pelvic pain": "positive", "fertility outcomes": "negative"}),
        ("Dienogest improved pelvic pain. No significant difference in recurrence", {"pelvic pain": "positive"}),
        ("Dienogest: no significant difference in recurrence, while it improved fertility",
         {"recurrence rate": "neutral", "fertility outcomes": "positive"}),
        # contradictions of a pair
        ("Dienogest improved fertility. Later dienogest worsened fertility", {"fertility outcomes": "mixed"}),
        ("Dienogest improved fertility. Dienogest and fertility", {"fertility outcomes": "positive"}),
        ("Dienogest reduced recurrence with adverse events", {"recurrence rate": "mixed"}),
    ],
)
def test_directions(spark, text, expected):
    found = directions(tag(spark, text))
    assert found == {("dienogest", outcome): d for outcome, d in expected.items()}


def test_treatments_of_clauses(spark):
    row = tag(spark, "Dienogest improved pelvic pain, whereas placebo worsened recurrence and however fertility improved")
    assert directions(row) == {
        ("dienogest", "pelvic pain"): "positive",
        ("placebo", "recurrence rate"): "negative",
        ("placebo", "fertility outcomes"): "positive",
    }


def test_the_example_of_the_task(spark):
    row = tag(
        spark,
        "In this double-blind RCT, 100 women with stage III-IV endometriosis received dienogest 2mg/day or placebo. "
        "Dienogest significantly reduced pelvic pain (VAS score, p<0.001) and dysmenorrhea severity. "
        "No significant difference in fertility outcomes was observed with dienogest.",
    )
    assert row["treatments"] == ["dienogest", "placebo"] and row["study_design"] == "randomized_controlled_trial"
    assert directions(row) == {
        ("dienogest", "pelvic pain"): "positive",
        ("dienogest", "dysmenorrhea severity"): "positive",
        ("dienogest", "fertility outcomes"): "neutral",
    }
    assert row["population"] == {
        "sex": "female", "age_group": None, "disease_stage": "III-IV", "sample_size": 100, "special_population": None,
    }


def test_all_fields_of_the_population(spark):
    text = "Obese adolescents. 12 infertile women of reproductive age with moderate to severe disease, stage I"
    assert tag(spark, text)["population"] == {
        "sex": "female", "age_group": "adolescents", "disease_stage": "III-IV", "sample_size": None, "special_population": "obese",
    }
    assert tag(spark, "Stage. III")["population"]["disease_stage"] is None


def plain_hits(text, rules):
    """Treatments and outcomes by a pattern per sentence."""
    found = []
    for terms in (rules.treatments, rules.outcomes):
        pattern = "|".join(sorted(map(re.escape, terms), key=lambda t: (-len(t), t)))
        names = []
        for sentence in text.split("."):
            own = " " + " ".join(sentence.split()) + " "
            names += [terms[m] for m in re.findall(rf"(?<= )({pattern})(?= )", own)]
        found.append(list(dict.fromkeys(names)))
    return found


@pytest.mark.parametrize("part_chars", [10**9, 200])
def test_terms_against_patterns(spark, part_chars):
    """Overlapping terms, in one automaton and in parts of it."""
    rng = random.Random(part_chars)
    words = "a b c d e f".split()
    term = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(1, 5)))
    rules = extract.TagRules(
        treatments={t: t.upper() for t in {term() for _ in range(60)}},
        outcomes={t: f"<{t}>" for t in {term() for _ in range(40)}},
        part_chars=part_chars,
    )
    texts = [" ".join(rng.choice([*words, "x", "."]) for _ in range(80)) for _ in range(30)] + [None, "", texts_twice()]
    texts += texts[:2]
    frame = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "pubmed_id string, abstract string")
    found = {r.pubmed_id: r for r in extract.tag_abstracts(frame.repartition(3), rules).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        row = found[str(i)]
        assert [row.treatments, row.outcomes] == plain_hits(text or "", rules), text


def texts_twice():
    return "a a a a . a a"


def test_a_large_dictionary_passes_once(spark):
    terms = {f"drug {i}": f"name {i}" for i in range(100_000)}
    row = tag(spark, "Drug 99999 improved fertility. " * 3, extract.TagRules(treatments=terms))
    assert directions(row) == {("name 99999", "fertility outcomes"): "positive"}


def test_joined_sentences():
    assert joined(" a b \n\n c\n") == (" a b c ", [1, 5])
    assert joined("\n ") == (" ", [])


def test_dictionary_without_words(spark):
    rules = extract.TagRules(treatments={}, outcomes={}, positive=(), negative=(), neutral=(), female=(), male=(), designs=(), **extract.NO_SCOPE)
    row = tag(spark, "dienogest improved pelvic pain of 3 women", rules)
    assert (row["treatments"], row["study_design"], row["population"]["sample_size"]) == ([], "unknown", 3)
