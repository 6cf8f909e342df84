"""Structured extraction: answers to rows (E1), callers' extractors (E2), run summary.

Dictionary tagging (E3) is in ``tagging``."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidmap.functions.text import blank_to_null
from evidmap.operators.tagging import NO_SCOPE, TagRules, tag_abstracts  # noqa: F401
from evidmap.schemas import EFFECT_DIRECTIONS, PAIR, POPULATION, STUDY_DESIGNS

# ---- E1 -----------------------------------------------------------------------

# Numbers are read as text: the text tells a wrong value from a missing one. Pairs
# are maps: a map tells a direction that is null from one that is missing.
_ANSWER = """treatments array<string>, outcomes array<string>,
treatment_outcomes array<map<string,string>>, study_design string,
population struct<sex:string,age_group:string,disease_stage:string,sample_size:string,
special_population:string>, extraction_confidence string, extraction_error string,
_corrupt_record string"""
_INTEGER = r"^\s*[+-]?\d+(\.0*)?\s*$"
MESSAGE_LENGTH = 200


def parse_extractions(answers: DataFrame) -> DataFrame:
    """Rows (pubmed_id, answer JSON) -> extraction rows without a time.

    NULL lists become empty, pairs need both texts, a missing direction or empty
    design is ``unknown``. An answer that breaks a rule keeps its row, emptied,
    with the reason in ``extraction_error``. An optional ``error`` column (a
    failure before there was an answer) does the same.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    error = F.col("error") if "error" in answers.columns else F.lit(None).cast("string")
    parsed = answers.select(
        "pubmed_id",
        error.alias("error"),
        F.from_json("answer", _ANSWER, options).alias("a"),
    )
    typed = parsed.select(
        "pubmed_id",
        "error",
        F.col("a._corrupt_record").isNotNull().alias("corrupt"),
        F.coalesce("a.treatments", F.array().cast("array<string>")).alias("treatments"),
        F.coalesce("a.outcomes", F.array().cast("array<string>")).alias("outcomes"),
        _pairs(F.col("a.treatment_outcomes")).alias("treatment_outcomes"),
        F.coalesce(blank_to_null(F.col("a.study_design")), F.lit("unknown")).alias("study_design"),
        F.col("a.population").alias("population"),
        F.coalesce(blank_to_null(F.col("a.extraction_confidence")), F.lit("0")).alias("confidence"),
        F.col("a.extraction_error").alias("answer_error"),
    )
    size = F.col("population.sample_size")
    # a number that no int holds is a wrong value, not the end of the run
    whole = F.regexp_replace(F.trim(size), r"\.0*$", "").try_cast("int")
    confidence = F.when(F.col("confidence") == "false", 0.0).otherwise(
        F.col("confidence").try_cast("double")
    )
    directions = F.col("treatment_outcomes.effect_direction")
    known = F.forall(directions, lambda d: F.coalesce(d.isin(*EFFECT_DIRECTIONS), F.lit(False)))
    reason = (
        F.when(F.col("error").isNotNull(), F.substring("error", 1, MESSAGE_LENGTH))
        .when(F.col("corrupt"), "validation: answer")
        .when(~F.col("study_design").isin(*STUDY_DESIGNS), "validation: study_design")
        .when(~known, "validation: effect_direction")
        .when(
            confidence.isNull() | ~confidence.between(0.0, 1.0), "validation: extraction_confidence"
        )
        .when(
            size.isNotNull() & (~size.rlike(_INTEGER) | whole.isNull()), "validation: sample_size"
        )
    )
    checked = typed.withColumn("reason", reason)
    good = F.col("reason").isNull()

    def kept(value: Column | str, otherwise: Column, name: str) -> Column:
        return F.when(good, value).otherwise(otherwise).alias(name)

    no_text = F.array().cast("array<string>")
    population = F.struct(
        *[
            F.when(good, F.col(f"population.{name}")).alias(name)
            for name in ("sex", "age_group", "disease_stage")
        ],
        F.when(good, whole).alias("sample_size"),
        F.when(good, F.col("population.special_population")).alias("special_population"),
    )
    return checked.select(
        "pubmed_id",
        kept(F.col("treatments"), no_text, "treatments"),
        kept(F.col("outcomes"), no_text, "outcomes"),
        kept(
            F.col("treatment_outcomes"), F.array().cast(f"array<{PAIR}>"), "treatment_outcomes"
        ),
        kept(F.col("study_design"), F.lit("unknown"), "study_design"),
        population.cast(POPULATION).alias("population"),
        kept(confidence, F.lit(0.0), "extraction_confidence"),
        F.coalesce("reason", "answer_error").alias("extraction_error"),
    )


def _pairs(entries: Column) -> Column:
    def filled(entry: Column, key: str) -> Column:
        return F.coalesce(F.try_element_at(entry, F.lit(key)), F.lit("")) != ""

    usable = F.filter(
        F.coalesce(entries, F.array().cast("array<map<string,string>>")),
        lambda e: filled(e, "treatment") & filled(e, "outcome"),
    )

    def pair(entry: Column) -> Column:
        given = F.map_contains_key(entry, "effect_direction")
        direction = F.try_element_at(entry, F.lit("effect_direction"))
        return F.struct(
            F.try_element_at(entry, F.lit("treatment")).alias("treatment"),
            F.try_element_at(entry, F.lit("outcome")).alias("outcome"),
            F.when(given, direction).otherwise(F.lit("unknown")).alias("effect_direction"),
        )

    return F.transform(usable, pair)


# ---- E2 -----------------------------------------------------------------------


def apply_extractor(
    abstracts: DataFrame,
    extractor: Callable[[str], dict | str] | Callable[[list[tuple[str, str]]], list[dict | str]],
    partitions: int | None = None,
    by_batch: bool = False,
    pace: float | None = None,
) -> DataFrame:
    """One extraction row per (pubmed_id, abstract), from the caller's function.

    ``extractor`` gets an abstract and gives the answer as a dict or as JSON; with
    ``by_batch`` it gets a list of (pubmed_id, abstract) and gives as many answers. It
    runs on the executors, batch by batch; what it raises becomes the rows' error.
    ``partitions`` says over how many tasks to spread the calls, else they run
    where the rows are. A task begins its calls ``pace`` seconds apart or more.
    """
    if partitions:
        abstracts = abstracts.repartition(partitions)

    begun = [0.0]  # of the last call of this task

    def wait() -> None:
        if pace:
            time.sleep(max(0.0, begun[0] + pace - time.monotonic()))
            begun[0] = time.monotonic()

    def answer(call: Callable[[], dict | str]) -> tuple[str | None, str | None]:
        try:
            given = call()
            given = json.loads(given) if isinstance(given, str) else given
            return json.dumps(dict(given)), None
        except Exception as error:  # the caller's function may raise anything
            return None, str(error)[:MESSAGE_LENGTH]

    def paced(text: str) -> tuple[str | None, str | None]:
        wait()
        return answer(lambda: extractor(text))

    def answers_of(rows: list[tuple[str, str]]) -> list[tuple[str | None, str | None]]:
        if not by_batch:
            return [paced(text) for _, text in rows]
        try:
            wait()
            given = list(extractor(rows))
            if len(given) != len(rows):
                raise ValueError(f"{len(given)} answers to {len(rows)} abstracts")
        except Exception as error:
            return [(None, str(error)[:MESSAGE_LENGTH])] * len(rows)
        return [answer(lambda: one) for one in given]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = answers_of(list(zip(batch["pubmed_id"], batch["abstract"])))
            yield pd.DataFrame(
                {
                    "pubmed_id": batch["pubmed_id"],
                    "answer": [a for a, _ in answers],
                    "error": [e for _, e in answers],
                }
            )

    answers = abstracts.select("pubmed_id", "abstract").mapInPandas(
        run, "pubmed_id string, answer string, error string"
    )
    return parse_extractions(answers)


# ---- E4 -----------------------------------------------------------------------


def extraction_summary(extractions: DataFrame) -> DataFrame:
    """Processed, successful, errors and failure rate; an empty error is none."""
    failed = blank_to_null(F.col("extraction_error")).isNotNull()
    rate = F.col("errors") / F.greatest(F.col("total_processed"), F.lit(1))
    return extractions.agg(
        F.count("*").alias("total_processed"),
        F.count_if(~failed).alias("successful"),
        F.count_if(failed).alias("errors"),
    ).withColumn("failure_rate", F.round(rate, 3))
