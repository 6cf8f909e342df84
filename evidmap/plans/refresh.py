"""B2 by batch: analytics that are brought up to date from what is new.

For each of A1-A6 a table of sums is kept from which the result follows. A refresh folds the new
batches into it: what an article or extraction adds counts +1, and what the extraction it replaces
has added counts -1. To know that, the rows that count for an id are kept by range of ids; a
refresh reads the ranges it has ids in, the new batches, and the tables of sums. Sums and the list
of batches in them are one version, seen whole or not at all.

Articles are written once and never change; an extraction is replaced by a later one. A batch that
was folded does not change any more.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidmap.functions.text import blank_to_null, year_of
from evidmap.operators import evidence
from evidmap.operators.ingest import current_extractions
from evidmap.runtime import read_or_empty
from evidmap.schemas import PAIR, REVIEW_DESIGNS
from evidmap.sources.store import MOST_RANGES, Store, id_range
from evidmap.sources.versions import Versions

# What counts for an id.
_ROW = (
    "struct<has_article:boolean,year:int,extracted_ts:timestamp,error:string,"
    f"study_design:string,treatment_outcomes:array<{PAIR}>>"
)
_PROGRESS = "table string, batch string, step int"


@dataclass(frozen=True)
class Sums:
    """A table of sums: its key, how rows of a key are folded, and the result it gives."""

    key: tuple[str, ...]
    fold: Callable[[], dict[str, Column]]
    result: Callable[[DataFrame], DataFrame]


def _added(*names: str) -> dict[str, Column]:
    return {name: F.sum(name) for name in names}


_EFFECTS = ("positive", "negative", "neutral", "mixed")
_DESIGNS = ("rct_count", "review_count", "case_report_count")
_YEARS = ("earliest_year", "latest_year")


def _years() -> dict[str, Column]:
    return {"earliest_year": F.min("earliest_year"), "latest_year": F.max("latest_year")}


SUMS = {
    "treatment_outcome_matrix": Sums(
        ("treatment", "outcome"),
        lambda: _added("frequency", *_EFFECTS),
        lambda t: t.where("frequency > 0").orderBy(F.desc("frequency"), "treatment", "outcome"),
    ),
    "publication_trend_analysis": Sums(
        ("year",),
        lambda: _added("article_count", *_DESIGNS),
        lambda t: t.where("article_count > 0").orderBy("year"),
    ),
    "study_design_trends": Sums(
        ("year", "study_design"),
        lambda: _added("article_count"),
        lambda t: t.where("article_count > 0").orderBy("year", "study_design"),
    ),
    "mesh_cooccurrence_network": Sums(
        ("term_a", "term_b"),
        lambda: _added("co_occurrence_count"),
        lambda t: t.where("co_occurrence_count >= 3").orderBy(F.desc("co_occurrence_count"), "term_a", "term_b"),
    ),
    "research_geography_analysis": Sums(
        ("country",),
        lambda: _added("article_count") | _years(),
        lambda t: t.orderBy(F.desc("article_count"), "country"),
    ),
    "funding_landscape_analysis": Sums(
        ("agency",),
        lambda: _added("article_count", "distinct_article_count")
        | {"first": F.min("first"), "blank_country": F.max("blank_country")}
        | _years(),
        evidence.funding_of_parts,
    ),
}


def _versions(store: Store) -> Versions:
    return Versions(store.spark, f"{store.root}/partials/sums")


def _progress(store: Store) -> dict[tuple[str, str], int]:
    """The step in which each (table, batch) was folded: as many rows as there are batches."""
    rows = _versions(store).read("progress")
    return {} if rows is None else {(r.table, r.batch): r.step for r in rows.collect()}


def results(store: Store) -> dict[str, DataFrame]:
    """Name -> result of what has been folded; empty before the first refresh."""
    folder = _versions(store).current()
    if folder is None:
        return {}
    return {name: sums.result(store.spark.read.parquet(f"{folder}/{name}")) for name, sums in SUMS.items()}


def _state(store: Store, ids: DataFrame, step: int) -> DataFrame:
    """(pubmed_id, was) of ``ids``: what counted for them up to ``step``."""
    rows = read_or_empty(store.spark, f"{store.root}/partials/rows", f"pubmed_id string, now {_ROW}, step int, range bigint")
    ranges = ids.select(id_range("pubmed_id").alias("range")).distinct().limit(MOST_RANGES + 1).collect()
    if len(ranges) <= MOST_RANGES:
        rows = rows.where(F.col("range").isin([r.range for r in ranges]))
    # merge, here and below: rows of ids pack well, so a table small on disk may be large to broadcast
    rows = rows.where(F.col("step") <= step).join(ids.hint("merge"), "pubmed_id", "left_semi")
    return rows.groupBy("pubmed_id").agg(F.max_by("now", "step").alias("was"))


def _by_id(ids: DataFrame, *told: DataFrame) -> DataFrame:
    """``ids`` with the row each of ``told`` has for an id; none of them is held whole anywhere."""
    for rows in told:
        ids = ids.join(rows.hint("merge"), "pubmed_id", "left")
    return ids


def refresh(store: Store) -> list[tuple[str, str]]:
    """Fold the batches of articles and extractions that are new; their (table, batch)."""
    spark, done = store.spark, _progress(store)
    present = {(t, b) for t in ("articles", "extractions") for b in store.batches(t)}
    if any(("extractions", b) not in done and ("extractions", b) not in present for b in store.covered("extractions")):
        done = {}  # compacted before it was folded: all rows are new
    new = sorted(present - set(done))
    step = max(done.values(), default=0) + 1
    if not new:
        return []

    def rows(table: str, like: str | None = None) -> DataFrame:
        if not done:
            return store.read(table)
        return store.read_batches(table, [b for t, b in new if t == (like or table)])

    articles = rows("articles").hint("merge")
    dated = articles.select("pubmed_id", F.lit(True).alias("arrived"), year_of(F.col("pub_date")).alias("year"))
    told = current_extractions(rows("extractions"))
    extraction = F.struct("extracted_ts", F.col("extraction_error").alias("error"), "study_design", "treatment_outcomes")
    told = told.select("pubmed_id", extraction.alias("told"))
    ids = dated.select("pubmed_id").unionByName(told.select("pubmed_id")).distinct()
    before = _state(store, ids, step - 1) if done else ids.withColumn("was", F.lit(None).cast(_ROW)).limit(0)
    met = _by_id(ids, before, dated, told)
    later = F.col("told").isNotNull() & (
        F.col("was.extracted_ts").isNull() | (F.col("told.extracted_ts") >= F.col("was.extracted_ts"))
    )
    fields = ("extracted_ts", "error", "study_design", "treatment_outcomes")
    now = F.struct(
        (F.coalesce("was.has_article", F.lit(False)) | F.coalesce("arrived", F.lit(False))).alias("has_article"),
        F.coalesce("was.year", "year").alias("year"),
        *[F.when(later, F.col(f"told.{f}")).otherwise(F.col(f"was.{f}")).alias(f) for f in fields],
    )
    path = f"{store.root}/partials/rows/step={step}"
    met = met.select("pubmed_id", "was", now.cast(_ROW).alias("now"), id_range("pubmed_id").alias("range"))
    met.repartition("range").write.mode("overwrite").partitionBy("range").parquet(path)
    changed = spark.read.schema(f"was {_ROW}, now {_ROW}").parquet(path)
    sides = F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("was").alias("r")), F.struct(F.lit(1).alias("sign"), F.col("now").alias("r"))
    )
    changed = changed.select(F.inline(sides)).where(F.col("r").isNotNull()).select("sign", "r.*")
    parts = {
        **_of_changes(changed),
        "mesh_cooccurrence_network": evidence.mesh_cooccurrence(articles, min_count=1),
        "research_geography_analysis": evidence.research_geography(rows("authors", "articles"), articles),
        "funding_landscape_analysis": evidence.funding_parts(rows("grants", "articles"), articles),
    }
    folder = _versions(store).current() if done else None
    tables = {}
    for name, sums in SUMS.items():
        part = parts[name]
        if folder is not None:
            part = part.unionByName(spark.read.parquet(f"{folder}/{name}"))
        tables[name] = part.groupBy(*sums.key).agg(*[c.alias(n) for n, c in sums.fold().items()])
    folded = [(t, b, s) for (t, b), s in done.items()] + [(t, b, step) for t, b in new]
    tables["progress"] = spark.createDataFrame(folded, _PROGRESS).coalesce(1)
    _versions(store).write(**tables)
    return new


def _of_changes(changed: DataFrame) -> dict[str, DataFrame]:
    """Sums over rows that count ``sign`` times."""

    def times(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("sign")).otherwise(0)).cast("bigint")

    told = F.col("extracted_ts").isNotNull()
    pairs = changed.where(told & F.col("error").isNull()).select("sign", F.explode("treatment_outcomes").alias("pair"))
    matrix = pairs.groupBy(
        F.lower("pair.treatment").alias("treatment"), F.lower("pair.outcome").alias("outcome")
    ).agg(
        F.sum("sign").cast("bigint").alias("frequency"),
        *[times(F.col("pair.effect_direction") == e).alias(e) for e in _EFFECTS],
    )
    dated = changed.where(F.col("has_article") & F.col("year").isNotNull())
    design = F.col("study_design")
    trends = dated.groupBy("year").agg(
        F.sum("sign").cast("bigint").alias("article_count"),
        times(design == "randomized_controlled_trial").alias("rct_count"),
        times(design.isin(*REVIEW_DESIGNS)).alias("review_count"),
        times(design == "case_report").alias("case_report_count"),
    )
    named = F.coalesce(blank_to_null(design), F.lit("unknown")).alias("study_design")
    designs = dated.where(told).groupBy("year", named).agg(F.sum("sign").cast("bigint").alias("article_count"))
    return {
        "treatment_outcome_matrix": matrix,
        "publication_trend_analysis": trends,
        "study_design_trends": designs,
    }
