"""Ingest operators: manifest, article and extraction writes, file bookkeeping.

They return the rows to write; nothing is stored here. Tables only grow: the
manifest and the extractions are change logs whose current rows
``current_manifest`` and ``current_extractions`` give.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evidmap.operators.relevance import is_relevant
from evidmap.schemas import EXTRACTION_FIELDS
from evidmap.sources.landing import ORDER_KEY


# ---- manifest -----------------------------------------------------------------


def upsert_manifest(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """The manifest after writing ``files(file_name, md5_checksum, record_count,
    ingest_ts)``. A known file only gets its new record count."""
    old, new = manifest.alias("old"), files.alias("new")
    joined = old.join(new, F.col("old.file_name") == F.col("new.file_name"), "full_outer")

    def keep(name: str, first: str, second: str) -> Column:
        return F.coalesce(f"{first}.{name}", f"{second}.{name}").alias(name)

    return joined.select(
        keep("file_name", "old", "new"),
        keep("md5_checksum", "old", "new"),
        keep("record_count", "new", "old"),
        keep("ingest_ts", "old", "new"),
    )


def current_manifest(changes: DataFrame) -> DataFrame:
    """The manifest a log of writes amounts to: first checksum and time, last count."""
    return changes.groupBy("file_name").agg(
        F.min_by("md5_checksum", "ingest_ts").alias("md5_checksum"),
        F.max_by("record_count", "ingest_ts").alias("record_count"),
        F.min("ingest_ts").alias("ingest_ts"),
    )


def files_to_ingest(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose name the manifest does not hold yet."""
    return files.join(manifest.select("file_name"), "file_name", "left_anti")


# ---- articles -----------------------------------------------------------------


def first_per_id(articles: DataFrame, order: Sequence[str | Column] = ORDER_KEY) -> DataFrame:
    """The first row of each ``pubmed_id``.

    Spark turns ``row_number() = 1`` into a group limit before the shuffle, so
    each task sends at most one row per id, however many copies there are.
    """
    by_id = W.partitionBy("pubmed_id").orderBy(*order)
    return articles.withColumn("copy", F.row_number().over(by_id)).where("copy = 1").drop("copy")


def new_articles(
    articles: DataFrame,
    stored_ids: DataFrame,
    order: Sequence[str | Column] = ORDER_KEY,
    cut_down: bool = True,
) -> DataFrame:
    """The rows to insert. Stored articles stay, the first of several copies wins.

    The stored ids are first cut down to those that arrive again: that semi-join
    can broadcast the ids of a small batch, or filter by them, and then does not
    shuffle the whole store. ``articles`` is read twice, so it should be a table.
    Without ``cut_down`` the stored ids, which are few then, are joined as they are.
    """
    known = stored_ids.select("pubmed_id")
    if cut_down:
        known = known.join(articles.select("pubmed_id"), "pubmed_id", "left_semi")
    return first_per_id(articles, order).join(known, "pubmed_id", "left_anti")


def author_rows(articles: DataFrame) -> DataFrame:
    """Authors with their place in the article."""
    return _children(articles, "authors", "author_no")


def grant_rows(articles: DataFrame) -> DataFrame:
    """Grants with their place in the article."""
    return _children(articles, "grants", "grant_no")


def _children(articles: DataFrame, column: str, place: str) -> DataFrame:
    return articles.select("pubmed_id", F.posexplode(column).alias(place, "child")).select(
        "pubmed_id", place, "child.*"
    )


# ---- extractions --------------------------------------------------------------


def upsert_extractions(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Extractions after writing ``incoming``.

    An id that exists gets all fields of its newest row but keeps its first time.
    """
    changes = stored.withColumn("write_no", F.lit(0)).unionByName(
        incoming.withColumn("write_no", F.lit(1))
    )
    return current_extractions(changes, F.struct("write_no", "extracted_ts"))


def current_extractions(changes: DataFrame, order: Column | None = None) -> DataFrame:
    """The extractions a log of writes amounts to; ``order`` defaults to the write time.

    The fields of a row are taken one by one, so that a reader of few of them
    does not have the others read.
    """
    order = F.col("extracted_ts") if order is None else order
    return changes.groupBy("pubmed_id").agg(
        *[F.max_by(name, order).alias(name) for name in EXTRACTION_FIELDS],
        F.min_by("extracted_ts", order).alias("extracted_ts"),
    )


def pending_abstracts(
    articles: DataFrame,
    extractions: DataFrame,
    limit: int | None = None,
    retry_failed: bool = False,
) -> DataFrame:
    """(pubmed_id, abstract) without an extraction yet; with ``limit`` the first by id.

    A failed extraction counts as done unless ``retry_failed``.
    """
    done = extractions
    if retry_failed:
        done = done.where(F.col("extraction_error").isNull())
    pending = (
        articles.where(F.col("abstract").isNotNull())
        .select("pubmed_id", "abstract")
        .join(done.select("pubmed_id"), "pubmed_id", "left_anti")
    )
    return pending if limit is None else pending.orderBy("pubmed_id").limit(limit)


# ---- file bookkeeping ---------------------------------------------------------


def partition_sync(
    spark: SparkSession, registered: DataFrame, start: int = 1200, end: int = 1209
) -> DataFrame:
    """What makes ``registered(file_number)`` the range start..end (inclusive).

    Rows (file_number, action): add, remove or keep.
    """
    wanted = spark.range(start, end + 1).select(
        F.col("id").cast("int").alias("file_number"), F.lit(True).alias("wanted")
    )
    known = registered.select("file_number").distinct().withColumn("known", F.lit(True))
    action = (
        F.when(F.col("known").isNull(), "add").when(F.col("wanted").isNull(), "remove")
    ).otherwise("keep")
    return wanted.join(known, "file_number", "full_outer").select(
        "file_number", action.alias("action")
    )


def sync_report(actions: DataFrame) -> DataFrame:
    """Numbers of removed, added and now registered files."""
    action = F.col("action")
    return actions.agg(
        F.count_if(action == "remove").alias("removed"),
        F.count_if(action == "add").alias("added"),
        F.count_if(action != "remove").alias("total"),
    )


def within_budget(files: DataFrame, target: int = 200, block: int = 1000) -> DataFrame:
    """Files in descending ``file_number`` up to the one whose ``inserted`` brings
    the running total to ``target``; adds that total as ``running``.

    The running sum has two levels, so no task orders all files: inside blocks
    of ``block`` file numbers, plus the totals of the blocks above.
    """
    blocked = files.withColumn("block", F.floor(F.col("file_number") / block).cast("bigint"))
    totals = blocked.groupBy("block").agg(F.sum("inserted").alias("block_total"))
    above = W.orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    # one row per ``block`` files reaches this window
    offsets = totals.select(
        "block", F.coalesce(F.sum("block_total").over(above), F.lit(0)).alias("offset")
    )
    inside = (
        W.partitionBy("block")
        .orderBy(F.desc("file_number"))
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    running = F.col("offset") + F.sum("inserted").over(inside)
    return (
        blocked.join(offsets, "block")
        .withColumn("running", running)
        .where(F.col("running") - F.col("inserted") < target)
        .drop("block", "offset")
    )


def ingest_summary(
    articles: DataFrame, stored_ids: DataFrame, files: DataFrame, manifest: DataFrame
) -> DataFrame:
    """Per file total_parsed, filtered, inserted and status.

    ``files(file_name)`` in the manifest already are skipped and have no counts.
    """
    fresh = articles.join(
        manifest.select(F.col("file_name").alias("source_file")), "source_file", "left_anti"
    ).withColumn("relevant", is_relevant())
    inserted = new_articles(fresh.where("relevant"), stored_ids).select("source_file")
    counts = (
        fresh.select("source_file", F.col("relevant").cast("int").alias("kept"), F.lit(0).alias("new"))
        .unionByName(
            inserted.select("source_file", F.lit(None).cast("int").alias("kept"), F.lit(1).alias("new"))
        )
        .groupBy(F.col("source_file").alias("file_name"))
        .agg(
            # rows of the second part have no ``kept``
            F.count("kept").alias("total_parsed"),
            F.sum("kept").alias("filtered"),
            F.sum("new").alias("inserted"),
        )
    )
    known = manifest.select("file_name").withColumn("skipped", F.lit(True))
    skipped = F.coalesce("skipped", F.lit(False))

    def number(name: str) -> Column:
        return F.when(~skipped, F.coalesce(name, F.lit(0))).cast("bigint").alias(name)

    return (
        files.select("file_name")
        .join(known, "file_name", "left")
        .join(counts, "file_name", "left")
        .select(
            "file_name",
            number("total_parsed"),
            number("filtered"),
            number("inserted"),
            F.when(skipped, "skipped").otherwise("ingested").alias("status"),
        )
    )
