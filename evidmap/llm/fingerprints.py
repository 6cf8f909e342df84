"""Document fingerprints, in DataFrame operations only: a Merkle tree of each text.

The root hashes the sections (parts between blank lines), a section hashes its
paragraphs (lines), a paragraph hashes its text, all SHA-256. Cutting at line ends
can be undone by joining, so equal roots mean equal texts, and two trees differ
only below the branches that an edit has touched. Below each paragraph lie pieces of
at most eight words that end with a sentence; only their 64-bit hashes are kept.
The likeness of two fingerprints is the share of pieces that both have (Dice).

Edge cases: a null text counts as empty; two texts without pieces are alike (1) when
they are equal, else 0; documents of equal id follow each other by descending text;
null ids come last; the only document of a table is followed by itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from evidmap.llm.catalog import query
from evidmap.llm.tables import table

SPACE = r"\x20\x09-\x0D"
PIECE = rf"(?:[^{SPACE}]*[^{SPACE}.!?][{SPACE}]+){{0,7}}[^{SPACE}]+[{SPACE}]*"
FINE = 64


def merkle_tree(df: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """``df`` with the levels of the tree of ``text``, which must not be null.

    root string, sections array<string>, paragraphs array<array<string>> (by
    section), pieces array<bigint> (distinct), each name after ``prefix``.
    """
    lines = f"{prefix}_lines"
    df = df.withColumn(
        lines, F.transform(F.split(text, "\n\n", -1), lambda s: F.split(s, "\n", -1))
    )
    df = df.withColumn(
        f"{prefix}paragraphs",
        F.transform(lines, lambda section: F.transform(section, lambda p: F.sha2(p, 256))),
    )
    df = df.withColumn(
        f"{prefix}sections",
        F.transform(
            f"{prefix}paragraphs",
            lambda p: F.sha2(F.concat(F.lit("section"), F.array_join(p, "")), 256),
        ),
    )
    root = F.concat(F.lit("document"), F.array_join(f"{prefix}sections", ""))
    pieces = F.flatten(
        F.transform(
            F.flatten(lines),
            lambda p: F.transform(
                F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)), lambda x: F.xxhash64(x)
            ),
        )
    )
    return (
        df.withColumn(f"{prefix}root", F.sha2(root, 256))
        .withColumn(f"{prefix}pieces", F.array_distinct(pieces))
        .drop(lines)
    )


def likeness(a: str, b: str, same: Column) -> Column:
    """Dice of two piece sets; ``same`` decides where both are empty."""
    total = F.size(a) + F.size(b)
    shared = F.size(F.array_intersect(a, b))
    return F.when(total > 0, 2.0 * shared / F.greatest(total, F.lit(1))).otherwise(
        same.cast("double")
    )


def first_difference(a: Column, b: Column) -> Column:
    """Place (from 0) of the first branch in which two levels differ; null if in none."""
    place = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(place > 0, place - 1)


def _range_bucket(value: Column, splits: list) -> Column:
    """How many of the ordered ``splits`` lie at or below ``value``; searched in two steps."""
    if not splits:
        return F.lit(0)
    coarse = splits[FINE - 1 :: FINE]
    fine = [splits[i : i + FINE - 1] for i in range(0, len(splits), FINE)]
    fine += [[]] * (len(coarse) + 1 - len(fine))

    def below(options: Column) -> Column:
        return F.size(F.filter(options, lambda s: s <= value))

    def literal(values: list) -> Column:
        return F.array(*map(F.lit, values)).cast("array<double>")

    step = below(literal(coarse))
    return step * FINE + below(F.element_at(F.array(*map(literal, fine)), step + 1))


def in_order(docs: DataFrame, doc_id: str) -> tuple[DataFrame, WindowSpec]:
    """Rows of ``docs`` and a window in which ``lead`` gives the document that follows by
    descending id; the first one follows the last.

    Texts are shuffled once, by ranges of ids whose bounds are quantiles of all ids
    (four for each shuffle partition). Each range also holds the first row of the next
    one, marked as ``_ghost``, to be taken out after the window.
    """
    spark = docs.sparkSession
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / n for i in range(1, n)]
    splits = []
    if shares:
        found = docs.agg(F.percentile_approx(doc_id, shares, 100 * n).alias("at")).first().at
        splits = sorted(set(found or []))
    docs = docs.withColumn("_range", _range_bucket(F.col(doc_id), splits))
    heads = docs.groupBy("_range").agg(F.max(doc_id).alias("_head"))
    # one row per range: no more rows than ranges
    by_range = Window.orderBy("_range")
    heads = heads.select(
        "_head",
        F.coalesce(F.lead("_range").over(by_range), F.min("_range").over(Window.partitionBy(F.lit(0))))
        .alias("_to"),
    )
    ghosts = docs.join(F.broadcast(heads), F.col(doc_id).eqNullSafe(F.col("_head")))
    rest = [c for c in docs.columns if c not in (doc_id, "_range")]
    ghosts = ghosts.groupBy(F.col("_to").alias("_range"), doc_id).agg(
        F.max(F.struct(*rest)).alias("_row")
    )
    ghosts = ghosts.select("_range", doc_id, "_row.*", F.lit(True).alias("_ghost"))
    both = docs.withColumn("_ghost", F.lit(False)).unionByName(ghosts)
    order = Window.partitionBy("_range").orderBy(
        "_ghost", F.col(doc_id).desc_nulls_last(), *[F.col(c).desc() for c in rest]
    )
    return both.repartition("_range"), order


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_chars, its tree, the edited text (its second half replaced
    by the start of the next document) with its tree, the likeness of both and of the
    next document, and the first section and paragraph that the edit has changed.
    """
    docs = docs.select(F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    both, order = in_order(docs, "id")
    both = merkle_tree(both, "text")
    both = both.withColumn("next", F.lead(F.struct("text", "pieces", "root")).over(order))
    df = both.where(~F.col("_ghost")).withColumn("n_chars", F.length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = (F.col("n_chars") - half).cast("int")
    df = df.withColumn(
        "edited", F.concat(F.left("text", kept), F.left(F.col("next")["text"], half))
    )
    df = df.withColumn("next_pieces", F.col("next.pieces")).withColumn(
        "next_root", F.col("next.root")
    )
    df = merkle_tree(df.drop("next"), "edited", "edited_")
    section = first_difference(F.col("sections"), F.col("edited_sections"))
    df = df.withColumn("changed_section", section)
    place = (F.col("changed_section") + 1).cast("int")
    return df.select(
        "id",
        "n_chars",
        "edited",
        "root",
        "sections",
        "paragraphs",
        "edited_root",
        likeness("pieces", "edited_pieces", F.col("root") == F.col("edited_root")).alias("near_edited"),
        likeness("pieces", "next_pieces", F.col("root") == F.col("next_root")).alias("near_next"),
        "changed_section",
        first_difference(
            F.coalesce(F.try_element_at("paragraphs", place), F.array().cast("array<string>")),
            F.coalesce(F.try_element_at("edited_paragraphs", place), F.array().cast("array<string>")),
        ).alias("changed_paragraph"),
    )


def _oracle() -> str:
    def pieces(text: str) -> str:
        return rf"""list_distinct(flatten(list_transform(string_split({text}, chr(10)),
            lambda p: regexp_extract_all(p, '{PIECE}'))))"""

    def root(text: str) -> str:
        return rf"""sha256('document' || array_to_string(list_transform(
            string_split({text}, chr(10) || chr(10)), lambda s: sha256('section' || array_to_string(
                list_transform(string_split(s, chr(10)), lambda p: sha256(p)), ''))), ''))"""

    def dice(a: str, b: str, same: str) -> str:
        return rf"""CASE WHEN len({a}) + len({b}) > 0
            THEN 2.0 * len(list_intersect({a}, {b})) / (len({a}) + len({b}))
            ELSE CAST({same} AS DOUBLE) END"""

    return rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text FROM documents
), n AS (
    SELECT doc_id, text, length(text) AS n_chars,
        coalesce(lead(text) OVER o, first_value(text) OVER o) AS next
    FROM d WINDOW o AS (ORDER BY doc_id DESC NULLS LAST, text DESC
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), e AS (
    SELECT *, left(text, n_chars - n_chars // 2) || left(next, n_chars // 2) AS edited FROM n
), t AS (
    SELECT *, {root('text')} AS r, {root('edited')} AS er, {pieces('text')} AS p,
        {pieces('edited')} AS ep, {pieces('next')} AS np
    FROM e
)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, r AS fingerprint,
    er AS edited_fingerprint, {dice('p', 'ep', 'r = er')} AS near_edited,
    {dice('p', 'np', 'text = next')} AS near_next
FROM t
"""


@query("op1_fingerprints", _oracle())
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("root").alias("fingerprint"),
        F.col("edited_root").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
