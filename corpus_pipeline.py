"""From documents to packed windows: every stage reads what the one before has written.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``. Rows go to Python workers in batches bounded by bytes, as a stage
of the pipeline shares its executors with what the stages before have left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evidmap.llm.decontaminate import decontaminated
from evidmap.llm.language import in_a_language
from evidmap.llm.lines import without_repeats
from evidmap.llm.packing import pack, public_tokenizer
from evidmap.llm.simhash import one_per_group
from evidmap.llm.tables import small_batches, table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language; texts that are null or without a letter go."""
    small_batches(spark)
    return in_a_language(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; a document that has lost all its lines goes.

    ``n_chars`` is that of the text that stays.
    """
    small_batches(spark)
    return without_repeats(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    small_batches(spark)
    return one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is in benchmark windows."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents in windows of 2048 tokens."""
    small_batches(spark)
    pieces = pack(docs, public_tokenizer())
    return pieces.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

# SQL has no SimHash, mixtures or tokenizer; tests/llm compares the stages with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
