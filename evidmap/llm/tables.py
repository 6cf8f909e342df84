"""Reading the corpus tables, writing intermediate ones."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidmap.runtime import new_folder

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH = "4m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again.

    What follows reads the table: it is computed once, and lost executors cost
    only their own tasks.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path, partitionBy=partition_by)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """From now on rows go to Python workers in batches of no more than ``BATCH`` bytes.

    A batch is held by the executor and by its worker, and the worker's answer by both again. A
    session with a setting of its own keeps it.
    """
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, BATCH)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``, in a worker: what Arrow keeps of those done goes back to the system, as workers live on."""
    for batch in batches:
        yield batch
        pa.default_memory_pool().release_unused()


def row_key(doc_id: Column, text: Column) -> Column:
    """64-bit key of a row by id and text; equal rows share it."""
    return F.xxhash64(doc_id, text)


def rows_fit(df: DataFrame, most: int) -> bool:
    """Whether ``df`` has at most ``most`` rows; looks at no more than one beyond."""
    return df.limit(most + 1).count() <= most
