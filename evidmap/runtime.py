"""Where jobs keep written tables and checkpoints."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Without that setting a folder in the warehouse, which executors share too. The
    context learns of the folder here, wherever the setting was made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_evidmap"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/evidmap/{app}/{label}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored(df: DataFrame, label: str = "step") -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and what follows
    outlives executors."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet folder, or an empty frame of ``schema`` when it is not there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _arrow(rows: Sequence[tuple], types: dict[str, pa.DataType]) -> pa.Table:
    columns = zip(*rows) if rows else ((),) * len(types)
    arrays = [pa.array(column, kind) for column, kind in zip(columns, types.values())]
    return pa.table(arrays, list(types))


def few_rows(spark: SparkSession, rows: Sequence[tuple], **types: pa.DataType) -> DataFrame:
    """Rows at hand as a table; no Python worker is started to read them."""
    return spark.createDataFrame(_arrow(rows, types))


def write_few_rows(spark: SparkSession, path: str, rows: Sequence[tuple], **types: pa.DataType) -> None:
    """Rows at hand as a Parquet folder in place of what is there, like a write of Spark but without
    a job: the file appears when it is whole, and ``_SUCCESS`` comes last."""
    sink = pa.BufferOutputStream()
    pq.write_table(_arrow(rows, types), sink)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = place(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(place(path), True)
    name = f"part-00000-{uuid.uuid4()}.parquet"
    # readers pass over names that begin with a dot
    out = files.create(place(f"{path}/.{name}"))
    out.write(bytearray(sink.getvalue()))
    out.close()
    if not files.rename(place(f"{path}/.{name}"), place(f"{path}/{name}")):
        raise OSError(f"{path}/{name} cannot be written")
    files.createNewFile(place(f"{path}/_SUCCESS"))


# A table of so many files is read by one task where rows meet: as many as a small micro-batch has.
FEW_FILES = 4


def has_few_files(rows: DataFrame) -> bool:
    return len(rows.inputFiles()) <= FEW_FILES


def met(rows: DataFrame) -> DataFrame:
    """Rows of a table; in one task if it has few files, so that rows of a key meet without a shuffle."""
    return rows.coalesce(1) if has_few_files(rows) else rows


def spread(df: DataFrame, tasks: int) -> DataFrame:
    """Rows over ``tasks`` tasks: for heavy work on a table that comes in few splits."""
    return df.repartition(tasks)
