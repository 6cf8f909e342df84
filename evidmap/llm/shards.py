"""Shuffled shards by a two-pass external shuffle.

The shard of a record is the one of highest seeded hash of (id, shard): it depends on id
and number of shards only, and one more shard takes records only into itself. Pass one
scatters the records of each shard over buckets of memory size by a second seeded hash;
pass two sorts each bucket into a fixed order, shuffles it by Fisher-Yates with a seed
of its own, and writes it. A record's slot is its place in the bucket behind all earlier
buckets of its shard, so a lost task writes the same slots again.

Edge cases: a null text has no bytes (its size is 1); null ids form one key; rows of
one id lie in one shard, over all its buckets when their texts differ; rows equal in id
and text are interchangeable; an empty table gives no shards; columns other than id and
text are carried along, but none may be named like the added ones.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from evidmap.llm.catalog import query
from evidmap.llm.tables import table
from evidmap.runtime import new_folder

SHARDS = 16
SEED = 20_240_601
BUCKET_BYTES = 16 << 20
ADDED = ("shard", "grown_shard", "bucket", "place", "_order")


def shard_of(doc_id: Column, shards: int, seed: int = SEED) -> Column:
    """The shard whose hash with the id is highest; of equals, the first."""
    draws = [
        F.struct(F.xxhash64(doc_id, F.lit(seed), F.lit(s)).alias("draw"), F.lit(-s).alias("shard"))
        for s in range(shards)
    ]
    return (-F.greatest(*draws)["shard"] if shards > 1 else F.lit(0)).cast("int")


def _fisher_yates(seed: int, order: list[str]):
    """Rows of a bucket in an order that depends on their content and the seed only."""

    def shuffle(bucket: pa.Table) -> pa.Table:
        bucket = bucket.sort_by([(c, "ascending") for c in order])
        number = bucket.column("bucket")[0].as_py()
        places = np.arange(len(bucket))
        # numpy's shuffle is Fisher-Yates
        np.random.Generator(np.random.PCG64([seed, number])).shuffle(places)
        bucket = bucket.take(pa.array(places))
        return bucket.append_column("place", pa.array(np.arange(len(bucket))))

    return shuffle


def write_shards(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Write ``docs`` below ``path``, a folder for each shard, and read it again.

    Added columns: shard, grown_shard (with one shard more), bucket, place (in the bucket);
    :func:`with_slots` gives the place in the shard.
    """
    clash = set(ADDED) & set(docs.columns)
    if clash:
        raise ValueError(f"columns named like the added ones: {sorted(clash)}")
    spark = docs.sparkSession
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1
    shard = shard_of(F.col(doc_id), shards, seed)
    sizes = docs.select(shard.alias("shard"), size.alias("size")).groupBy("shard").agg(F.sum("size").alias("n"))
    sizes = {row.shard: row.n for row in sizes.collect()}  # one row per shard
    buckets = [max(1, -(-sizes.get(s, 0) // bucket_bytes)) for s in range(shards)]
    first = [sum(buckets[:s]) for s in range(shards)]
    scattered = (
        docs.withColumn("shard", shard)
        .withColumn("grown_shard", shard_of(F.col(doc_id), shards + 1, seed))
        .withColumn("_order", F.xxhash64(text))
    )
    of_shard = F.element_at(F.array(*map(F.lit, buckets)).cast("array<bigint>"), F.col("shard") + 1)
    before = F.element_at(F.array(*map(F.lit, first)).cast("array<bigint>"), F.col("shard") + 1)
    draw = F.pmod(F.xxhash64(doc_id, "_order", F.lit(seed + 1)), of_shard)
    scattered = scattered.withColumn("bucket", before + draw)
    schema = T.StructType(
        [f for f in scattered.schema if f.name != "_order"] + [T.StructField("place", T.LongType())]
    )
    mixed = scattered.groupBy("bucket").applyInArrow(
        _dropping(_fisher_yates(seed, [doc_id, "_order"]), "_order"), schema
    )
    mixed.write.partitionBy("shard").parquet(path)
    written = spark.read.schema(T.StructType([*[f for f in schema if f.name != "shard"], schema["shard"]]))
    return written.parquet(path)

def with_slots(rows: DataFrame) -> DataFrame:
    """``slot`` for rows of written shards, of which only shard, bucket and place are needed."""
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    slot = F.col("_offset") + F.col("place")
    return rows.join(offsets, "bucket").withColumn("slot", slot).drop("_offset")


def _dropping(function, column: str):
    def run(bucket: pa.Table) -> pa.Table:
        return function(bucket).drop_columns([column])

    return run


@query("op4_shards")
def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = write_shards(docs, new_folder(spark, "shards"))
    text = F.coalesce("text", F.lit(""))
    rows = out.select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "grown_shard",
        "bucket",
        "place",
    )
    return with_slots(rows).drop("bucket", "place")
