"""Two-pass external shuffle into shards.

Pass one scatters the rows uniformly into memory-sized buckets by a seeded
hash of the row's id and text.  Rows equal in both would all fall into one
bucket; if they hold more than a sixteenth of a bucket they are numbered, in
slices, and scattered by hash and number.  Pass two loads one bucket at a time,
shuffles it with Fisher-Yates (numpy, seeded by the bucket) and numbers its
rows; with the bucket's offset that is a position in one global random order,
and the rows are dealt to the shards in turn.  So the shard sizes in rows differ
by one at most (law ``rows``), slots are gapless from 0, and reruns agree: a
bucket is sorted by hash and id before it is shuffled.

A bucket meets its offset in a cogroup: nothing that grows with the data is
broadcast, and no task sees the offsets of all buckets.

Defined cases: a null text has size 1 (no bytes plus one) and crc32 0; a null
id is hashed like a value; rows equal in id and text are interchangeable; a row
longer than a bucket is a bucket's only excess; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import packed, running, ship, stash, table

BUCKET_BYTES = 16 << 20
#: buckets whose offsets are summed together; copies of a key numbered together, on average
BLOCK, COPIES = 4096, 10_000


def text_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc(text: Column) -> Column:
    return F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long")


def _numbered(df: DataFrame, key: Column, hot: DataFrame) -> DataFrame:
    """The rows of hot keys with a number from 1 within their key; written first, so that a row's number stays."""
    some = df.withColumn("_key", key).join(hot, "_key").withColumn("_one", F.lit(1))
    some = stash(some, "shard_copies").withColumn("_id", F.monotonically_increasing_id())
    some = some.withColumn("_slice", F.pmod(F.xxhash64("_id"), F.ceil(F.col("_n") / COPIES)))
    return running(some, ["_key"], "_slice", [F.col("_id")], "_one", "_number").drop("_one", "_id", "_slice", "_n")


def external_shuffle(df: DataFrame, shards: int = 16, seed: int = 11, bucket_bytes: int = BUCKET_BYTES,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns row (the whole row as a struct), bucket, shard, slot."""
    key = F.xxhash64(F.lit(seed), F.col(f"row.`{id_col}`"), F.col(f"row.`{text_col}`"))
    rows = df.select(packed(df, "row"))
    # 16 bytes a row, counted from here on
    keys = stash(rows.select(key.alias("_key"), text_size(F.col(f"row.`{text_col}`")).alias("size")), "shard_keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-int(total) // bucket_bytes))
    copies = keys.groupBy("_key").agg(F.count("*").alias("_n"), F.sum("size").alias("_bytes"))
    hot = stash(copies.filter((F.col("_n") > 1) & (F.col("_bytes") > bucket_bytes // 16)).select("_key", "_n"), "shard_hot")

    bucket_of = F.pmod("_key", F.lit(buckets))
    salted = F.pmod(F.xxhash64("_key", "_number"), F.lit(buckets))
    scattered, at = rows.select("row", key.alias("_key")).withColumn("bucket", bucket_of), keys.select("_key", bucket_of.alias("bucket"))
    if not hot.isEmpty():
        dealt = _numbered(rows, key, hot).withColumn("bucket", salted).select("row", "_key", "bucket")
        scattered = scattered.join(hot.select("_key"), "_key", "left_anti").select("row", "_key", "bucket").unionAll(dealt)
        runs = hot.select("_key", "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES))).alias("_run"))
        numbers = runs.repartition("_key", "_run").select("_key", F.explode(F.sequence(
            F.col("_run") * COPIES + 1, F.least("_n", (F.col("_run") + 1) * COPIES))).alias("_number"))
        at = at.join(hot.select("_key"), "_key", "left_anti").unionAll(numbers.select("_key", salted.alias("bucket")))
    scattered = scattered.withColumnRenamed("_key", "key")

    counts = at.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("block", F.floor(F.col("bucket") / BLOCK))
    offsets = (running(counts, [], "block", [F.col("bucket")], "n", "upto")
               .select("bucket", (F.col("upto") - F.col("n")).alias("offset")))
    schema = T.StructType([*scattered.schema.fields, T.StructField("position", T.LongType())])

    def shuffle(t: pa.Table, offset: pa.Table) -> pa.Table:
        if not t.num_rows:
            return t.append_column("position", pa.array([], pa.int64()))
        bucket = t.column("bucket")[0].as_py()
        tie = pc.struct_field(t.column("row").combine_chunks(), id_col)
        order = pc.sort_indices(pa.table({"key": t.column("key"), "id": tie}),
                                sort_keys=[("key", "ascending"), ("id", "ascending")]).to_numpy()
        order = order.copy()
        np.random.Generator(np.random.PCG64([seed, bucket])).shuffle(order)  # Fisher-Yates
        place = np.arange(len(order), dtype=np.int64) + offset.column("offset")[0].as_py()
        return t.take(pa.array(order)).append_column("position", pa.array(place))

    ship(df.sparkSession)
    placed = scattered.groupBy("bucket").cogroup(offsets.groupBy("bucket")).applyInArrow(shuffle, schema)
    return placed.select("row", "bucket", F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
                         F.floor(F.col("position") / shards).cast("long").alias("slot"))


def write_shards(df: DataFrame, path: str, **options) -> None:
    """The shards as files: one folder per shard, rows in slot order within each file."""
    out = external_shuffle(df, **options)
    (out.select("row.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
     .repartition("_shard", F.floor(F.col("_slot") / 1_000_000)).sortWithinPartitions("_shard", "_slot")
     .drop("_slot").write.partitionBy("_shard").parquet(path))


def digest(shuffled: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.col(f"row.{text_col}")
    return shuffled.select(F.col(f"row.{id_col}").alias("doc_id"), text_size(text).alias("size"), text_crc(text).alias("text_crc32"),
                           F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6(spark, sf_dir: str) -> DataFrame:
    """Two-pass external shuffle of all documents into 16 shards: the shuffled buckets are written, then described."""
    return digest(stash(external_shuffle(table(spark, sf_dir, "documents")), "shuffled"))
