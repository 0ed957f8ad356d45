"""Incremental ingest with Structured Streaming.

Landing files (JSON Lines, one fetched page per line) are picked up as they
arrive and flattened; of every item id the first row (by fetch time and place in
the page) of the micro-batch that first holds it is written.  So the rows are
those the batch job keeps if files arrive in fetch order: the first seen wins, and
an item seen for the first time is written however late it comes.

What has been seen is keyed streaming state: one entry per item id, in the state
store of the query (RocksDB unless the session names another provider), found by
key.  A micro-batch touches the entries of its own ids and reads nothing of the
sink, however large that has grown.

With a watermark the memory is bounded by time instead: a batch compares with the
rows written lately.  Every batch folder's span of fetch times is noted beside the
sink, and only folders that reach into the last stretch are read.

The sink has one folder per micro-batch (``batch_id=N``).  The checkpoint makes the
job resumable; a batch that is replayed after a failure starts from the state
before it and overwrites its own folder, so the output is exactly-once.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from souk.operators.dedup import dedup_first
from souk.session import ROCKSDB_PROVIDER
from souk.sources.payloads import LANDING_DDL, flatten_shopee, split_malformed

ARRIVAL = ["fetched_at", "item_pos"]
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
SPANS = "_spans"
SPAN_DDL = "n BIGINT, latest TIMESTAMP, batch_id INT"


def shopee_stream(spark: SparkSession, in_dir: str, files_per_batch: int | None = None) -> DataFrame:
    r = spark.readStream.schema(LANDING_DDL)
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    landing = r.json(in_dir)
    good, _ = split_malformed(landing)
    return flatten_shopee(good)


def first_seen(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Of a stream, the rows that come first of their key, each in the micro-batch that first holds the key.

    A streaming aggregate in update mode returns the keys of the batch with the
    earliest and latest batch time they were seen at; a key is new where both are this batch's.
    Rows of a key are combined before the shuffle.
    """
    # the micro-batch's time is kept in its log, so a replay has the same
    seen = rows.withColumn("_now", F.current_timestamp()).groupBy(key).agg(
        F.min_by(F.struct(*[F.col(c) for c in rows.columns]), F.struct(*[F.col(c) for c in order])).alias("_first"),
        F.min("_now").alias("_since"), F.max("_now").alias("_until"))
    return seen.where(F.col("_since") == F.col("_until")).select("_first.*")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _note_span(batch: DataFrame, out_dir: str, batch_id: int) -> int:
    """Write a batch folder's number of rows and latest fetch time (one row); returns the number."""
    span = batch.agg(F.count(F.lit(1)).alias("n"), F.max("fetched_at").alias("latest")).coalesce(1)
    path = f"{out_dir.rstrip('/')}/{SPANS}/batch_id={batch_id}"
    span.write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.schema("n BIGINT").parquet(path).first()["n"]


def _spans(spark: SparkSession, out_dir: str, before: int | None = None) -> DataFrame | None:
    """One row per batch folder: n, latest, batch_id; None while there are none."""
    path = f"{out_dir.rstrip('/')}/{SPANS}"
    if not _exists(spark, path):
        return None
    spans = spark.read.schema(SPAN_DDL).parquet(path)
    return spans if before is None else spans.where(F.col("batch_id") < before)


def written_lately(spark: SparkSession, out_dir: str, before: int, watermark: str, schema) -> DataFrame | None:
    """Rows of earlier batches whose fetch time is later than the latest written one less the watermark.

    Only the folders whose latest row is that late are read.
    """
    spans = _spans(spark, out_dir, before)
    last = spans.agg(F.max("latest").alias("m"), (F.max("latest") - F.expr(f"INTERVAL {watermark}")).alias("cut")).first() if spans is not None else None
    if last is None or last["m"] is None:
        return None
    cut = F.lit(last["cut"])
    folders = [r["batch_id"] for r in spans.where(F.col("latest") > cut).select("batch_id").collect()]
    base = out_dir.rstrip("/")
    full = T.StructType([*schema.fields, T.StructField("batch_id", T.IntegerType())])
    rows = spark.read.schema(full).option("basePath", base).parquet(*[f"{base}/batch_id={k}" for k in folders])
    return rows.where(F.col("fetched_at") > cut)


def stream_ingest(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, *,
                  watermark: str | None = None, files_per_batch: int | None = None,
                  available_now: bool = True, target: int | None = None) -> StreamingQuery:
    """Start the incremental Shopee ingest; returns the running (or, with
    ``available_now``, finished) query.

    Without ``watermark`` an id is written once.  With it (e.g. "1 hour") a batch
    compares with the rows written before it whose fetch time is later than the
    latest written one less the watermark: a repeat that comes after that is
    written again, and what has to be remembered is bounded.

    With ``target`` the query ends by itself when the sink holds that many rows;
    of the batch that reaches it, the first rows in order of arrival are written.
    """
    if spark.conf.get(STATE_PROVIDER, None) in (None, "", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"):
        spark.conf.set(STATE_PROVIDER, ROCKSDB_PROVIDER)
    rows = shopee_stream(spark, in_dir, files_per_batch)
    full = threading.Event()

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        spans = _spans(session, out_dir, batch_id) if target is not None else None
        held = (spans.agg(F.sum("n")).first()[0] or 0) if spans is not None else 0
        if target is not None and held >= target:
            full.set()
            return
        if watermark:
            batch = dedup_first(batch, ["itemid"], ARRIVAL)
            seen = written_lately(session, out_dir, batch_id, watermark, batch.schema)
            if seen is not None:
                batch = batch.join(seen.select("itemid").distinct(), "itemid", "left_anti").select(*batch.columns)
        if target is not None:
            batch = batch.orderBy(*ARRIVAL).limit(target - held)
        # one folder per batch, overwritten on replay: exactly-once output
        path = f"{out_dir.rstrip('/')}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        if watermark or target is not None:
            n = _note_span(session.read.schema(batch.schema).parquet(path), out_dir, batch_id)
            if target is not None and held + n >= target:
                full.set()

    out = rows if watermark else first_seen(rows, "itemid", ARRIVAL)
    w = out.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    if not watermark:
        w = w.outputMode("update")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start()

    def stop_when_full() -> None:
        while q.isActive:
            if full.wait(0.2):
                q.stop()
                return

    if target is not None:
        watcher = threading.Thread(target=stop_when_full, daemon=True)
        watcher.start()
        if available_now:
            watcher.join()
    if available_now:
        q.awaitTermination()
    return q


def read_sink(spark: SparkSession, out_dir: str, limit: int | None = None,
              order: list[str] | None = None) -> DataFrame:
    """The ingested table; with ``limit``, exactly the first ``limit`` rows in
    ``order`` (default: fetch time, then position in the page)."""
    df = spark.read.parquet(out_dir)
    if limit is None:
        return df
    return df.orderBy(*(order or ARRIVAL)).limit(limit)
