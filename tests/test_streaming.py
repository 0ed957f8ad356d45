"""Incremental ingest equals the batch result; restart resumes from the checkpoint."""

import json
import os
import tempfile

from souk.operators.dedup import dedup_first
from souk.sources.payloads import flatten_shopee
from souk.streaming.ingest import read_sink, stream_ingest


def _write(path, rows):
    os.makedirs(path, exist_ok=True)
    n = len(os.listdir(path))
    name = os.path.join(path, f"part-{n:03d}.json")
    with open(name, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    os.utime(name, (1_700_000_000 + n, 1_700_000_000 + n))  # files are taken in order of their time


def _page(page, ts, ids):
    return {"platform": "Shopee", "url_key": "k", "page": page, "fetched_at": ts,
            "body": json.dumps({"items": [{"itemid": i, "shopid": 1} for i in ids]})}


def test_stream_equals_batch_and_resumes(spark):
    d = tempfile.mkdtemp(prefix="souk-stream-")
    src, out, ck = f"{d}/in", f"{d}/out", f"{d}/ck"
    _write(src, [_page(1, "2024-01-01T00:00:00", [1, 2, 3]), _page(2, "2024-01-01T00:01:00", [3, 4])])
    stream_ingest(spark, src, out, ck)
    first = {r.itemid for r in spark.read.parquet(out).collect()}
    assert first == {"1", "2", "3", "4"}
    # new files arrive; the restarted job reads only those and remembers seen ids
    _write(src, [_page(3, "2024-01-01T00:02:00", [4, 5, 1])])
    stream_ingest(spark, src, out, ck)
    rows = spark.read.parquet(out).collect()
    assert sorted(r.itemid for r in rows) == ["1", "2", "3", "4", "5"]
    # same ids as the batch keep-first over everything
    batch = flatten_shopee(spark.read.schema("platform string, url_key string, page int, fetched_at timestamp, "
                                             "body string").json(src))
    want = dedup_first(batch, ["itemid"], ["fetched_at", "item_pos"])
    got = spark.read.parquet(out).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))  # whole rows, not only ids


def test_late_first_seen_items_are_written(spark):
    d = tempfile.mkdtemp(prefix="souk-stream-")
    src, out, ck = f"{d}/in", f"{d}/out", f"{d}/ck"
    for page, ts, ids in ((1, "2024-01-01T05:00:00", [1]), (2, "2024-01-01T06:00:00", [2]), (3, "2024-01-01T01:00:00", [99, 2])):
        _write(src, [_page(page, ts, ids)])
        stream_ingest(spark, src, out, ck, watermark="1 hour")
    assert sorted(r.itemid for r in spark.read.parquet(out).collect()) == ["1", "2", "99"]


def test_replayed_batch_overwrites_its_folder(spark):
    d = tempfile.mkdtemp(prefix="souk-stream-")
    src, out = f"{d}/in", f"{d}/out"
    _write(src, [_page(1, "2024-01-01T00:00:00", [1, 2])])
    stream_ingest(spark, src, out, f"{d}/ck")
    stream_ingest(spark, src, out, f"{d}/ck2")  # a lost checkpoint: batch 0 runs again
    assert sorted(r.itemid for r in spark.read.parquet(out).collect()) == ["1", "2"]


def test_sink_reader_stops_at_the_target(spark):
    d = tempfile.mkdtemp(prefix="souk-stream-")
    src, out = f"{d}/in", f"{d}/out"
    _write(src, [_page(1, "2024-01-01T00:00:00", [3, 1]), _page(2, "2024-01-01T00:01:00", [2])])
    stream_ingest(spark, src, out, f"{d}/ck")
    assert [r.itemid for r in read_sink(spark, out, limit=2).collect()] == ["3", "1"]
    assert read_sink(spark, out).count() == 3


def test_watermark_bounds_state(spark):
    d = tempfile.mkdtemp(prefix="souk-stream-")
    src, out, ck = f"{d}/in", f"{d}/out", f"{d}/ck"
    _write(src, [_page(1, "2024-01-01T00:00:00", [1])])
    stream_ingest(spark, src, out, ck, watermark="1 hour")
    _write(src, [_page(2, "2024-01-01T05:00:00", [2])])
    stream_ingest(spark, src, out, ck, watermark="1 hour")
    _write(src, [_page(3, "2024-01-01T05:10:00", [1, 2])])
    stream_ingest(spark, src, out, ck, watermark="1 hour")
    ids = sorted(r.itemid for r in spark.read.parquet(out).collect())
    # item 1 left the state hours ago, so it is written again; item 2 is still remembered
    assert ids == ["1", "1", "2"]


def test_what_was_seen_is_state_and_not_the_sink(spark):
    """A batch that writes to another sink still knows the ids: nothing of the first sink is read."""
    d = tempfile.mkdtemp(prefix="souk-stream-")
    src, ck = f"{d}/in", f"{d}/ck"
    _write(src, [_page(1, "2024-01-01T00:00:00", [1, 2, 3])])
    stream_ingest(spark, src, f"{d}/first", ck)
    _write(src, [_page(2, "2024-01-01T00:02:00", [3, 9, 1])])
    q = stream_ingest(spark, src, f"{d}/second", ck)
    assert [r.itemid for r in spark.read.parquet(f"{d}/second").collect()] == ["9"]
    state = q.lastProgress["stateOperators"][0] if q.lastProgress["stateOperators"] else q.recentProgress[0]["stateOperators"][0]
    assert state["numRowsTotal"] == 4 and "rocksdb" in str(state["customMetrics"]).lower()


def test_watermark_reads_late_folders_only(spark):
    from souk.streaming.ingest import written_lately
    d = tempfile.mkdtemp(prefix="souk-stream-")
    src, out, ck = f"{d}/in", f"{d}/out", f"{d}/ck"
    for k in range(5):
        _write(src, [_page(k, f"2024-01-01T{2 * k:02d}:00:00", [k])])
        stream_ingest(spark, src, out, ck, watermark="1 hour")
    seen = written_lately(spark, out, 5, "1 hour", spark.read.parquet(out).drop("batch_id").schema)
    assert len(seen.inputFiles()) >= 1 and all("batch_id=4" in f for f in seen.inputFiles())
    assert [r.itemid for r in seen.collect()] == ["4"]
    assert written_lately(spark, out, 0, "1 hour", seen.schema) is None


def test_a_stream_ends_at_its_target(spark):
    d = tempfile.mkdtemp(prefix="souk-stream-")
    src, out, ck = f"{d}/in", f"{d}/out", f"{d}/ck"
    for k in range(6):
        _write(src, [_page(k, f"2024-01-01T00:0{k}:00", [10 * k + j + 1 for j in range(4)])])
    q = stream_ingest(spark, src, out, ck, files_per_batch=1, target=10)
    assert not q.isActive
    got = spark.read.parquet(out).orderBy("fetched_at", "item_pos").collect()
    assert [r.itemid for r in got] == ["1", "2", "3", "4", "11", "12", "13", "14", "21", "22"]
    again = stream_ingest(spark, src, out, ck, files_per_batch=1, target=10)  # what is full stays as it is
    assert not again.isActive and spark.read.parquet(out).count() == 10
    running = stream_ingest(spark, src, f"{d}/out2", f"{d}/ck2", files_per_batch=1, target=10, available_now=False)
    assert running.awaitTermination(120) and spark.read.parquet(f"{d}/out2").count() == 10
