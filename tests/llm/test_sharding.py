import zlib
from collections import Counter

from pyspark.sql import functions as F

from souk.llm import sharding
from llm_helpers import words


def table(docs):
    rows = [(i, " ".join(words(5 + i % 50, i)), "en", "s") for i in range(500)]
    return docs(rows + [(500, None, None, None), (501, "", "en", "s"), (None, "é" * 20000, "en", "s"), (7, "same", "en", "s"), (7, "same", "en", "s")])


def test_law_and_digest(docs):
    d = table(docs)
    got = sharding.digest(sharding.external_shuffle(d, bucket_bytes=4096)).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in d.collect())
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(by) == list(range(16))
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_reruns_agree_and_seeds_differ(docs):
    d = table(docs)
    run = lambda x, seed: sorted(map(str, sharding.digest(sharding.external_shuffle(x, seed=seed, bucket_bytes=4096)).collect()))
    assert run(d, 1) == run(d.repartition(7), 1)
    assert run(d, 1) != run(d, 2)


def test_shuffled(docs):
    d = docs([(i, f"t {i}", "en", "s") for i in range(2000)])
    got = sharding.external_shuffle(d, shards=1, bucket_bytes=2000).select("row.doc_id", "slot").orderBy("slot").collect()
    ids = [r["doc_id"] for r in got]
    assert sorted(ids) == list(range(2000))
    assert sum(abs(a - b) == 1 for a, b in zip(ids, ids[1:])) < 20


def test_files(spark, docs, tmp_path):
    d = table(docs).withColumn("shard", F.lit("mine")).withColumn("key", F.lit(1))
    sharding.write_shards(d, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == d.count() and set(d.columns) < set(back.columns)
    assert len(list((tmp_path / "out").glob("_shard=*"))) == 4


def test_empty(docs):
    assert sharding.external_shuffle(docs([])).count() == 0


def test_a_hot_key_is_dealt_over_buckets(docs, monkeypatch):
    """A third of all bytes in rows equal in id and text: no bucket holds them all, and the law still holds."""
    monkeypatch.setattr(sharding, "COPIES", 64)
    rows = [(i, " ".join(words(20, i)), "en", "s") for i in range(1000)]
    rows += [(None, "the same text " * 8, "en", "s")] * 400 + [(4, " ".join(words(20, 4)), "en", "s")] * 3
    d = docs(rows)
    out = sharding.external_shuffle(d, bucket_bytes=8192)
    per = {r["bucket"]: r["bytes"] for r in out.groupBy("bucket").agg(F.sum(sharding.text_size(F.col("row.text"))).alias("bytes")).collect()}
    assert max(per.values()) < 2 * 8192
    got = sharding.digest(out).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], len(r[1]) + 1) for r in rows)
    by = Counter(r["shard"] for r in got)
    assert max(by.values()) - min(by.values()) <= 1
    assert sorted((r["shard"], r["slot"]) for r in got) == sorted((k, i) for k in by for i in range(by[k]))
    again = sharding.digest(sharding.external_shuffle(d.repartition(7), bucket_bytes=8192)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_offsets_of_many_blocks(docs, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 3)
    d = docs([(i, f"t {i}", "en", "s") for i in range(300)])
    got = sharding.external_shuffle(d, shards=1, bucket_bytes=100).select("slot").collect()
    assert sorted(r["slot"] for r in got) == list(range(300))


def test_clashing_names(docs):
    d = docs([(i, f"t {i}", "en", "s") for i in range(50)])
    for c in ("bucket", "_key", "key", "row", "_n", "position", "offset"):
        d = d.withColumn(c, F.lit("x"))
    out = sharding.external_shuffle(d, bucket_bytes=64)
    assert out.select("row.*").columns == d.columns and out.count() == 50
