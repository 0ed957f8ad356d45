import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from souk.llm import mixing
from llm_helpers import words


def brute_targets(sizes):
    """Shares by weight, capped at three times the size, the excess reshared until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, free, out = sum(sizes.values()), set(names), {}
    while free:
        left = total - sum(out.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return out | share
        out |= {s: 3.0 * sizes[s] for s in over}
        free -= over
    return out


def table(docs):
    rows = [(i, " ".join(words(1 + i % 37, i)), "en", f"s{i % 4}") for i in range(400)]
    rows += [(1000 + i, " ".join(words(3, i)), "en", "tiny") for i in range(3)]
    rows += [(2000, None, "en", None), (2001, "", "en", None), (2002, "one two", None, None), (None, "no id", "en", "s0")]
    rows += [(3000, "again and again", "en", "s1")] * 3
    return docs(rows)


def test_targets_and_taken(docs):
    d = table(docs)
    got = mixing.mix(d, carry=False).collect()
    sizes = defaultdict(int)
    for r in d.collect():
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    want = brute_targets(sizes)
    assert len(got) == d.count()
    taken, longest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["times"] <= 3
        taken[r["source"]] += r["times"] * r["size"]
        longest[r["source"]] = max(longest[r["source"]], r["size"] * (3 if r["id"] == 3000 else 1))
    for s, t in want.items():
        assert abs(taken[s] - t) <= 2 * longest[s] + 1, s
    assert sum(taken.values()) <= sum(sizes.values())


def test_slices_do_not_change_the_mix(docs):
    d = table(docs)
    runs = [sorted(map(str, mixing.mix(d, carry=False, slices=k).collect())) for k in (1, 7, 1024)]
    assert runs[0] == runs[1] == runs[2]


def test_copies_are_queued_one_by_one(docs):
    """A key with a third of all rows, null ids of one text, and a source that is one key: all near their targets."""
    rows = [(i, " ".join(words(1 + i % 9, i)), "en", f"s{i % 2}") for i in range(300)]
    rows += [(5000, "again and again", "en", "s0")] * 400 + [(None, "no id here", "en", "s1")] * 200 + [(6000, "all the same", "en", "a")] * 300
    rows += [(5000, "other text entirely", "en", "s0")] * 100
    d = docs(rows)
    runs = [mixing.mix(d, carry=carry, slices=k).collect() for carry, k in ((False, 1), (False, 1024), (True, 7))]
    for got in runs:
        assert len(got) == len(rows)
        taken, target, total = defaultdict(int), {}, 0
        for r in got:
            taken[r["source"]] += r["times"] * r["size"]
            target[r["source"]] = r["target"]
            total += r["size"]
        assert all(abs(taken[s] - t) <= 10 for s, t in target.items())
        assert total - 10 <= sum(taken.values()) <= total
    count = [sorted((str((r["source"], r["id"], r["size"], r["times"]))) for r in got) for got in runs]
    assert count[0] == count[1] == count[2]


def test_an_id_with_a_third_of_all_rows(docs, monkeypatch):
    """Different texts under one id (or none) have the running totals of the whole queue, and no task has them all."""
    rows = [(i, " ".join(words(1 + i % 9, i)), "en", f"s{i % 2}") for i in range(400)]
    rows += [(7, " ".join(words(1 + i % 5, 9000 + i)), "en", "s1") for i in range(300)] + [(None, " ".join(words(4, 20_000 + i)), "en", "s0") for i in range(300)]
    d = docs(rows)
    units = (d.select("source", F.col("doc_id").alias("id"), mixing.word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("hash"))
             .groupBy("source", "id", "size", "hash").agg(F.count("*").alias("copies")).withColumn("words", F.col("copies") * F.col("size")))
    largest = []
    real = mixing.running

    def watched(df, group, slice_, order, value, out):
        largest.append(df.groupBy(*group, slice_).count().agg(F.max("count")).first()[0])
        return real(df, group, slice_, order, value, out)

    monkeypatch.setattr(mixing, "running", watched)
    got = mixing._queued(units, 7, 64).collect()
    assert max(largest) <= 30
    by = defaultdict(list)
    for r in got:
        queue = hashlib.md5(f"7:{'null' if r['id'] is None else r['id']}".encode()).hexdigest()
        assert r["queue"] == queue
        by[r["source"]].append((queue, r["hash"], r["size"], r["words"], r["upto"]))
    for queue in by.values():
        total = 0
        for *_, n, upto in sorted(queue):
            total += n
            assert upto == total
    monkeypatch.undo()
    runs = [sorted(map(str, mixing.mix(d, carry=False, slices=k).collect())) for k in (1, 64, None)]
    assert runs[0] == runs[1] == runs[2]


def test_mixed_rows_repeat_and_keep_columns(docs):
    d = table(docs).withColumn("size", F.lit(5)).withColumn("slice", F.lit("x"))
    m = mixing.mixed_rows(d)
    assert m.columns == d.columns
    n = {(r["doc_id"], r["source"]): r["count"] for r in m.groupBy("doc_id", "source").count().collect()}
    assert n[(1000, "tiny")] == 3  # a small source is taken three times
    assert (2000, None) not in n and (2001, None) not in n


def test_empty(docs):
    assert mixing.mix(docs([]), carry=False).count() == 0
    assert mixing.mixed_rows(docs([])).count() == 0
