import numpy as np
from pyspark.sql import functions as F

from souk.llm import ann


def table(spark, n=600, dim=24, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:200] = x[0]  # a vector that makes up a third of the table
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(x)]
    odd = [(1000, None, 1), (1020, [0.0] * dim, 1), (1040, [float("nan")] * dim, 1), (1060, [float("inf")] + [1.0] * (dim - 1), 1), (1080, [], 1),
           (1100, [None] + [1.0] * (dim - 1), 1), (None, rows[3][1], 1), (40, rows[40][1], 2), (1120, rows[7][1][:5], 1)]
    return x, spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int")


def exact(x, short, k):
    ids = np.append(np.arange(len(x)), 1120)
    every = np.vstack([x.astype(float), np.append(short, np.zeros(x.shape[1] - len(short)))])
    out = {}
    for q, i in zip(every, ids, strict=True):
        if i % 20 == 0:
            s = (every * q).sum(1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), s[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_all_probes_are_exact_and_blocks_do_not_matter(spark):
    x, t = table(spark)
    want = exact(x, x[7][:5].astype(float), 20)
    got = found(ann.search(t, F.col("vec_id") % 20 == 0, tables=1, probes=4096, block=64))
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-12)


def test_recall(spark):
    x, t = table(spark)
    want = exact(x, x[7][:5].astype(float), 20)
    got = found(ann.search(t, F.col("vec_id") % 20 == 0))
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_share_of_pairs_falls_and_recall_stays():
    rng = np.random.default_rng(2)
    shares = []
    for n in (1024, 32768):
        x = rng.normal(size=(n, 64))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        rot = ann.Rotations(64)
        first, second = rot.own(x)
        met = np.zeros((20, n), bool)
        pairs = 0
        for i, (f, m) in enumerate(zip(*rot.near(x[:20], int(np.ceil(ann.PROBES * min(1, ann.PROBED / n) ** 0.25))), strict=True)):
            for axis, bits in zip(f, m, strict=True):
                t = axis // (2 * rot.dim)
                hit = (first[:, t] == axis) & np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")[second[:, t]].astype(bool)
                met[i] |= hit
                pairs += hit.sum()
        s = x[:20] @ x.T
        s[np.arange(20), np.arange(20)] = -2
        best = np.argsort(-s, axis=1)[:, :20]
        assert np.take_along_axis(met, best, 1).mean() >= 0.9
        shares.append(pairs / 20 / n)
    assert shares[1] < 0.6 * shares[0] < 0.4


def test_queries_that_find_too_few_look_everywhere(spark):
    x, t = table(spark, n=210)
    got = found(ann.search(t.filter("vec_id < 25"), F.col("vec_id") % 20 == 0, tables=1, probes=1))
    assert {q: len(v) for q, v in got.items()} == {0: 20, 20: 20}
    tiny = found(ann.search(t.filter("vec_id in (0, 205, 206)"), F.col("vec_id") % 20 == 0, tables=1, probes=1))
    assert {q: len(v) for q, v in tiny.items()} == {0: 2}


def test_pseudo_rotation_keeps_lengths():
    x = np.random.default_rng(1).normal(size=(5, 20))
    r = ann.Rotations(20)
    y = r.turned(x, 0)
    assert np.allclose(np.linalg.norm(y, axis=1), np.linalg.norm(x, axis=1) * r.dim ** 1.5)


def test_empty(spark):
    t = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.search(t, F.col("vec_id") % 20 == 0).count() == 0


def test_probes_do_not_depend_on_the_number_of_vectors(spark, monkeypatch):
    used = []
    hashed = ann._hashed
    monkeypatch.setattr(ann, "_hashed", lambda rot, probes: used.append(probes) or hashed(rot, probes))
    rng = np.random.default_rng(4)
    for n in (40, 4200):
        x = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(n, 16)))], "vec_id long, embedding array<double>")
        ann.search(x, F.col("vec_id") == 20)
    assert used == [ann.PROBES, ann.PROBES]


def test_rows_handed_on_grow_like_the_queries(spark, monkeypatch):
    """Five times the vectors: about five times the rows that tasks hand on, the same best rows with every block size."""
    made, meet = [], ann._meet

    def counted(*a):
        out = ann.stash(meet(*a), "counted")
        made.append(out.count())
        return out
    monkeypatch.setattr(ann, "_meet", counted)
    rng = np.random.default_rng(6)
    v = rng.normal(size=(7500, 32))
    totals = []
    for n in (1500, 7500):
        made.clear()
        t = spark.createDataFrame([(i, [float(c) for c in x]) for i, x in enumerate(v[:n])], "vec_id long, embedding array<double>")
        got = found(ann.search(t, F.col("vec_id") % 20 == 0, tables=4))
        totals.append(sum(made))
        if n == 1500:
            assert got == found(ann.search(t, F.col("vec_id") % 20 == 0, tables=4, block=5))
    assert totals[1] < 6 * totals[0]


def test_vectors_are_shuffled_once_a_pass_and_queries_once_a_stripe(spark, monkeypatch):
    given, meet = [], ann._meet
    monkeypatch.setattr(ann, "_meet", lambda *a: given.append((a[0].count(), a[1].count())) or meet(*a))
    rng = np.random.default_rng(7)
    t = spark.createDataFrame([(i, [float(c) for c in x]) for i, x in enumerate(rng.normal(size=(900, 16)))], "vec_id long, embedding array<float>")
    few = found(ann.search(t, F.col("vec_id") % 20 == 0, tables=4, probes=60))
    assert given == [(900, 45)]  # one stripe
    given.clear()
    assert found(ann.search(t, F.col("vec_id") % 20 == 0, tables=4, probes=60, block=5)) == few
    stripes = 2 * spark.sparkContext.defaultParallelism
    assert given == [(900, 45), (900, 45 * (stripes - 1))]


def test_cuts_keep_as_many_pairs_as_probes_whatever_is_equal():
    rot = ann.Rotations(16, 3)
    x = np.vstack([np.eye(16)[:3], np.ones((1, 16)), np.random.default_rng(8).normal(size=(3, 16))])
    for n in (1, 7, 100, 32 * 32):
        for _, i, _, _, _ in rot.reached(x, n, *rot.cuts(x, n)):
            assert np.bincount(i, minlength=len(x)).tolist() == [n] * len(x)
