import hashlib
import math

import numpy as np
import pytest

from souk.llm import kmeans


def brute(rows, k=8, rounds=10, dim=64):
    kept = [(i, [math.floor(1024 * float(c)) for c in v]) for i, v in rows
            if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted((r for r in kept if r[0] is not None), key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    cent = [r[1] for r in (order + [r for r in kept if r[0] is None])[:k]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(cent))
    for _ in range(rounds):
        groups = [[] for _ in cent]
        for _, x in kept:
            groups[near(x)[1]].append(x)
        cent = [[sum(z) // len(g) for z in zip(*g)] if g else c for g, c in zip(groups, cent)]
    found = [(i, *near(x)[::-1]) for i, x in kept]
    inertia = [sum(d for _, c, d in found if c == n) for n in range(len(cent))]
    return sorted(((i, c, d, inertia[c], sum(inertia), hashlib.sha256(",".join(map(str, cent[c])).encode()).hexdigest()) for i, c, d in found), key=str)


def run(spark, tmp_path, rows):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "0 as cluster", "'x' as id").write.parquet(f"{tmp_path}/embeddings.parquet")
    df = kmeans.op13(spark, str(tmp_path))
    assert dict(df.dtypes) == {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"}
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_equals_brute_force(spark, tmp_path):
    g = np.random.Generator(np.random.PCG64(1))
    v = g.normal(size=(300, 64)).astype(np.float32).astype(float)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(1000 + i, v[0].tolist()) for i in range(150)]       # a third of all vectors are one
    rows += [(7, v[8].tolist()), (7, v[7].tolist()), (2000, [30000.0] * 64), (2001, [-0.0001] * 64), (2002, [0.0] * 64)]
    rows += [(3000, None), (3001, []), (3002, [1.0] * 63), (3003, [1.0] * 65), (3004, [None] + [1.0] * 63),
             (3005, [float("nan")] + [1.0] * 63), (3006, [float("inf")] + [1.0] * 63), (None, v[9].tolist())]
    assert run(spark, tmp_path, rows) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, tmp_path, n):
    rows = [(i, [float(i % 3)] * 64) for i in range(n)]
    assert run(spark, tmp_path, rows) == brute(rows)


def test_tables_give_exact_distances():
    g = np.random.Generator(np.random.PCG64(2))
    x = g.integers(-(1 << 27), 1 << 27, (500, 7))
    c = g.integers(-(1 << 27), 1 << 27, (5, 7))
    block = kmeans.Block.of(x)
    assert (block.distances(c) == ((x[:, None] - c[None]) ** 2).sum(2)).all()
    best, d = block.nearest(c)
    assert (block.sums(best, 5) == [x[best == k].sum(0) for k in range(5)]).all()


def test_blocks_and_partitions_do_not_matter(spark, monkeypatch):
    g = np.random.Generator(np.random.PCG64(3))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(g.normal(size=(200, 4)))], "vec_id long, embedding array<double>")
    find = lambda d: sorted(map(tuple, kmeans.cluster(d, k=5, rounds=4, dim=4)[0].collect()))
    want = find(df)
    assert find(df.repartition(7)) == want


def test_too_large_components_raise(spark):
    df = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="would not fit 64 bits"):
        kmeans.cluster(df)[0].collect()
