import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from souk.llm import neardup as N
from souk.llm.components import components
from llm_helpers import words


def edited(w, n, seed):
    r = random.Random(seed)
    w = list(w)
    for k in r.sample(range(len(w)), n):
        w[k] = f"edit{r.randrange(10**9)}"
    return w


def table(docs):
    rows, base = [], words(300, 1)
    for i in range(40):  # a group of near copies, some too far from all others
        rows.append((i, " ".join(edited(base, i % 9, i)), "en", "s"))
    for g in range(30):
        b = words(120 + g, 1000 + g)
        rows += [(100 + 3 * g, " ".join(b), "en", "s"), (101 + 3 * g, " ".join(b).upper(), "en", "s"), (102 + 3 * g, " ".join(edited(b, 1 + g % 4, g)), "en", "s")]
    passage = words(60, 77)
    rows += [(300 + i, " ".join(words(250, 500 + i) + passage), "en", "s") for i in range(40)]
    rows += [(400, None, "en", "s"), (401, "", "en", "s"), (402, "!!!", "en", "s"), (403, "two words", "en", "s"), (404, "Two  words", "en", "s"),
             (405, " ".join(words(30_000, 9)), "en", "s"), (None, "no id here at all but words", "en", "s"), (100, " ".join(words(120, 1000)), "en", "s")]
    return rows


def brute(rows):
    cells = np.zeros(N.SKETCH, np.int64)
    for r in rows:
        h = np.unique(N.shingles(r[1]))
        np.add.at(cells, ((h >> np.uint64(20)) & np.uint64(N.SKETCH - 1)).astype(np.int64), 1)
    weights = N.Weights(cells, len(rows))
    sets = [dict(zip(*(x.tolist() for x in N.elements(r[1], weights)), strict=True)) for r in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = sum(w for k, w in sets[i].items() if k in sets[j])
            union = sum(sets[i].values()) + sum(sets[j].values()) - both
            if both / union >= N.THRESHOLD - 1e-9 if union else (rows[i][1] or "") == (rows[j][1] or ""):
                up[top(i)] = top(j)
    out = {}
    for i, r in enumerate(rows):
        out.setdefault(top(i), []).append((r[0], r[1]))
    return sorted(sorted(map(str, v)) for v in out.values())


@pytest.mark.parametrize("block", [N.BLOCK, 8])
def test_equals_brute_force(docs, block):
    rows = table(docs)
    d = docs(rows)
    got = N.near_duplicates(d, block=block).select("id", "fp", "class_id", "class_size", "kept").collect()
    assert len(got) == len(rows)
    import hashlib
    text = {hashlib.md5((r[1] or "").encode()).digest(): r[1] for r in rows}
    text[hashlib.md5(b"").digest()] = None
    classes = {}
    for r in got:
        classes.setdefault((r["class_id"], min(bytes(x["fp"]) for x in got if x["class_id"] == r["class_id"]) if r["class_id"] is None else b""), []).append((r["id"], r["fp"]))
    mine = sorted(sorted(str((i, text[bytes(f)])) for i, f in v) for v in classes.values())
    want = sorted(sorted(str((eval(x)[0], eval(x)[1] or None)) for x in c) for c in brute(rows))
    assert mine == want
    assert all(len(classes[k]) == next(r["class_size"] for r in got if (r["id"], r["fp"]) == classes[k][0]) for k in classes)


def test_one_of_each_class_stays(docs):
    rows = table(docs)
    d = docs(rows).withColumn("id", F.lit("mine")).withColumn("root", F.lit(0))
    left = N.drop_near_duplicates(d)
    assert left.columns == d.columns
    assert left.count() == len(brute(rows))


def test_sampling_estimates_weighted_jaccard():
    w = N.Weights(np.zeros(N.SKETCH, np.int64), 10)
    s = N.Sampler(w)
    base = words(400, 3)
    est, true = [], []
    for n in (0, 5, 10, 20):
        a, b = " ".join(base), " ".join(edited(base, n, n))
        est.append((s.sample(N.shingles(a)) == s.sample(N.shingles(b))).mean())
        true.append(N.similarities([N.elements(a, w), N.elements(b, w)])[0, 1])
    assert np.abs(np.array(est) - np.array(true)).max() < 0.2 and est[0] == 1


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def test_empty(docs):
    assert N.near_duplicates(docs([])).count() == 0
    assert N.drop_near_duplicates(docs([(1, None, None, None)])).count() == 1
