"""Every registered query on the smallest tables: its contract, and the pipeline against brute force."""

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_mixing import brute_targets
from test_neardup import brute as brute_classes

import __spark_entry__ as E
import corpus_pipeline
from souk.llm import decontam, quality
from souk.llm.queries import ORACLE, QUERIES

SHAPES = {
    "op2_html_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op3_nearest_neighbours": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op5_quality_classifier": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op6_sharding": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op8_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op10_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op11_repeats": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
}
KINDS = {
    "op12_spelling": {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"},
    "op13_centroids": {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"},
}


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(SHAPES))
def test_contract(spark, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    kinds = dict(df.dtypes)
    assert {c: kinds.get(c) for c in SHAPES[name]} == SHAPES[name]
    table = {"op2": "pages", "op3": "embeddings"}.get(name[:3], "documents")
    source = spark.read.parquet(f"{sf_small}/{table}.parquet")
    rows = df.collect()
    if name == "op3_nearest_neighbours":
        n = source.count()
        assert Counter(r["query_id"] for r in rows) == {q: min(20, n - 1) for q in range(0, n, 20)}
        return
    ids = "page_id" if table == "pages" else "doc_id"
    assert sorted(r[ids] for r in rows) == sorted(r[0] for r in source.select(ids).collect())
    if "held_out" in kinds:
        n, k = (5, 0) if name[:3] == "op5" else (3, 1)
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % n == k) for r in rows)


@pytest.mark.parametrize("name", sorted(KINDS))
def test_columns(spark, sf_small, name):
    assert dict(QUERIES[name](spark, sf_small).dtypes) == KINDS[name]


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op5_quality_classifier"](spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in rows]) > 0.95


def test_held_out_language(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in QUERIES["op8_language_id"](spark, sf).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in rows]) > 0.97


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_its_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    df = QUERIES[name](spark, sf_small)
    got = sorted(map(str, (tuple(r) for r in df.collect())))
    assert got == sorted(map(str, con.sql(f"SELECT {', '.join(df.columns)} FROM ({ORACLE[name]})").fetchall()))


def test_pipeline_against_brute_force(spark, sf_small):
    read = lambda t: spark.read.parquet(f"{sf_small}/{t}.parquet")
    docs, stages = read("documents"), dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    out = {}
    for name in stages:
        docs = stages[name](spark, docs, sf_small).cache()
        out[name] = docs
    rows = {k: [r.asDict() for r in v.collect()] for k, v in out.items()}
    columns = read("documents").columns
    assert all(out[k].columns == columns for k in list(stages)[:-1])
    every = [r.asDict() for r in read("documents").collect()]

    labels = read("labels")
    model = quality.train(read("documents"), labels.filter(F.expr("pmod(crc32(cast(cast(doc_id as string) as binary)), 5) <> 0")))
    good = [r for r in every if model.score(quality.features(r["text"])[None])[0] >= quality.CUT]
    ids = lambda rs: sorted(r["doc_id"] for r in rs)
    assert ids(rows["quality"]) == ids(good) and len(good) < len(every)

    classes = brute_classes([(r["doc_id"], r["text"], None, None) for r in good])
    first = sorted(min(eval(x)[0] for x in c) for c in classes)
    assert ids(rows["near_duplicates"]) == first

    items = [decontam.words_of(r["text"]) for r in read("benchmark").collect()]
    seeds = [set(map(tuple, zip(*(w[k:] for k in range(decontam.SEED))))) for w in items]
    clean = []
    for r in rows["near_duplicates"]:
        w = decontam.words_of(r["text"])
        runs = set(map(tuple, zip(*(w[k:] for k in range(decontam.SEED)))))
        if not any(s & runs and decontam.align(i, w)[0] >= decontam.THRESHOLD for i, s in zip(items, seeds, strict=True)):
            clean.append(r["doc_id"])
    assert ids(rows["decontamination"]) == sorted(clean)

    size = lambda r: len(r["text"].split())
    sizes, taken, longest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in rows["decontamination"]:
        sizes[r["source"]] += size(r)
        longest[r["source"]] = max(longest[r["source"]], size(r))
    for r in rows["mixing"]:
        taken[r["source"]] += size(r)
    for s, t in brute_targets(sizes).items():
        assert abs(taken[s] - t) <= 2 * longest[s] + 1
    assert max(Counter(ids(rows["mixing"])).values()) <= 3

    last = rows["sharding"]
    assert ids(last) == ids(rows["mixing"])
    n = Counter(r["shard"] for r in last)
    assert max(n.values()) - min(n.get(k, 0) for k in range(16)) <= 1
    again = corpus_pipeline.run(spark, sf_small)
    assert sorted(map(str, again.collect())) == sorted(map(str, out["sharding"].collect()))
