import numpy as np
from pyspark.sql import functions as F

from souk.llm import quality
from llm_helpers import words


def sentence(i, n=60):
    return ". ".join(" ".join(words(9, i * 31 + k)).capitalize() for k in range(n // 9)) + "."


def table(docs):
    rows = []
    for i in range(240):
        t = sentence(i)
        rows.append((i, t if i % 3 else (t.upper().replace(" ", "!! ") if i % 2 else t.replace(" ", "### ")), "en", "s"))
    return docs(rows + [(900, None, "en", "s"), (901, "", "en", "s"), (902, "x " * 200_000, "en", "s"), (None, "no id", None, None), (5, rows[5][1], "en", "s")])


def test_pairs_are_learned(spark, docs):
    d = table(docs)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(240)] + [(None, 1, 0), (3, None, 0), (4, 7, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(d, labels.filter("doc_id is null or doc_id % 5 <> 0"))
    got = {r["id"]: r["score"] for r in quality.score(d, model).select(F.col("row.doc_id").alias("id"), "score").collect()}
    assert len(got) == 244 and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= quality.CUT) == (i % 3 > 0) for i in range(240))
    again = quality.train(d.repartition(5), labels.filter("doc_id is null or doc_id % 5 <> 0"))
    assert np.allclose(again.w, model.w)


def test_repeated_ids_give_one_row_each(spark, docs, monkeypatch):
    """A third of all rows on one id, copies and different texts: the driver gets one row an id."""
    base = table(docs).collect()
    rows = [tuple(r)[:4] for r in base] + [(1, sentence(5000 + i % 40), "en", "s") for i in range(len(base) // 2)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(240)], "doc_id long, quality int")
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y, **k: seen.append((x, y)) or fit(x, y, **k))
    for d in (docs(rows), docs(rows).repartition(5)):
        quality.train(d, labels)
    assert [len(y) for _, y in seen] == [240, 240]
    assert np.array_equal(seen[0][0], seen[1][0])


def test_bradley_terry_orders_by_strength():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 6)).astype(np.float32)
    y = (x @ np.array([2, -1, 0.5, 0, 0, 0]) > 0).astype(int)
    m = quality.fit(x, y, pairs=5000)
    assert ((m.score(x) >= quality.CUT) == (y == 1)).mean() > 0.97


def test_without_labels(spark, docs):
    d = docs([(1, "a", "en", "s")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.train(d, none) is None
    assert quality.score(d, None).first()["score"] == 0.5
    assert quality.keep_good(d.withColumn("score", F.lit("x")).withColumn("row", F.lit(1)), none).first()["row"] == 1
    assert quality.score(docs([]), None).count() == 0


def test_features_of_odd_texts():
    assert not quality.features(None).any() and not quality.features("").any()
    assert np.isfinite(quality.features("\ud800\x00\U0001f600 \n")).all()
