import random

from pyspark.sql import functions as F

from souk.llm import langid

SYLLABLES = {"aa": ["ba", "ko", "mi", "la"], "bb": ["sch", "ung", "er", "tz"], "cc": ["que", "eau", "oi", "ment"]}


def text(lang, seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randrange(1, 5))) for _ in range(n))


def table(docs):
    rows = [(i, text(lang, i, 5 + i % 60), lang, "s") for i, lang in ((i, ("aa", "bb", "cc")[i % 3]) for i in range(600))]
    return docs(rows + [(900, None, "aa", "s"), (901, "", None, "s"), (902, "123 !! ² ①", "bb", "s"), (903, text("cc", 1, 30_000), None, "s"), (None, text("aa", 5, 30), None, "s"),
                        (5, rows[5][1], rows[5][2], "s")])


def test_held_out_accuracy_and_defined_cases(docs):
    d = table(docs)
    model = langid.train(d.filter("doc_id is not null and doc_id % 4 <> 0"))
    out = langid.predict(d.withColumn("score", F.lit("x")), model)
    got = {r["id"]: r for r in out.select(F.col("row.doc_id").alias("id"), F.col("row.lang").alias("lang"), "lang_pred", "score", "accepted").collect()}
    held = [r for i, r in got.items() if i is not None and i < 600 and i % 4 == 0]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())
    for i in (900, 901, 902):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["accepted"]) == ("und", 0.0, False)
    assert got[903]["lang_pred"] == "cc" and got[None]["lang_pred"] == "aa"


def test_word_cache_equals_direct_sum():
    import numpy as np
    g = np.random.default_rng(0)
    m = langid.Model(["x", "y"], g.normal(size=(langid.BUCKETS, 2)), np.zeros(2))
    t = text("aa", 3, 9000)
    p = m.probabilities(m.logits(*langid.bag(langid.words_of(t))))
    assert np.isclose(langid.Reader(m).predict([t])[0][1], p.max())


def test_subwords_of_a_word_do_not_depend_on_its_neighbours():
    words = ["a", "straße", "été", "été", "\U00010400x"]
    bucket, owner = langid.subwords(words)
    for i, w in enumerate(words):
        alone = langid.subwords([w])[0]
        assert sorted(bucket[owner == i]) == sorted(alone)
        assert len(alone) == 1 + sum(max(0, len(w) + 2 - n + 1) for n in (2, 3, 4))


def test_the_sample_is_bounded_in_rows(docs, monkeypatch):
    """A third of all rows share one id, another third is one row repeated: the first are sampled one by one, the others count once."""
    rows = [(i, text(("aa", "bb")[i % 2], i, 20), ("aa", "bb")[i % 2], "s") for i in range(900)]
    rows += [(7000, text("aa", 10_000 + i, 20), "aa", "s") for i in range(900)] + [(8000, text("bb", 77, 20), "bb", "s")] * 900
    seen = []
    fit = langid.fit
    monkeypatch.setattr(langid, "fit", lambda bags, y, *a, **k: seen.append((len(bags), y)) or fit(bags, y, *a, **k))
    model = langid.train(docs(rows), per_lang=100)
    n, y = seen[0]
    per = [int((y == k).sum()) // 2 for k in (0, 1)]  # a text and a short run of it
    assert 60 <= per[0] <= 140 and 15 <= per[1] <= 60 and n == 2 * sum(per)
    out = langid.predict(docs(rows[:200]), model)
    assert out.filter("row.lang = lang_pred").count() >= 196


def test_rejection_holds_its_precision(docs):
    d = table(docs)
    noisy = d.withColumn("lang", F.when(F.col("doc_id") % 7 == 0, "aa").otherwise(F.col("lang")))
    model = langid.train(noisy)
    assert 0 <= model.floor <= 1 and model.heat > 0


def test_without_languages(docs):
    d = docs([(1, "abc", None, "s")])
    assert langid.train(d) is None
    assert langid.predict(d, None).first()["lang_pred"] == "und"
    assert langid.predict(docs([]), None).count() == 0
