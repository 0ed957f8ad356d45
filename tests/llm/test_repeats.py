import hashlib
import random

from pyspark.sql import functions as F

from souk.llm import repeats
from llm_helpers import words


def brute(rows, window):
    """Per row: words, words removed, kept words; windows by Python tuples."""
    first, split = {}, [(t or "").encode().split() for _, t in rows]
    for (i, _), w in zip(rows, split, strict=True):
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k:k + window])
                first[key] = min(i, first.get(key, i))
    out = []
    for (i, _), w in zip(rows, split, strict=True):
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, **options):
    out = repeats.repeats(df, **options).select("id", "n_words", "n_removed", "kept_sha256")
    return sorted((tuple(r) for r in out.collect()), key=str)


def corpus():
    r = random.Random(3)
    passage, line = words(70, "p"), words(12, "l")
    rows = []
    for i in range(120):
        w = words(r.randrange(0, 160), i)
        if i % 3 == 0:
            k = r.randrange(0, 20)
            w[10:10] = passage[k:k + r.randrange(30, 52)]
        if i % 5 == 0:
            w += line
        rows.append((i, (" " if i % 2 else "\n\t").join(w)))
    rows += [(200 + i, rows[i][1]) for i in range(0, 60, 2)]              # exact copies
    rows += [(300, "same " * 400), (301, "same " * 55), (302, "same " * 49), (303, "ab " * 300)]
    rows += [(304, " ".join(passage)), (305, "é" * 3 + " " + " ".join(passage))]  # a no-break space is part of a word
    rows += [(400, None), (401, ""), (402, " \t\r\n "), (None, rows[3][1]), (None, None), (3, " ".join(passage)), (5, rows[5][1]), (5, rows[5][1])]
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows, 50)
    for window, levels in ((20, 3), (7, 2), (50, 1), (1, 3)):
        assert got(df.repartition(5), window=window, levels=levels) == brute(rows, window)


def test_levels():
    assert repeats.lengths(50) == [13, 25, 50] and repeats.lengths(1) == [1]
    for window in range(1, 200):
        at = repeats.lengths(window)
        assert at[-1] == window and all(b <= 2 * a for a, b in zip(at, at[1:]))


def test_long_text_and_large_group(spark):
    long = words(60_000, "long", 10_000_000)
    rows = [(1, " ".join(long)), (2, " ".join(long[:30_000] + ["x"] + long[30_000:])), (3, "y" * 400_000 + " " + " ".join(long[100:150]))]
    shared = words(60, "hot")
    rows += [(1000 + i, " ".join([f"own{i}", *shared])) for i in range(400)]  # a third and more of all rows share a passage
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows, 50)


def test_spans_and_texts(spark):
    p = words(60, 1)
    rows = [(1, "  ".join(p), "a"), (2, " ".join(["x", *p, "y"]), "b"), (3, " ".join(p), "c"), (4, "two  spaces", "d")]
    df = spark.createDataFrame(rows, "id long, words string, fp string")  # columns named like the operator's own
    out = {r["id"]: r for r in repeats.repeats(df, id_col="id", text_col="words").collect()}
    assert [tuple(s) for s in out[2]["spans"]] == [(1, 61)] and [tuple(s) for s in out[3]["spans"]] == [(0, 60)] and out[1]["spans"] == []
    cut = repeats.without_repeats(df, id_col="id", text_col="words")
    assert cut.columns == df.columns
    assert {r["id"]: (r["words"], r["fp"]) for r in cut.collect()} == {1: (rows[0][1], "a"), 2: ("x y", "b"), 3: ("", "c"), 4: ("two  spaces", "d")}


def test_empty_table_and_text_ids(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert got(df) == []
    p = " ".join(words(80, 2))
    df = spark.createDataFrame([("b", p), ("a", p), ("c", "q " + p)], "doc_id string, text string")
    assert {r["id"]: r["n_removed"] for r in repeats.repeats(df).collect()} == {"a": 0, "b": 80, "c": 80}
    assert dict(repeats.repeats(df).select("id", F.col("n_words")).collect()) == {"a": 80, "b": 80, "c": 81}
