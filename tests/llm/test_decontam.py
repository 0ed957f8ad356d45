import random

from pyspark.sql import functions as F

from souk.llm import decontam as D
from llm_helpers import words


def slow_align(item, passage):
    """Smith-Waterman cell by cell."""
    h = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    best = 0
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (D.MATCH if a == b else D.MISMATCH), h[i - 1][j] - D.GAP, h[i][j - 1] - D.GAP)
            best = max(best, h[i][j])
    return best / (D.MATCH * len(item))


def test_alignment_is_smith_waterman():
    r = random.Random(4)
    for _ in range(200):
        item = [str(r.randrange(6)) for _ in range(r.randrange(1, 14))]
        passage = [str(r.randrange(6)) for _ in range(r.randrange(1, 25))]
        score, start, end = D.align(item, passage)
        assert score == slow_align(item, passage)
        if score:
            assert slow_align(item, passage[start:end]) == score


def edited(w, seed, every):
    r = random.Random(seed)
    out = []
    for k, x in enumerate(w):
        if k % every == every - 1:
            out += r.choice([[], [x, "extra"], ["other"]])
        else:
            out.append(x)
    return out


def test_equals_brute_force(spark, docs):
    items = [(i, " ".join(words(20 + i, 50 + i))) for i in range(12)] + [(50, "tiny item"), (51, None), (52, "?!"), (None, " ".join(words(30, 99)))]
    text = dict(items)
    rows = []
    for i in range(60):
        w = words(200, i)
        if i % 3 == 0:
            w[50:50] = edited(text[i % 12].split(), i, 6)
        if i % 10 == 7:
            w[0:0] = text[(i * 7) % 12].upper().split()
        rows.append((i, " ".join(w), "en", "s"))
    rows += [(70, "a Tiny  item", "en", "s"), (71, None, None, None), (72, "", "en", "s"), (None, text[None], "en", "s"), (3, rows[3][1], "en", "s"),
             (73, " ".join(words(40_000, 1) + text[5].split()), "en", "s"), (74, text[5][: len(text[5]) // 5], "en", "s")]
    d = docs(rows)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["id"], r["item_id"]): r["score"] for r in D.leaks(d, b).collect()}
    want = {}
    for i, t, *_ in rows:
        for j, x in items:
            if D.words_of(x) and D.words_of(t):
                s = D.align(D.words_of(x), D.words_of(t))[0]
                if s >= D.THRESHOLD:
                    want[(i, j)] = s
    assert got == want
    clean = D.decontaminate(d.withColumn("fp", F.lit(1)).withColumn("id", F.lit("x")), b)
    assert sorted(map(str, (r["doc_id"] for r in clean.collect()))) == sorted(str(r[0]) for r in rows if r[0] not in {k[0] for k in want})
    assert clean.columns == [*d.columns, "fp", "id"]


def test_copies_do_not_hide_a_leak(spark, docs):
    item = words(15, 7)
    leak = ["x" if k in (4, 8, 12) else w for k, w in enumerate(item)]  # one intact run of four words
    rows = [(i, " ".join(words(40, 1) + leak + words(40, 2)), "en", "s") for i in range(30)] + [(100 + i, f"so a tiny item {i}", "en", "s") for i in range(30)]
    b = spark.createDataFrame([(1, " ".join(item)), (2, "a tiny item")], "item_id long, text string")
    got = {(r["id"], r["item_id"]): r["score"] for r in D.leaks(docs(rows), b).collect()}
    assert got == {(i, 1): slow_align(item, leak) for i in range(30)} | {(100 + i, 2): 1.0 for i in range(30)}


def test_recall_with_every_kind_of_edit(spark, docs):
    r = random.Random(11)
    items = [(i, " ".join(words((15, 18, 24, 37, 60)[i % 5], 500 + i))) for i in range(20)] + [(100 + n, " ".join(words(n, 900 + n))) for n in range(1, 9)]
    rows = []
    for i in range(300):
        item = items[i % len(items)][1].split()
        cut = r.randrange(5)
        if cut == 0:  # words 4, 8, 12 ...: no run of four is left
            leak = ["x" if k % 4 == 3 else w for k, w in enumerate(item)]
        elif cut == 1:
            leak = ["x" if r.random() < 0.3 else w for w in item]
        elif cut == 2:  # a strange word after each: no two words stay together
            leak = [y for w in item for y in (w, "x")][:-1]
        elif cut == 3:
            leak = edited(item, i, r.choice([2, 3, 4]))
        else:
            leak = [w for k, w in enumerate(item) if k % 3]
        rows.append((i, " ".join(words(30, 2000 + i) + leak + words(30, 3000 + i)), "en", "s"))
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(x["id"], x["item_id"]): x["score"] for x in D.leaks(docs(rows), b).collect()}
    want = {}
    for i, t, *_ in rows:
        for j, x in items:
            score = D.align(D.words_of(x), D.words_of(t))[0]
            if score >= D.THRESHOLD:
                want[(i, j)] = score
    assert len(want) > 250 and got == want


def test_empty(spark, docs):
    b = spark.createDataFrame([], "item_id long, text string")
    assert D.leaks(docs([(1, "a b c d e", "en", "s")]), b).count() == 0
    assert D.decontaminate(docs([(1, "a b c d e", "en", "s")]), b).count() == 1
    assert D.leaks(docs([]), spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")).count() == 0
