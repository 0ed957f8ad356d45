import random
import re
import zlib
from collections import Counter

from souk.llm import spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_variants(counts, ratio=5):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out, key=str)


def brute_words(rows, noise=199, min_length=6, min_count=5):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % noise == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= min_length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= min_count}


def pairs_of(spark, words, group):
    return sorted(map(tuple, spelling.near_pairs(spark.createDataFrame([(w,) for w in words], "word string"), group).collect()))


def brute_pairs(words):
    return sorted((a, b) for a in words for b in words if one_edit(a, b) and (len(a) < len(b) or len(a) == len(b) and a < b))


def test_pairs_equal_brute_force(spark):
    r = random.Random(1)
    words = {"".join(r.choice("abé") for _ in range(r.randrange(6, 10))) for _ in range(400)}
    want = brute_pairs(words)
    assert len(want) > 150
    for group in (64, 3, 1):  # large groups are cut further and further
        assert pairs_of(spark, words, group) == want


def test_a_hot_chunk(spark):
    """Every word shares one half with a third of the vocabulary or more."""
    r = random.Random(2)
    words = {"prefix" + "".join(r.choice("abcd") for _ in range(6)) for _ in range(300)} | {"x" * k for k in range(6, 60)}
    assert pairs_of(spark, words, 16) == brute_pairs(words)


def test_op12_equals_brute_force(spark, tmp_path):
    r = random.Random(4)
    base = ["".join(r.choice("abcdefghiéß×÷Àö") for _ in range(r.randrange(4, 12))) for _ in range(60)]
    rows = []
    for i in range(300):
        w = [r.choice(base[:1 + int(r.random() ** 3 * 60)]) for _ in range(60)]
        for k in range(0, 60, 4):
            j = r.randrange(len(w[k]) + 1)
            w[k] = r.choice([w[k][:j] + "q" + w[k][j:], w[k][:j] + w[k][j + 1:], w[k].upper(), w[k]])
        rows.append((i, r.choice([" ", ".", "0", "Ā", "\n"]).join(w)))
    rows += [(None, rows[0][1]), (7, rows[7][1]), (7, rows[7][1]), (500, None), (501, ""), (502, "Abcdef " * 30000), (503, "z" * 50000)]
    path = tmp_path / "sf"
    spark.createDataFrame([(*x, "extra") for x in rows], "doc_id long, text string, word string").write.parquet(f"{path}/documents.parquet")
    df = spelling.op12(spark, str(path))
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted((tuple(x) for x in df.collect()), key=str)
    assert got == brute_variants(brute_words(rows))
    assert any(x[1] for x in got)


def test_noise_deletes_code_points(spark):
    rows = [(i, "straßenbahn") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["word"]: r["n"] for r in spelling.vocabulary(df, min_count=1, noise=199).collect()}
    assert got == brute_words(rows, min_count=1) and len(got) > 1


def test_chains_and_ties(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aaaaac": 25, "zzzzzz": 5}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = sorted((tuple(r) for r in spelling.variants(df).collect()), key=str)
    assert got == brute_variants(counts)
    assert {r[0]: r[2] for r in got}["aaaaaa"] == "aaabbb" and {r[0]: r[1] for r in got}["aaaaaa"] == "aaaaab"


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.vocabulary(df)).collect() == []
