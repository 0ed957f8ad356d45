"""Spelling variants: asymmetric q-chunks join a vocabulary with itself within one edit.

A word's runs of letters are counted over all documents.  Two words are near if
they differ by exactly one inserted, deleted or replaced code point.

The shorter word is cut into two disjoint chunks; one edit leaves one of them
whole.  The other word, of equal length or one longer, offers its grams of the
chunks' lengths at the places where such a chunk can stand: the same place for
equal lengths; for the longer word the same place for the first chunk and one
further for the second (grams at other places could only join with a second
edit).  Words that share a chunk and place meet under its hash and are verified by their edit distance.

A group of more than GROUP words is not paired: what its chunk leaves open is
cut into two chunks again, and the words meet under both chunks, level by level,
until the group is small or a single code point is open.  Such a last group holds at most
one word per letter, or per pair of letters, so no pair is lost and the candidates stay in
proportion to the vocabulary.

A word's form is its near word of largest count, if that is at least RATIO times
its own; following forms to the last gives its root, by pointer doubling.

Defined cases: null texts have no words; a null id stands as the text '' in the
word noise; a word without near words is its own root; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash, table

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
GROUP = 64
NOISE = 199


def runs(docs: DataFrame, least: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, run): the maximal runs of at least ``least`` letters, A-Z in lower case."""
    lower = F.translate(F.col(text_col), string.ascii_uppercase, string.ascii_lowercase)
    found = F.regexp_extract_all(lower, F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))
    return docs.select(F.col(id_col).alias("id"), F.explode(found).alias("run"))


def noisy(run: Column, id_: Column, noise: int = NOISE) -> Column:
    """The run, less one code point where ``noise`` divides the crc32 of id and run."""
    h = F.crc32(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(h, F.length(run)).cast("int")
    return F.when(F.pmod(h, F.lit(noise)) == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, noise: int | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words of at least ``min_length`` code points and ``min_count`` occurrences."""
    words = runs(docs, min_length, id_col, text_col)
    word = noisy(F.col("run"), F.col("id"), noise) if noise else F.col("run")
    return (words.select(word.alias("word")).filter(F.length("word") >= min_length)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count))


def _halved(rows: DataFrame) -> DataFrame:
    """Every row twice: the open span [lo, hi) is cut in two, and one of the chunks joins what must be equal."""
    mid = F.expr("lo + (hi - lo) div 2")
    halves = F.explode(F.array(F.struct(F.col("lo").alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi").alias("hi"))))
    out = rows.select("word", "longer", halves.alias("s")).select("word", "longer", "s.lo", "s.hi")
    size = F.length("word") - F.col("longer")
    before = F.substring(F.col("word"), F.lit(1), F.col("lo"))
    behind = F.substring(F.col("word"), F.col("hi") + F.col("longer") + 1, F.length("word"))
    return out.withColumn("key", F.xxhash64(size, "lo", "hi", before, behind))


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """words(word), distinct and of two code points at least -> (a, b), every pair that one edit separates, once;
    ``a`` is the shorter word, or the first of two equally long ones."""
    size = F.length("word")
    whole = words.select("word", F.lit(0).alias("longer"), F.lit(0).alias("lo"), size.alias("hi"))
    # as the longer word of a pair; the other word has one code point less
    rows = whole.unionAll(words.select("word", F.lit(1).alias("longer"), F.lit(0).alias("lo"), (size - 1).alias("hi")).filter("hi >= 2"))
    found = None
    while True:
        rows = stash(_halved(rows), "spelling_grams")
        met = (rows.groupBy("key").agg(F.count("*").alias("n"), F.sum(1 - F.col("longer")).alias("short"))
               .filter("n > 1 AND short > 0").select(F.col("key").alias("_k"), (F.col("n") > group).alias("large")))
        met = stash(rows.join(met, rows["key"] == F.col("_k")).drop("_k"), "spelling_met")
        last = ~F.col("large") | (F.col("hi") - F.col("lo") < 2)
        a = met.filter(last & (F.col("longer") == 0)).select("key", F.col("word").alias("a"))
        b = met.filter(last).select("key", F.col("word").alias("b"), "longer")
        pairs = a.join(b, "key").filter("longer = 1 OR a < b").filter(F.levenshtein("a", "b", 1) == 1).select("a", "b")
        pairs = stash(pairs, "spelling_pairs")
        found = pairs if found is None else found.unionAll(pairs)
        rows = met.filter(~last).select("word", "longer", "lo", "hi")
        if rows.isEmpty():
            return found.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """forms(word, form) without circles -> (word, root), by pointer doubling."""
    now = stash(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        step = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        new = now.join(step, now["root"] == step["_w"], "left")
        new = stash(new.select("word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")), "spelling_roots")
        now = new.select("word", "root")
        if new.filter("moved").isEmpty():
            return now


def variants(words: DataFrame, ratio: int = RATIO, group: int = GROUP) -> DataFrame:
    """words(word, n) -> word, form, root, n, n_near, form_n."""
    pairs = near_pairs(words.select("word"), group)
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = words.select(F.col("word").alias("b"), F.col("n").alias("m"))
    # largest count first, then the first word in code-point order
    best = (both.join(counts, "b").groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "b")).alias("best")))
    near = words.join(best, words["word"] == best["a"], "left")
    taken = -F.col("best.m") >= ratio * F.col("n")
    near = stash(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                             F.when(taken, F.col("best.b")).alias("form"), F.when(taken, -F.col("best.m")).alias("form_n")), "spelling_near")
    last = roots(near.filter("form is not null")).withColumnRenamed("word", "_w")
    return (near.join(last, near["word"] == last["_w"], "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op12(spark, sf_dir: str) -> DataFrame:
    """Spelling variants of the words of all documents, with the contract's noise."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants(stash(vocabulary(docs, noise=NOISE), "spelling_words"))


SQL = rf"""
WITH RECURSIVE byte AS (SELECT range AS b FROM range(256)),
crc0 AS (SELECT b, b AS c, 0 AS k FROM byte),
bits(b, c, k) AS (
  SELECT b, c::BIGINT, 0 FROM crc0
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
t0 AS MATERIALIZED (SELECT b, c FROM bits WHERE k = 8),
run AS MATERIALIZED (
  SELECT doc_id, r, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[{LETTERS}]+')) AS r FROM documents)
  WHERE length(r) >= {MIN_LENGTH} GROUP BY ALL),
msg AS MATERIALIZED (SELECT doc_id, r, n, encode(coalesce(doc_id::VARCHAR, '') || ':' || r) AS m FROM run),
longest AS (SELECT max(octet_length(m)) AS z FROM msg),
tab(b, c, k) AS (
  SELECT b, c, 0 FROM t0
  UNION ALL
  SELECT tab.b, xor(tab.c >> 8, t0.c), tab.k + 1 FROM tab JOIN t0 ON t0.b = tab.c & 255, longest WHERE tab.k + 1 < z),
init(c, k) AS (
  SELECT 4294967295::BIGINT, 0
  UNION ALL
  SELECT xor(init.c >> 8, t0.c), init.k + 1 FROM init JOIN t0 ON t0.b = init.c & 255, longest WHERE init.k < z),
hashed AS (
  SELECT doc_id, r, any_value(n) AS n, xor(xor(bit_xor(tab.c), any_value(init.c)), 4294967295) AS h
  FROM (SELECT doc_id, r, n, octet_length(m) AS z, hex(m) AS x, unnest(range(octet_length(m))) AS i FROM msg)
  JOIN tab ON tab.b = ('0x' || substr(x, 2 * i + 1, 2))::BIGINT AND tab.k = z - 1 - i
  JOIN init ON init.k = z GROUP BY doc_id, r),
word AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {NOISE} = 0 THEN substr(r, 1, (h % length(r))::INT) || substr(r, (h % length(r))::INT + 2) ELSE r END AS word, n FROM hashed)
  WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
less AS MATERIALIZED (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS v FROM (SELECT word, unnest(range(length(word))) AS i FROM word)),
pair AS (
  SELECT a.word AS a, b.word AS b FROM less a JOIN less b ON a.v = b.v AND a.i = b.i AND a.word <> b.word
  UNION SELECT word, v FROM less JOIN (SELECT word AS v FROM word) USING (v)
  UNION SELECT v, word FROM less JOIN (SELECT word AS v FROM word) USING (v)),
best AS (
  SELECT a AS word, count(*) AS n_near, arg_min(b, (-n, b)) AS near, max(n) AS near_n FROM pair JOIN word ON word.word = b GROUP BY a),
form AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {RATIO} * n THEN near END AS form,
    CASE WHEN near_n >= {RATIO} * n THEN near_n END AS form_n
  FROM word LEFT JOIN best USING (word)),
walk(word, top) AS (
  SELECT word, word FROM form
  UNION ALL
  SELECT walk.word, form.form FROM walk JOIN form ON form.word = walk.top WHERE form.form IS NOT NULL)
SELECT form.word, form.form, walk.top AS root, form.n, form.n_near, form.form_n
FROM form JOIN walk USING (word) JOIN form f ON f.word = walk.top WHERE f.form IS NULL
"""
