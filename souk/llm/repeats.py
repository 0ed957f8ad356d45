"""Repeated passages across documents, found by level-wise doubling.

A window is ``window`` consecutive words.  A word goes if it is covered by a
window whose words also start in a document with a smaller id; windows are
judged on the input.

Level by level the lengths double: 13, 25 and 50 words for windows of 50.  At
each length a window is judged by its anchors, the run of least hash among its
runs of that length; equal windows have equal anchors, so a window whose anchor
stands in one document alone cannot be repeated and is given up.  Only windows
whose anchor is repeated at one length are looked at with twice that length.  At
the last length the window is its own anchor (two 64-bit hashes), and the least
id of the documents it starts in decides.  The levels end early when no window
survives.  What is shuffled at a level are the anchors of survivors: about one
run in twenty at the first length.

Equal texts are one text: all of a copy but the first is removed if it has a
window at all.  Levels read the texts that still hold survivors, and no others.

Defined cases: a null or empty text has no words and keeps none; a text shorter
than a window keeps everything; a null id is neither smaller nor larger than
another, so such rows lose nothing and remove nothing; rows that share an id do
not remove from each other; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import SECOND, Words, run_hashes, slices, sliding_min
from .common import packed, ship, stash, table

WINDOW = 50
LEVELS = 3


def lengths(window: int = WINDOW, levels: int = LEVELS) -> list[int]:
    """Lengths of the levels, each at most twice the one before; the last is the window."""
    return sorted({-(-window // (1 << k)) for k in range(levels)})


def least_runs(words: Words, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor of the window that starts at each word, and whether the window lies in one text."""
    least = sliding_min(run_hashes(words.hashes, length), window - length + 1)
    return least, words.text[:len(least)] == words.text[window - 1:window - 1 + len(least)]


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.ListArray:
    ends = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _distinct(least: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors without the repeats of neighbouring windows of a text."""
    if not len(least):
        return least, owner
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    return least[new], owner[new]


def _digest(raw: bytes) -> str:
    return hashlib.sha256(b" ".join(raw.split())).hexdigest()


def _scan(length: int, window: int):
    """Words, digest of all words and first anchors of every text."""
    def run(batches):
        for b in slices(batches, "text"):
            w = Words(b.column("text"))
            least, inside = least_runs(w, length, window)
            least, owner = _distinct(least[inside], w.text[:len(inside)][inside])
            yield pa.record_batch([
                b.column("id"), b.column("fp"), pa.array(w.count.astype(np.int64)),
                pa.array([_digest(t) for t in b.column("text").to_pylist()], pa.string()),
                _lists(least.view(np.int64), owner, b.num_rows)], names=["id", "fp", "n_words", "sha", "anchors"])
    return run


def _surviving(b: pa.RecordBatch, w: Words, length: int, window: int) -> np.ndarray:
    """Starts of the windows whose anchor of this length is repeated; repeated is a property of the anchor,
    so one list serves all texts of the slice."""
    least, inside = least_runs(w, length, window)
    known = b.column("known").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return np.flatnonzero(inside & np.isin(least, known))


def _extend(length: int, longer: int, window: int):
    """Anchors of twice the length of the windows that survived."""
    def run(batches):
        for b in slices(batches, "text"):
            w = Words(b.column("text"))
            at = _surviving(b, w, length, window)
            least, _ = least_runs(w, longer, window)
            least, owner = _distinct(least[at], w.text[at])
            rows = pa.array(owner)
            yield pa.record_batch([b.column("id").take(rows), b.column("fp").take(rows), pa.array(least.view(np.int64))], names=["id", "fp", "h"])
    return run


def _windows(length: int, window: int):
    """The windows that survived, by two hashes, with their place in the text."""
    def run(batches):
        for b in slices(batches, "text"):
            w = Words(b.column("text"))
            at = _surviving(b, w, length, window) if length < window else np.flatnonzero(least_runs(w, window, window)[1])
            rows = pa.array(w.text[at])
            yield pa.record_batch([
                b.column("id").take(rows), b.column("number").take(rows), pa.array(run_hashes(w.hashes, window)[at].view(np.int64)),
                pa.array(run_hashes(w.hashes, window, SECOND)[at].view(np.int64)), pa.array((at - w.bounds[w.text[at]]).astype(np.int32))],
                names=["id", "number", "h", "g", "at"])
    return run


def _cut(window: int):
    """Removed spans of words, what is left, and its digest."""
    def run(batches):
        for b in slices(batches, "text"):
            w = Words(b.column("text"))
            spans, removed, kept, sha = [], [], [], []
            for i, at in enumerate(b.column("starts").to_pylist()):
                n = w.count[i]
                delta = np.zeros(n + 1, np.int32)
                np.add.at(delta, at, 1)
                np.add.at(delta, np.array(at) + window, -1)
                gone = np.zeros(n + 2, np.int8)
                gone[1:-1] = np.cumsum(delta[:-1]) > 0
                edge = np.diff(gone)
                spans.append([{"start": int(s), "end": int(e)} for s, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)])
                removed.append(int(gone.sum()))
                words = b.column("text")[i].as_py().split()
                left = b" ".join(words[k] for k in np.flatnonzero(gone[1:-1] == 0))
                kept.append(left.decode())
                sha.append(hashlib.sha256(left).hexdigest())
            yield pa.record_batch([
                b.column("id"), b.column("fp"), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(sha, pa.string())],
                names=["id", "fp", "spans", "n_removed", "kept", "sha"])
    return run


def _repeated(anchors: DataFrame) -> DataFrame:
    """Anchors that stand under two ids at least; written, so that both sides of the join with them are plain
    and a frequent anchor can be split."""
    return stash(anchors.groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a < z").select("h"), "repeats_repeated")


def _known(anchors: DataFrame, repeated: DataFrame) -> DataFrame:
    return anchors.join(repeated, "h").groupBy("id", "fp").agg(F.collect_set("h").alias("known"))


def repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", levels: int = LEVELS) -> DataFrame:
    """One row per row of docs: id, n_words, n_removed, spans (word ranges that go), kept (text, or null where nothing
    or everything goes) and kept_sha256 (of the kept words, joined by one space)."""
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    base = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("fp", F.unhex(F.md5("text")))
    kind = base.schema["id"].dataType.simpleString()
    steps = lengths(window, levels)
    rows = stash(base.select("id", "fp", "text").mapInArrow(
        _scan(steps[0], window), f"id {kind}, fp binary, n_words bigint, sha string, anchors array<bigint>"), "repeats_rows")

    # the first row of equal texts speaks for all of them
    able = rows.filter(F.col("id").isNotNull() & (F.col("n_words") >= window))
    first = stash(able.groupBy("fp").agg(F.min("id").alias("first")), "repeats_first")
    anchors = able.select("id", "fp", F.explode("anchors").alias("h"))
    speak = able.join(first, (able["fp"] == first["fp"]) & (able["id"] == first["first"]), "left_semi").select("id", "fp", F.explode("anchors").alias("h"))
    known = stash(_known(speak, _repeated(anchors)), "repeats_known")

    texts = base.join(known.select("fp", F.col("id").alias("_i")), "fp").filter("id = _i").select("id", "fp", "text").dropDuplicates(["id", "fp"])
    texts = stash(texts.withColumn("number", F.xxhash64("fp")), "repeats_texts")

    for length, longer in zip(steps, steps[1:-1]):
        if known.isEmpty():
            break
        held = stash(texts.join(known, ["id", "fp"]).select("id", "fp", "text", "known")
                     .mapInArrow(_extend(length, longer, window), f"id {kind}, fp binary, h bigint"), "repeats_anchors")
        known = stash(_known(held, _repeated(held)), "repeats_known")

    found = stash(texts.join(known, ["id", "fp"]).select("id", "number", "text", "known")
                  .mapInArrow(_windows(steps[-2] if len(steps) > 1 else window, window),
                              f"id {kind}, number bigint, h bigint, g bigint, at int"), "repeats_windows")
    least = stash(found.groupBy("h", "g").agg(F.min("id").alias("a"), F.max("id").alias("z")).filter("a < z").select("h", "g", "a"), "repeats_least")
    starts = found.join(least, ["h", "g"]).filter("a < id").groupBy("id", "number").agg(F.collect_list("at").alias("starts"))
    cut = stash(texts.join(starts, ["id", "number"]).select("id", "fp", "text", "starts")
                .mapInArrow(_cut(window), f"id {kind}, fp binary, spans array<struct<start:int,end:int>>, n_removed bigint, kept string, sha string"),
                "repeats_cut")

    later = rows.drop("anchors").join(first, "fp", "left")
    whole = F.coalesce((F.col("n_words") >= window) & (F.col("first") < F.col("id")), F.lit(False))
    c = cut.select(F.col("id").alias("_i"), F.col("fp").alias("_f"), F.col("spans").alias("_spans"), F.col("n_removed").alias("_n"), "kept", F.col("sha").alias("_sha"))
    out = later.join(c, (later["fp"] == c["_f"]) & (later["id"] == c["_i"]), "left")
    all_words = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    return out.select(
        "id", "fp", "n_words", F.when(whole, F.col("n_words")).otherwise(F.coalesce("_n", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, all_words).otherwise(F.coalesce("_spans", F.expr("cast(array() as array<struct<start:int,end:int>>)"))).alias("spans"),
        F.when(~whole, F.col("kept")).alias("kept"),
        F.when(whole, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("_sha", "sha")).alias("kept_sha256"))


def without_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs; a text that loses words is its kept words joined by one space, others stay as they are."""
    found = repeats(docs, window, id_col, text_col).filter("n_removed > 0").select(
        F.col("id").alias("_i"), F.col("fp").alias("_f"), F.when(F.col("n_removed") == F.col("n_words"), F.lit("")).otherwise(F.col("kept")).alias("_kept")).distinct()
    text = F.coalesce(F.col(f"row.`{text_col}`").cast("binary"), F.lit(b""))
    rows = docs.select(packed(docs, "row")).withColumn("_fp", F.unhex(F.md5(text)))
    out = rows.join(found, (rows["_fp"] == found["_f"]) & (F.col(f"row.`{id_col}`") == F.col("_i")), "left")
    new = [F.coalesce("_kept", f"row.`{c}`").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return out.select(*new)


def op11(spark, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a window of 50 words seen in a document with a smaller id."""
    docs = table(spark, sf_dir, "documents")
    return repeats(docs.select("doc_id", "text")).select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


SQL = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS MATERIALIZED (
  SELECT doc_id, p, md5(array_to_string(list_slice(w, p, p + 49), ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM t WHERE len(w) >= 50)),
least AS (SELECT k, min(doc_id) AS a FROM win GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS place FROM win JOIN least USING (k) WHERE a < doc_id),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM t),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS kept
  FROM word ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)
"""
