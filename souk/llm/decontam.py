"""Benchmark decontamination: seeds that no alignment can do without, then Smith-Waterman alignment.

1. A seed is a pair of words of an item (lower case) that stand next to each
   other or have one word between them.  An alignment that reaches the
   threshold matches M words at an edit cost of 2M - S at most (S: the least
   score that reaches it), so all but M - S/2 of its M - 1 steps from match to
   match cost one edit or none, and such a step is a seed on both sides: S/2 - 1
   (rounded up) places of the item begin a seed that stands in the passage.
   Items too short for one such step have their words as seeds, S/2 of them.
2. An item that needs n of its places still has n - n/2 of them when the n/2
   places of its commonest words are left out.  The items are dealt to classes by
   n.  A filter of fixed size, a bit for each class, holds the seeds of the other
   places and goes to the scan of the documents.  Where that many places of a
   document are in the filter within the longest alignment, the passage around
   them is kept.  All else of the document stays where it is.
3. Distinct passages and items meet by equal seeds.  An item that needs n of its
   k places has one in the passage among any k - n + 1 of them; it is looked for
   by those whose seeds stand in the fewest passages, however many these are.
   No frequency and no count of copies drops a pair.
4. Smith-Waterman on words (match 2, mismatch -1, gap -1), divided by the score
   of the whole item, so 1 is a full copy; THRESHOLD and more is a leak.

Defined cases: null and empty texts and items match nothing; items without
words are never found; items or documents with equal text are all reported;
null ids are ids like any other; empty tables give no rows.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, ship, sliced, stash, table
from .neardup import MIX, PRIME, fingerprint, mixed, split_by_members

#: words of a seed
SEED = 2
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, -1, 1
FILTER_BITS = 23
#: classes of items: 0 for words as seeds, else 1 + log2 of the places needed; a bit each
CLASSES = 8


WORD = re.compile(r"\w+")


class _WordHashes(dict):
    """64-bit hash of a word; forgets all when it holds 20,000 words (more would leave the processor's cache)."""

    def __missing__(self, word):
        if len(self) > 20_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hashes = _WordHashes()


def seeds_of(words: list[str], single: bool) -> np.ndarray:
    """A row for each place: the hashes of the seeds that begin there (0: none); single words or pairs."""
    w = np.array([_hashes[x] for x in words], np.uint64)
    if single:
        return mixed(w ^ MIX)[:, None]
    out = np.zeros((max(0, len(w) - 1), 2), np.uint64)
    for k in (1, 2):
        out[:len(w) - k, k - 1] = mixed((w[:len(w) - k] * PRIME + w[k:]) ^ MIX)
    return out


def demand(length: int, threshold: float) -> tuple[int, int, bool, int]:
    """Class, places needed, whether words are seeds, and the most words an alignment spans, of an item of that many words."""
    score = next((s for s in range(1, 2 * length + 1) if s / (MATCH * length) >= threshold), MATCH * length)
    need, single = -(-score // 2) - 1, False
    if need < 1:
        need, single = -(-score // 2), True
    return 0 if single else min(CLASSES - 1, need.bit_length()), need, single, 3 * length - score


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def probes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


def _item_words(batches):
    for b in sliced(batches):
        w = [" ".join(words_of(t)) for t in b.column("text").to_pylist()]
        yield pa.record_batch([b.column("item_id"), pa.array(w, pa.string())], names=["item_id", "item"]).filter(pa.array([x != "" for x in w], pa.bool_()))


def _item_seeds(threshold: float):
    """Of the places of an item those of its rarest words, half of what it needs left out, and how many of them are needed then."""
    def run(batches):
        for b in sliced(batches):
            rows = []
            for item, text, counts in zip(b.column("item_id").to_pylist(), b.column("item").to_pylist(), b.column("counts").to_pylist(), strict=True):
                w = text.split(" ")
                group, need, single, span = demand(len(w), threshold)
                places = seeds_of(w, single).view(np.int64)
                n = np.array(counts, float)
                cost = n if single else n[:-1] * n[1:]
                if not single:
                    cost[:-1] += n[:-2] * n[2:]
                out = need // 2
                places = places[np.argsort(cost, kind="stable")[:len(places) - out]]
                rows.append((item, text, group, need - out, span, len(places), [[int(x) for x in p if x] for p in places]))
            yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(
                (b.schema.field("item_id").type, pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.list_(pa.int64()))))],
                names=["item_id", "item", "class", "need", "span", "places", "seeds"])
    return run


def _dense(at: np.ndarray, need: int, span: int) -> np.ndarray:
    """Those of the ascending places that stand with need - 1 others within span words."""
    if len(at) < need:
        return at[:0]
    first = np.flatnonzero(at[need - 1:] - at[:len(at) - need + 1] < span)
    cover = np.zeros(len(at) + 1, np.int64)
    np.add.at(cover, first, 1)
    np.add.at(cover, first + need, -1)
    return at[np.cumsum(cover[:-1]) > 0]


def _passages(bits: np.ndarray, classes: list[tuple[int, int, int]]):
    """bits: a byte for each place of the filter, a bit for each class; classes: (class, least need, longest span)."""
    def find(batches):
        for b in sliced(batches):
            out = []
            for d, fp, text in zip(b.column("id"), b.column("fp").to_pylist(), b.column("text").to_pylist(), strict=True):
                w = words_of(text)
                if not w:
                    continue
                inside = {}
                for single in {c == 0 for c, _, _ in classes}:
                    h = seeds_of(w, single)
                    one, two = probes(h)
                    inside[single] = h, np.where(h != 0, bits[one] & bits[two], 0).astype(np.uint8)
                for c, need, span in classes:
                    h, found = inside[c == 0]
                    found = (found >> c) & 1
                    at = _dense(np.flatnonzero(found.any(axis=1)), need, span)
                    if not len(at):
                        continue
                    for a in np.split(at, np.flatnonzero(np.diff(at) > span) + 1):
                        lo, hi = max(0, int(a[0]) - span), min(len(w), int(a[-1]) + span)
                        s = np.unique(h[a][found[a] > 0])
                        out.append((d, fp, c, lo, " ".join(w[lo:hi]), s.view(np.int64)))
            yield pa.record_batch([
                pa.array([x[0].as_py() for x in out], b.schema.field("id").type), pa.array([x[1] for x in out], pa.binary()),
                pa.array([x[2] for x in out], pa.int32()), pa.array([x[3] for x in out], pa.int64()), pa.array([x[4] for x in out], pa.string()),
                pa.array([x[5] for x in out], pa.list_(pa.int64()))], names=["id", "fp", "class", "start", "passage", "seeds"])
    return find


def align(item: list[str], passage: list[str]) -> tuple[float, int, int]:
    """Smith-Waterman: share of the item's full score, and the aligned words [from, to) of the passage."""
    ids = {w: k for k, w in enumerate(dict.fromkeys(item))}
    q = np.array([ids[w] for w in item])
    p = np.array([ids.get(w, -1) for w in passage])
    ramp = GAP * np.arange(len(p) + 1)
    score, start = np.zeros(len(p) + 1, np.int64), np.arange(len(p) + 1)
    best = (0, 0, 0)
    here = np.arange(len(p) + 1)
    for w in q:
        step = np.where(p == w, MATCH, MISMATCH)
        diag = np.concatenate([[0], score[:-1] + step])
        up = score - GAP
        now = np.maximum(np.maximum(diag, up), 0)
        begin = np.where(now == 0, here, np.where(diag >= up, np.concatenate([[0], start[:-1]]), start))
        # gaps along the passage: the best cell to the left, less a gap for every step
        reach = now + ramp
        top = np.maximum.accumulate(reach)
        source = np.maximum.accumulate(np.where(reach == top, here, 0))
        score, start = top - ramp, begin[source]
        k = int(score.argmax())
        if score[k] > best[0]:
            best = (int(score[k]), int(start[k]), k)
    return best[0] / (MATCH * len(item)), best[1], best[2]


@lru_cache(256)
def _item_of(text: str, threshold: float):
    w = text.split(" ")
    _, need, single, _ = demand(len(w), threshold)
    return w, need - need // 2, seeds_of(w, single).view(np.int64)


def _aligned(threshold: float):
    def run(batches):
        for b in sliced(batches):
            found = []
            for i, p, s in zip(b.column("item").to_pylist(), b.column("passage").to_pylist(), b.column("seeds").to_pylist(), strict=True):
                item, need, places = _item_of(i, threshold)
                # too few places in common: no alignment reaches the threshold
                hit = np.isin(places, s).any(axis=1).sum() >= need
                found.append(align(item, p.split(" ")) if hit else (-1.0, 0, 0))
            keep = pa.array([s >= threshold for s, _, _ in found], pa.bool_())
            out = pa.record_batch([
                b.column("ph"), b.column("item_id"), pa.array([s for s, _, _ in found], pa.float64()),
                pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64())],
                names=["ph", "item_id", "score", "from", "to"])
            yield out.filter(keep)
    return run


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, fp, item_id, score, first_word, end_word): the best alignment of each document and item that reaches the threshold."""
    ship(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("fp", fingerprint(F.col("text")))
    items = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).distinct()
    kind = items.schema["item_id"].dataType.simpleString()
    parts = stash(items.mapInArrow(_item_words, f"item_id {kind}, item string").distinct(), "decontam_words")
    word = parts.select("item_id", "item", F.posexplode(F.split("item", " ")).alias("at", "word"))
    counts = (word.join(word.groupBy("word").agg(F.count("*").alias("n")), "word").groupBy("item_id", "item")
              .agg(F.sort_array(F.collect_list(F.struct("at", "n"))).alias("c")).select("item_id", "item", F.col("c.n").alias("counts")))
    seeds = stash(counts.mapInArrow(_item_seeds(threshold), f"item_id {kind}, item string, class int, need int, span int, places int, seeds array<array<bigint>>"), "decontam_items")
    classes = sorted(tuple(r) for r in seeds.groupBy("class").agg(F.min("need"), F.max("span")).collect())  # CLASSES rows
    by_place = seeds.select("item_id", "item", "class", "need", "places", F.posexplode("seeds").alias("place", "pair"))
    by_seed = by_place.select("item_id", "item", "class", "need", "places", "place", F.explode("pair").alias("seed"))
    # the filter: 2 ** FILTER_BITS bytes as 64-bit words
    mask = (1 << FILTER_BITS) - 1
    at = F.explode(F.array(F.col("seed").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("seed", 32).bitwiseAND(F.lit(mask))))
    set_words = (by_seed.select("class", at.alias("at")).groupBy(F.shiftright("at", 3).alias("word_at"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast((at & 7) * 8 + class as int))")).alias("word")).toArrow())
    filled = np.zeros(1 << (FILTER_BITS - 3), np.int64)
    filled[set_words.column("word_at").to_numpy()] = set_words.column("word").to_numpy()
    bits = filled.view(np.uint8)

    kind_d = base.schema["id"].dataType.simpleString()
    found = stash(base.select("id", "fp", "text").mapInArrow(
        _passages(bits, classes), f"id {kind_d}, fp binary, class int, start bigint, passage string, seeds array<bigint>")
        .withColumn("ph", F.unhex(F.md5(F.concat_ws(" ", "class", "passage").cast("binary")))), "decontam_passages")
    # copies repeat a passage: each distinct one is aligned once with an item
    distinct = stash(found.groupBy("ph").agg(F.first("class").alias("class"), F.first("passage").alias("passage"), F.first("seeds").alias("seeds")), "decontam_distinct")
    hits = distinct.select("ph", "class", F.explode("seeds").alias("seed"))
    often = hits.groupBy("class", "seed").agg(F.count("*").alias("n"))
    # the places of an item that are looked for: all but need - 1, those with the fewest passages
    often = by_seed.join(often, ["class", "seed"], "left").groupBy("item_id", "item", "class", "need", "places", "place").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("item", "item_id").orderBy(F.col("n").asc_nulls_first(), "place"))
    sought = often.withColumn("rank", rank).filter("rank <= places - need + 1 and n is not null").select("item_id", "item", "place")
    sought = (by_seed.select("item_id", "item", "class", "place", "seed")
              .join(sought.withColumnsRenamed({"item_id": "_i", "item": "_t", "place": "_p"}),
                    F.col("item_id").eqNullSafe(F.col("_i")) & (F.col("item") == F.col("_t")) & (F.col("place") == F.col("_p")))
              .select("class", "seed", "item_id", "item").distinct())
    todo = hits.join(sought, ["class", "seed"]).select("ph", "item_id", "item").distinct()
    todo = todo.join(distinct.select("ph", "passage", "seeds"), "ph")
    scored = stash(todo.mapInArrow(_aligned(threshold), f"ph binary, item_id {kind}, score double, from bigint, to bigint"), "decontam_scored")
    scored = (found.select("id", "fp", "start", "ph").join(scored, "ph")
              .select("id", "fp", "item_id", "score", (F.col("start") + F.col("from")).alias("first_word"), (F.col("start") + F.col("to")).alias("end_word")))
    best = F.max(F.struct("score", (-F.col("first_word")).alias("o"), "end_word")).alias("b")
    return (scored.groupBy("id", "fp", "item_id").agg(best)
            .select("id", "fp", "item_id", F.col("b.score").alias("score"), (-F.col("b.o")).alias("first_word"), F.col("b.end_word").alias("end_word")))


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """The rows of docs that hold no item.

    Rows whose text surely holds none stay where they are; the others meet the
    list of what goes.
    """
    bad = stash(leaks(docs, items, threshold, id_col, text_col, **options).select(F.col("id").alias("_i"), F.col("fp").alias("_f")).distinct(), "decontam_bad")
    rows = docs.select(packed(docs, "row"), F.col(id_col).alias("id"), fingerprint(F.col(text_col)).alias("fp"))
    close, alone = split_by_members(rows, bad.select(F.col("_f").alias("fp")).distinct())
    close = close.join(bad, (close["fp"] == bad["_f"]) & close["id"].eqNullSafe(bad["_i"]), "left_anti")
    return alone.unionAll(close).select("row.*")


def op4(spark, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, whole or edited, with its alignment score."""
    found = leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "score", "first_word", "end_word")
