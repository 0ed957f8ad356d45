"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles.

1. Shingles are runs of five words (lower case).  Their document frequencies,
   over all documents, go into a count-mean sketch of fixed width; a shingle
   weighs tf * idf, where idf falls from 1 for a rare shingle to 1 - IDF_RANGE
   for one that stands in every document.  The range is narrow on purpose: the
   copies of a large group raise the frequency of what they share, and a steep
   idf would push true copies below the threshold.
2. Improved consistent weighted sampling (Ioffe) draws SAMPLES samples a text;
   two texts agree in a sample with the probability of their weighted Jaccard
   similarity.  ROWS samples make a band; texts that agree in a whole band meet
   in a bucket.
3. Within a bucket, texts whose samples agree in LOOSE of all cases or more are
   linked; the components of these links are candidate groups.  Buckets and
   groups larger than BLOCK texts (verified: or BLOCK_BYTES) are compared block
   by block, so that no task holds more than two blocks; what leaves a task is a spanning forest, not all
   pairs.
4. Within a candidate group, the exact weighted Jaccard similarity of every pair
   decides (0.8 or more); the components of those links are the classes.

Equal texts are one node from the start.  Defined cases: a null text counts as
empty; texts without words are in a class with equal texts only; a text of
fewer than five words is one shingle; null ids and repeated rows are rows like
any other, and one row of a class is kept: the smallest id, nulls first; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewords import hash_spans, run_hashes, spans
from .common import packed, ship, sliced, stash, table
from .components import components

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 18, 6
SAMPLES = BANDS * ROWS
LOOSE = 0.64  # four standard deviations of 108 draws below 0.8
BLOCK = 512  # texts of a block ...
BLOCK_BYTES = 4 << 20  # ... and the bytes of their texts, on the average
PIECE = 1 << 18  # code points whose words are found at a time
SKETCH = 1 << 17
IDF_RANGE = 0.2
FILTER_BITS = 26
DRAWS = 1 << 13  # rows of random variates; a shingle's row is chosen by its hash

PRIME = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xFF51AFD7ED558CCD)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * MIX
    h = (h ^ (h >> np.uint64(29))) * PRIME
    return h ^ (h >> np.uint64(32))


_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point whether it is part of a word: letters, digits, underscore."""
    if not _letters:
        table = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
        table[ord("_")] = True
        _letters.append(table)
    return _letters[0]


def _shingled(texts: list[str], size: int):
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts])
    starts, stops = spans(letters()[points], np.zeros(0, np.int64))  # the line break ends a text's last word
    words = hash_spans(points, starts, stops)
    runs = run_hashes(words, size)
    bounds = np.searchsorted(starts, np.concatenate([[0], ends]))
    for lo, hi in zip(bounds, bounds[1:]):
        yield runs[lo:hi - size + 1] if hi - lo >= size else run_hashes(words[lo:hi], hi - lo) if hi > lo else words[:0]


def all_shingles(texts, size: int = SHINGLE):
    """For each text the hashes of its runs of ``size`` words, with repeats; one hash if there are fewer words."""
    held, n = [], 0
    for t in texts:
        held.append(t.lower() if t else "")
        n += len(held[-1])
        if n > PIECE:
            yield from _shingled(held, size)
            held, n = [], 0
    if held:
        yield from _shingled(held, size)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    return next(all_shingles([text], size))


class Weights:
    """idf of a shingle, from the sketch of document frequencies."""

    def __init__(self, counts: np.ndarray, documents: int, idf_range: float = IDF_RANGE):
        # the mean of the other cells is what strangers add to a cell
        stray = (counts.sum() - counts) / max(1, len(counts) - 1)
        df = np.clip(counts - stray, 1, max(1, documents))
        idf = np.log((documents + 1) / (df + 1)) / np.log(documents + 1) if documents > 1 else np.ones(len(counts))
        self.cell = (1 - idf_range + idf_range * np.clip(idf, 0, 1)).astype(np.float32)

    def of(self, h: np.ndarray) -> np.ndarray:
        return self.cell[(h >> np.uint64(20)) & np.uint64(len(self.cell) - 1)]


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Sketch of the document frequencies over all rows of texts(text), and their number.

    A task sends SKETCH counts, whatever it has read; the driver gets SKETCH sums.
    """
    def count(batches):
        cells, n, held, size = np.zeros(SKETCH + 1, np.int64), 0, [], 0
        for b in sliced(batches):
            for h in all_shingles(b.column(0).to_pylist()):
                h = np.unique(h)
                held.append(((h >> np.uint64(20)) & np.uint64(SKETCH - 1)).astype(np.int64))
                size += len(h)
                n += 1
                if size > 1 << 18:
                    cells += np.bincount(np.concatenate(held), minlength=SKETCH + 1)
                    held, size = [], 0
        if held:
            cells += np.bincount(np.concatenate(held), minlength=SKETCH + 1)
        if n:
            cells[SKETCH] = n
            yield pa.record_batch([pa.array([cells], pa.list_(pa.int64()))], names=["cells"])

    ship(texts.sparkSession)
    sums = (texts.mapInArrow(count, "cells array<bigint>").select(F.posexplode("cells").alias("cell", "n"))
            .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
    cells = np.zeros(SKETCH + 1, np.int64)
    cells[sums.column("cell").to_numpy()] = sums.column("n").to_numpy()
    return cells[:SKETCH], int(cells[SKETCH])


class Sampler:
    """Improved consistent weighted sampling with tabulated variates."""

    _tables = None

    def __init__(self, weights: Weights):
        self.weights = weights

    @classmethod
    def tables(cls):
        if cls._tables is None:
            g = np.random.Generator(np.random.PCG64(20))
            shape = (DRAWS, SAMPLES)
            u = lambda: np.maximum(g.random(shape, np.float32), 1e-7)
            r = -np.log(u() * u())
            beta = g.random(shape, np.float32)
            log_c = np.log(-np.log(u() * u()))
            cls._tables = (1 / r, beta, r, log_c - r + r * beta)
        return cls._tables

    def sample(self, h: np.ndarray) -> np.ndarray | None:
        """One 64-bit draw (shingle and level) for each sample; None without shingles."""
        if not len(h):
            return None
        inv, beta, r, base = self.tables()
        h, tf = np.unique(h, return_counts=True)
        log_s = np.log(tf * self.weights.of(h)).astype(np.float32)
        row = (h & np.uint64(DRAWS - 1)).astype(np.int64)
        columns = np.arange(SAMPLES)
        low, key = None, None
        for at in range(0, len(h), 256):  # keeps the working memory in cache, and bounded for long texts
            i = row[at:at + 256]
            level = inv[i]
            level *= log_s[at:at + 256, None]
            level += beta[i]
            np.floor(level, out=level)
            a = r[i]
            a *= level
            np.subtract(base[i], a, out=a)
            first = a.argmin(0)
            best = a[first, columns]
            k = h[at:at + 256][first] + PRIME * level[first, columns].astype(np.int64).astype(np.uint64)
            if low is None:
                low, key = best, k
            else:
                key = np.where(best < low, k, key)
                low = np.minimum(best, low)
        return mixed(key)


def bands_of(draws: np.ndarray) -> np.ndarray:
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    d = draws.reshape(BANDS, ROWS)
    for k in range(ROWS):
        out = mixed(out * PRIME + d[:, k])
    return out.view(np.int64)


def _signer(weights: Weights):
    def sign(batches):
        sampler = Sampler(weights)
        for b in sliced(batches):
            texts = b.column("text").to_pylist()
            draws = [sampler.sample(h) for h in all_shingles(texts)]
            yield pa.record_batch([
                b.column("fp"), pa.array([len(t) if t else 0 for t in texts], pa.int64()),
                pa.array([None if d is None else d.astype(np.uint8).tobytes() for d in draws], pa.binary()),
                pa.array([[] if d is None else bands_of(d) for d in draws], pa.list_(pa.int64()))], names=["fp", "size", "sig", "bands"])
    return sign


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest (member, root) of a symmetric boolean matrix."""
    out, left = [], np.ones(len(near), bool)
    for root in range(len(near)):
        if not left[root]:
            continue
        left[root] = False
        front = [root]
        while front:
            found = np.flatnonzero(near[front].any(0) & left)
            left[found] = False
            out += [(int(x), root) for x in found]
            front = found.tolist()
    return out


EDGES = "a binary, b binary"


def _edge_batch(pairs) -> pa.RecordBatch:
    return pa.record_batch([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())], names=["a", "b"])


def _agreeing(groups):
    """Rows sorted by (key, i, j): the texts of a bucket, linked where their samples agree."""
    def flush(fp, sig):
        s = np.frombuffer(b"".join(sig), np.uint8).reshape(len(sig), -1)
        same = np.zeros((len(s), len(s)), np.uint8)
        for c in s.T:
            same += c[:, None] == c
        est = (same / s.shape[1] - 1 / 256) / (1 - 1 / 256)
        return [(fp[x], fp[y]) for x, y in _forest(est >= LOOSE)]

    held, fp, sig, out = None, [], [], []
    for b in groups:
        for k, i, j, f, s in zip(*(b.column(c).to_pylist() for c in ("key", "i", "j", "fp", "sig")), strict=True):
            if (k, i, j) != held:
                if len(fp) > 1:
                    out += flush(fp, sig)
                held, fp, sig = (k, i, j), [], []
                if len(out) > 10_000:
                    yield _edge_batch(out)
                    out = []
            fp.append(f)
            sig.append(s)
    if len(fp) > 1:
        out += flush(fp, sig)
    yield _edge_batch(out)


def _blocks(df: DataFrame, group: str, blocks: Column) -> DataFrame:
    """Deal each group's rows to pairs (i, j) of its blocks; a group of one block is one pair."""
    n = blocks.cast("int")
    own = F.pmod(F.xxhash64("fp", group), n).cast("int")
    other = F.explode(F.sequence(F.lit(0), n - 1))
    return (df.withColumn("_own", own).withColumn("_other", other)
            .withColumn("i", F.least("_own", "_other")).withColumn("j", F.greatest("_own", "_other")).drop("_own", "_other"))


def elements(text: str, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    return weighted(shingles(text), weights)


def weighted(h: np.ndarray, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Shingles as a weighted set: the n-th copy of a shingle is an element of its own, so min(tf, tf') counts common ones."""
    h, tf = np.unique(h, return_counts=True)
    w = weights.of(h)
    if tf.max(initial=1) > 1:
        copy = np.concatenate([np.arange(k, dtype=np.uint64) for k in tf])
        h, w = np.repeat(h, tf), np.repeat(w, tf)
        h = np.where(copy > 0, mixed(h + PRIME * copy), h)
    return h, w


def similarities(sets: list[tuple[np.ndarray, np.ndarray]], chunk: int = 1024) -> np.ndarray:
    """Weighted Jaccard similarity of all pairs of a block, by products over the shared elements."""
    n = len(sets)
    doc = np.repeat(np.arange(n), [len(h) for h, _ in sets])
    h, w = np.concatenate([h for h, _ in sets]), np.concatenate([w for _, w in sets]).astype(np.float64)
    total = np.bincount(doc, w, n)
    _, col, count = np.unique(h, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    place = np.full(len(count), -1)
    place[shared] = np.arange(len(shared))
    keep = place[col] >= 0
    d, c, w = doc[keep], place[col][keep], np.sqrt(w[keep])
    order = np.argsort(c, kind="stable")
    d, c, w = d[order], c[order], w[order]
    both = np.zeros((n, n))
    for at in range(0, len(shared), chunk):
        lo, hi = np.searchsorted(c, (at, at + chunk))
        m = np.zeros((n, min(chunk, len(shared) - at)))
        m[d[lo:hi], c[lo:hi] - at] = w[lo:hi]
        both += m @ m.T
    union = total[:, None] + total - both
    return both / np.where(union > 0, union, 1)


def _verifier(weights: Weights, threshold: float):
    def verify(t: pa.Table) -> pa.Table:
        fp = t.column("fp").to_pylist()
        pairs = []
        if len(fp) > 1:
            near = similarities([weighted(h, weights) for h in all_shingles(t.column("text").to_pylist())]) >= threshold - 1e-9
            np.fill_diagonal(near, True)
            pairs = [(fp[x], fp[y]) for x, y in _forest(near)]
        return pa.Table.from_batches([_edge_batch(pairs)])
    return verify


def fingerprint(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def member_filter(fps: DataFrame) -> np.ndarray:
    """Bits at two places of every fingerprint: a Bloom filter of eight bits a fingerprint, 2 ** FILTER_BITS at most."""
    n = max(16, 8 * fps.count())
    mask = (1 << min(FILTER_BITS, (n - 1).bit_length())) - 1
    place = lambda at: F.conv(F.substring(F.hex("fp"), at, 8), 16, 10).cast("long").bitwiseAND(F.lit(mask))
    words = (fps.select(F.explode(F.array(place(1), place(9))).alias("bit")).groupBy(F.shiftright("bit", 6).alias("at"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("word")).toArrow())
    out = np.zeros(max(1, (mask + 1) >> 6), np.int64)
    out[words.column("at").to_numpy()] = words.column("word").to_numpy()
    return out.view(np.uint8)


def _members(bits: np.ndarray, inside: bool = True):
    """Keeps the rows whose fingerprint is in the filter, or those that are certainly not in it."""
    mask = len(bits) * 8 - 1

    def run(batches):
        for b in batches:
            fp = np.frombuffer(b"".join(b.column("fp").to_pylist()), np.uint8).reshape(-1, 16).astype(np.int64)
            keep = np.ones(len(fp), bool)
            for at in (0, 4):
                bit = (fp[:, at] << 24 | fp[:, at + 1] << 16 | fp[:, at + 2] << 8 | fp[:, at + 3]) & mask
                keep &= (bits[bit >> 3] >> (bit & 7) & 1).astype(bool)
            yield b.filter(pa.array(keep if inside else ~keep))
    return run


def split_by_members(rows: DataFrame, fps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows(fp, ...) that may be among fps(fp), and those that surely are not: the second need no join."""
    ship(rows.sparkSession)
    bits = member_filter(fps)
    return rows.mapInArrow(_members(bits), rows.schema), rows.mapInArrow(_members(bits, inside=False), rows.schema)


def classes(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
            block: int = BLOCK) -> DataFrame:
    """(fp, root): every distinct text that has a near copy, by fingerprint, with its class."""
    ship(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("fp", fingerprint(F.col("text")))
    weights = Weights(*document_frequencies(base.select("text")))
    signed = base.select("fp", "text").mapInArrow(_signer(weights), "fp binary, size bigint, sig binary, bands array<bigint>")
    nodes = stash(signed.filter("sig is not null").groupBy("fp").agg(F.min(F.struct("sig", "bands", "size")).alias("s"))
                  .select("fp", "s.sig", "s.bands", "s.size"), "neardup_nodes")
    bucket = nodes.select("fp", F.explode("bands").alias("key"))
    full = bucket.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    meeting = stash(bucket.join(full, "key"), "neardup_buckets")
    dealt = _blocks(meeting, "key", F.ceil(F.col("n") / block)).join(nodes.select("fp", "sig"), "fp")
    links = (dealt.select("key", "i", "j", "fp", "sig").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "fp")
             .mapInArrow(_agreeing, EDGES))
    groups = components(links)
    groups = stash(groups.withColumnRenamed("node", "fp").join(nodes.select("fp", "size"), "fp"), "neardup_sized")
    share = F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("size") / BLOCK_BYTES))
    sizes = stash(groups.groupBy("root").agg(share.alias("blocks")), "neardup_sizes")
    named = stash(groups.select("fp", "root").join(sizes, "root"), "neardup_groups")
    # one row with the text of every grouped fingerprint
    one = base.select("fp", "id").join(named.select("fp"), "fp", "left_semi").groupBy("fp").agg(F.min("id").alias("id"))
    one = stash(one.join(named, "fp"), "neardup_members")
    kind = base.schema["id"].dataType.simpleString()
    t = base.select("id", "fp", "text").mapInArrow(_members(member_filter(one.select("fp"))), f"id {kind}, fp binary, text string")
    members = (t.join(one.withColumnsRenamed({"fp": "_f", "id": "_i"}), t["fp"].eqNullSafe(F.col("_f")) & t["id"].eqNullSafe(F.col("_i")))
               .select("fp", "root", "blocks", "text").dropDuplicates(["fp"]))
    verified = (_blocks(members, "root", F.col("blocks")).groupBy("root", "i", "j")
                .applyInArrow(_verifier(weights, threshold), EDGES))
    return components(verified).withColumnRenamed("node", "fp")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text",
                    block: int = BLOCK) -> DataFrame:
    """One row per row of docs: id, fp, class_id (the smallest id of its class, nulls first), class_size, kept.

    Kept marks rows of the class with the smallest id (and then the smallest
    fingerprint); they are one row unless rows repeat with id and text.
    """
    found = classes(docs, threshold, id_col, text_col, block).withColumnRenamed("fp", "_f")
    rows = docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col)).alias("fp"))
    rows = rows.join(found, rows["fp"] == found["_f"], "left").select("id", "fp", F.coalesce("root", "fp").alias("root"))
    rows = stash(rows, "neardup_rows")
    best = rows.groupBy("root").agg(F.min(F.struct("id", "fp")).alias("best"), F.count("*").alias("class_size"))
    # written, so that the join's two sides are plain and a hot class can be split
    best = stash(best.select(F.col("root").alias("_r"), "best", "class_size"), "neardup_best")
    return (rows.join(best, rows["root"] == best["_r"])
            .select("id", "fp", F.col("best.id").alias("class_id"), "class_size",
                    (F.col("id").eqNullSafe(F.col("best.id")) & (F.col("fp") == F.col("best.fp"))).alias("kept")))


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, one of each class.

    Rows whose text is surely in no class of two or more stay where they are;
    only the others meet the list of what goes.
    """
    found = stash(near_duplicates(docs, threshold, id_col, text_col).select("id", "fp", "class_size", "kept"), "neardup_found")
    rows = docs.select(packed(docs, "row"), F.col(id_col).alias("id"), fingerprint(F.col(text_col)).alias("fp"))
    close, alone = split_by_members(rows, found.filter("class_size > 1").select("fp").distinct())
    gone = found.filter("not kept").select(F.col("id").alias("_i"), F.col("fp").alias("_f")).distinct()
    close = close.join(gone, (close["fp"] == gone["_f"]) & close["id"].eqNullSafe(gone["_i"]), "left_anti").dropDuplicates(["id", "fp"])
    return alone.unionAll(close).select("row.*")


def op9(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document (weighted Jaccard of 0.8 or more)."""
    docs = table(spark, sf_dir, "documents")
    return near_duplicates(docs.select("doc_id", "text")).select(F.col("id").alias("doc_id"), "class_id", "class_size", "kept")
