"""Approximate nearest neighbours: cross-polytope hashing with multiprobe tables.

A fast pseudo-rotation (three rounds of random signs and a Walsh-Hadamard
transform) turns a unit vector; its hash is the nearest signed axis.  A table's
bucket is the pair of axes of two rotations; every vector is stored under its own
pair in each of ``tables`` independent tables.  A query looks under the ``probes``
pairs of highest summed components of each table, whatever the table's size: which
pairs a query meets does not depend on the other rows.  (A caller who takes less
recall for less work may pass the number of probes that ``fewer_probes`` gives for
its table.)
Candidates are scored by their exact inner product in double precision and the
best ``k`` stay.

Every vector lies in one stripe of the table, with its pairs in all tables, and a
task holds one stripe in memory, its rows found by pair.  The queries stream
through: a task works out a query's pairs again from two numbers a table (the
summed components of its last pair, and that pair's place among equal ones).  So
a vector is shuffled once a pass and not once a table, and a query once a stripe;
a candidate that several tables name is scored once.

Stripes follow the first axis in the first table.  A query first meets the
stripes of its own axis; its k-th best score there is a floor for all others:
what scores less cannot be among its best, so tasks hand on only what reaches
the floor.  Their number does not follow the number of pairs scored.

A stripe is cut by a hash of the id above its size, so a vector that makes up a
third of the table costs more tasks and not a larger one.  Each task returns its
best ``k`` of each query, which loses nothing.  A query that finds fewer than
``k`` looks at every vector, which is exact.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows without an id; vectors of fewer components
count as padded with zeros; rows with equal id count as one (the first in the
order of their components); ties go to the smaller id; an empty table gives no
rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, stash, table

TABLES, PROBES, PROBED, K = 16, 320, 2048, 20
BLOCK = 512
# In blocks: vectors of a stripe, at least (few stripes suffice for a small table) and at most, and queries that a task meets.
LEAST, MOST, ASKED = 16, 256, 2048


def fewer_probes(number: int, probes: int = PROBES) -> int:
    """Probes for ``number`` vectors: fewer by the fourth root of the excess over PROBED, as near ones get nearer."""
    return math.ceil(probes * min(1.0, PROBED / max(number, 1)) ** 0.25)


class Rotations:
    """Two pseudo-rotations a table of vectors of ``dim`` components (padded to a power of two)."""

    def __init__(self, dim: int, tables: int = TABLES, seed: int = 5):
        self.dim, self.tables = 1 << max(2, (dim - 1).bit_length()), tables
        g = np.random.Generator(np.random.PCG64(seed))
        self.signs = g.choice(np.array([-1.0, 1.0]), (2 * tables, 3, self.dim))

    def turned(self, x: np.ndarray, t: int) -> np.ndarray:
        y = np.zeros((len(x), self.dim))
        y[:, :x.shape[1]] = x
        for s in self.signs[t]:
            y *= s
            h = 1
            while h < self.dim:
                v = y.reshape(len(y), -1, 2, h)
                y = np.concatenate([v[:, :, :1] + v[:, :, 1:], v[:, :, :1] - v[:, :, 1:]], 2).reshape(len(y), self.dim)
                h *= 2
        return y

    def both(self, x: np.ndarray, t: int) -> np.ndarray:
        """Components along the signed axes (2 * axis, or 2 * axis + 1 for the negative one)."""
        y = self.turned(x, t)
        return np.stack([y, -y], 2).reshape(len(y), -1)

    def own(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's first axis in each table (numbered through all tables) and its second."""
        axes = np.stack([self.both(x, t).argmax(1) for t in range(2 * self.tables)], 1)
        return axes[:, ::2] + np.arange(self.tables) * 2 * self.dim, axes[:, 1::2]

    def _pairs(self, x: np.ndarray, t: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The m best axes of the two rotations of a table, best first, and the summed components of their m * m pairs."""
        m = min(n, 2 * self.dim)  # a pair among the n best has both its axes among their n best
        one, two = self.both(x, 2 * t), self.both(x, 2 * t + 1)
        a, b = (np.argsort(-y, axis=1, kind="stable")[:, :m] for y in (one, two))
        total = np.take_along_axis(one, a, 1)[:, :, None] + np.take_along_axis(two, b, 1)[:, None, :]
        return a, b, total.reshape(len(x), -1)

    def cuts(self, x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For each vector and table the sum of the n-th best pair and that pair's place: equal sums go by place."""
        sums, places = np.full((len(x), self.tables), -np.inf), np.zeros((len(x), self.tables), np.int32)
        for t in range(self.tables):
            _, _, total = self._pairs(x, t, n)
            if n < total.shape[1]:
                last = -np.partition(-total, n - 1, axis=1)[:, n - 1:n]
                equal = total == last
                among = n - (total > last).sum(1, keepdims=True)  # so many of the equal ones are taken
                sums[:, t], places[:, t] = last[:, 0], (equal.cumsum(1) == among).argmax(1)
        return sums, places

    def reached(self, x: np.ndarray, n: int, sums: np.ndarray, places: np.ndarray):
        """The pairs that ``cuts`` keeps, table by table: the vectors' numbers, the pairs' first axes' ranks, and both axes."""
        for t in range(self.tables):
            a, b, total = self._pairs(x, t, n)
            m = a.shape[1]
            kept = total >= sums[:, t:t + 1]
            for r in np.flatnonzero(kept.sum(1) > n):  # some of the pairs of equal sums are beyond the n-th
                kept[r] &= (total[r] > sums[r, t]) | (np.arange(m * m) <= places[r, t])
            i, at = np.nonzero(kept)
            yield t, i, at // m, a[i, at // m], b[i, at % m]

    def near(self, x: np.ndarray, n: int) -> tuple[list, list]:
        """For each vector the first axes of its n nearest pairs of each table, and for each the set of second axes as bits."""
        wide = 2 * self.dim
        firsts, sets = [[] for _ in x], [[] for _ in x]
        for t, i, rank, a, b in self.reached(x, n, *self.cuts(x, n)):
            bits = np.zeros((len(x), min(n, wide), wide), bool)
            bits[i, rank, b] = True
            axes = np.zeros(bits.shape[:2], np.int64)
            axes[i, rank] = a
            packed = np.packbits(bits, axis=2, bitorder="little")
            for i, j in np.argwhere(bits.any(2)):
                firsts[i].append(int(axes[i, j]) + t * wide)
                sets[i].append(packed[i, j].tobytes())
        return firsts, sets

    def step(self, n: int) -> int:
        """As many queries at a time as keep their pairs small."""
        return max(1, (1 << 21) // min(n, 2 * self.dim) ** 2)


def _unit(x: np.ndarray) -> np.ndarray:
    unit = x / np.abs(x).max(1, keepdims=True)
    return unit / np.linalg.norm(unit, axis=1, keepdims=True)


def _packed(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _unpacked(column: pa.Array, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _hashed(rot: Rotations, probes: int):
    def run(batches):
        for whole in batches:
            for b in (whole.slice(at, 2048) for at in range(0, whole.num_rows, 2048)):
                v = b.column("v")
                x = np.zeros((len(v), rot.dim))
                ends = v.offsets.to_numpy()
                flat = v.values.to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(v)), np.diff(ends))
                x[row, np.arange(ends[0], ends[-1]) - ends[:-1][row]] = flat[ends[0]:ends[-1]]
                unit = _unit(x)
                first, second = rot.own(unit)
                query = np.array(b.column("query").to_pylist(), bool)
                sums, places = [None] * len(v), [None] * len(v)
                at = np.flatnonzero(query)
                step = rot.step(probes)
                for k in range(0, len(at), step):
                    for i, f, m in zip(at[k:k + step], *rot.cuts(unit[at[k:k + step]], probes), strict=True):
                        sums[i], places[i] = f.tobytes(), m.tobytes()
                yield pa.record_batch([
                    b.column("id"), _packed(x.astype("f4" if v.type.value_type == pa.float32() else "f8")), _packed((first % (2 * rot.dim) * 2 * rot.dim + second).astype(_code(rot))),
                    pa.array(first[:, 0], pa.int32()), pa.array(sums, pa.binary()), pa.array(places, pa.binary())],
                    names=["id", "v", "codes", "axis", "sums", "places"])
    return run


def _code(rot: Rotations) -> str:
    return "u2" if rot.dim <= 128 else "u4"


class _Stripe:
    """Vectors found by pair; queries pass and take the best ``k`` of those that lie under their pairs."""

    def __init__(self, k: int, rot: Rotations, probes: int, kind: str):
        self.k, self.rot, self.probes, self.kind = k, rot, probes, kind
        self.lots, self.keys = [], None

    def add(self, rows: pa.RecordBatch):
        self.lots.append((rows.column("id").to_numpy(), _unpacked(rows.column("v"), self.kind), _unpacked(rows.column("codes"), _code(self.rot))))

    def _fill(self):
        ids, x, codes = (np.concatenate(z) for z in zip(*self.lots, strict=True))
        self.lots = []
        order = np.argsort(ids)  # equal scores go by id: vectors are numbered in its order
        self.ids, self.x = ids[order], x[order]
        keys = (codes[order].astype(np.int64) + np.arange(self.rot.tables) * 4 * self.rot.dim ** 2).ravel()
        order = np.argsort(keys, kind="stable")
        self.keys, self.member = keys[order], (order // self.rot.tables).astype(np.int32)
        self.met = np.zeros(len(ids), bool)
        pairs = self.rot.tables * 4 * self.rot.dim ** 2
        self.starts = np.searchsorted(self.keys, np.arange(pairs + 1)) if pairs <= 1 << 22 else None

    def _under(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of the vectors under any of the pairs, ascending."""
        if self.starts is None:
            start, end = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, "right")
        else:
            start, end = self.starts[keys], self.starts[keys + 1]
        n = end - start
        at = np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
        self.met[self.member[at]] = True
        out = np.flatnonzero(self.met)
        self.met[out] = False
        return out

    def _best(self, i, q, floor, found):
        found = found[self.ids[found] != i]
        # the product of a pair must not depend on its place: summed row by row
        exact = np.concatenate([(q * self.x[found[a:a + 16384]].astype(np.float64)).sum(1) for a in range(0, len(found), 16384)] or [np.zeros(0)])
        good = np.flatnonzero(exact >= floor)
        if len(good) > self.k:
            least = -np.partition(-exact[good], self.k - 1)[self.k - 1]
            above, equal = good[exact[good] > least], good[exact[good] == least]
            good = np.concatenate([above, equal[:self.k - len(above)]])
        return self.ids[found[good]], exact[good]

    def ask(self, rows: pa.RecordBatch):
        if self.keys is None:
            if not self.lots:
                return
            self._fill()
        anywhere = np.array([not s for s in rows.column("sums").to_pylist()])
        ids, floors = rows.column("id").to_numpy(), np.array([-np.inf if f is None else f for f in rows.column("floor").to_pylist()])
        x = _unpacked(rows.column("v"), self.kind).astype(np.float64)
        out = []
        for n in np.flatnonzero(anywhere):
            out.append((ids[n], *self._best(ids[n], x[n], floors[n], np.arange(len(self.ids)))))
        asking = np.flatnonzero(~anywhere)
        if len(asking):
            some = rows.filter(pa.array(~anywhere))
            unit, sums, places = _unit(x[asking]), _unpacked(some.column("sums"), "f8"), _unpacked(some.column("places"), "i4")
            step = self.rot.step(self.probes)
            for a in range(0, len(asking), step):
                z = slice(a, a + step)
                which, keys = [], []
                for t, i, _, one, two in self.rot.reached(unit[z], self.probes, sums[z], places[z]):
                    which.append(i)
                    keys.append((t * 2 * self.rot.dim + one) * 2 * self.rot.dim + two)
                which, keys = np.concatenate(which), np.concatenate(keys)
                order = np.argsort(which, kind="stable")
                for n, own in zip(asking[z], np.split(keys[order], np.searchsorted(which[order], np.arange(1, len(asking[z])))), strict=True):
                    out.append((ids[n], *self._best(ids[n], x[n], floors[n], self._under(own))))
        size = [len(v) for _, v, _ in out]
        if sum(size):
            yield pa.record_batch([pa.array(np.repeat([i for i, _, _ in out], size), pa.int64()), pa.array(np.concatenate([v for _, v, _ in out])),
                                   pa.array(np.concatenate([e for _, _, e in out]))], names=["query_id", "vec_id", "score"])


def _best(k: int, rot: Rotations, probes: int, kind: str):
    """Rows sorted by (bucket, i, j, queries last): a stripe's vectors, then the queries that meet it."""
    def run(batches):
        held, one = None, None
        for whole in batches:
            for b in (whole.slice(at, 1024) for at in range(0, whole.num_rows, 1024)):
                keys = np.stack([b.column(c).to_numpy() for c in ("bucket", "i", "j", "is_query")], 1)
                edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1), len(keys)]
                for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                    if tuple(keys[lo, :3]) != held:
                        held, one = tuple(keys[lo, :3]), _Stripe(k, rot, probes, kind)
                    if keys[lo, 3]:
                        yield from one.ask(b.slice(lo, hi - lo))
                    else:
                        one.add(b.slice(lo, hi - lo))
    return run


def _meet(vectors: DataFrame, queries: DataFrame, k: int, rot: Rotations, probes: int, kind: str, size: int, asked: int) -> DataFrame:
    """vectors(bucket, id, v, codes) and queries(bucket, id, v, sums, places, floor): the best of each query that reach its
    floor (null: all), from every stripe of its buckets.  Queries whose ``sums`` is empty look at every vector."""
    # one row per bucket: 2 * dimensions at most
    nv = vectors.groupBy("bucket").agg(F.ceil(F.count("*") / size).cast("int").alias("nv"))
    nq = queries.groupBy("bucket").agg(F.ceil(F.count("*") / asked).cast("int").alias("nq"))
    parts = F.broadcast(nv.join(nq, "bucket"))
    mine = lambda n: F.pmod(F.xxhash64("id", "bucket"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    rows = (vectors.join(parts, "bucket").select("bucket", mine("nv").alias("i"), each("nq").alias("j"), F.lit(0).alias("is_query"), "id", "v", "codes",
                                                 none("binary", "sums"), none("binary", "places"), none("double", "floor"))
            .unionAll(queries.join(parts, "bucket").select("bucket", each("nv").alias("i"), mine("nq").alias("j"), F.lit(1).alias("is_query"), "id", "v",
                                                         none("binary", "codes"), "sums", "places", "floor")))
    return (rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "is_query")
            .mapInArrow(_best(k, rot, probes, kind), "query_id bigint, vec_id bigint, score double"))


def _rank(found: DataFrame, k: int) -> DataFrame:
    from pyspark.sql import Window
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, is_query, k: int = K, tables: int = TABLES, probes: int = PROBES, id_col: str = "vec_id",
           vector_col: str = "embedding", block: int = BLOCK, seed: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row for which the column ``is_query`` holds."""
    spark = vectors.sparkSession
    ship(spark)
    v = F.col("v")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists(v, lambda c: c != 0)
    # components are kept in their own width, and scored in double precision
    narrow = isinstance(getattr(vectors.schema[vector_col].dataType, "elementType", None), T.FloatType)
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>" if narrow else "array<double>").alias("v"),
                           is_query.alias("query")).filter(F.col("id").isNotNull() & v.isNotNull() & fine))
    dim = rows.agg(F.max(F.size("v"))).first()[0] or 1
    rot = Rotations(dim, tables, seed)
    probes, kind = min(probes, (2 * rot.dim) ** 2), "f4" if narrow else "f8"
    base = rows.groupBy("id").agg(F.min(F.struct("v", "query")).alias("r")).select("id", "r.v", F.coalesce("r.query", F.lit(False)).alias("query"))
    hashed = stash(base.mapInArrow(_hashed(rot, probes), "id bigint, v binary, codes binary, axis int, sums binary, places binary"), "ann_hashed")
    number = hashed.count()
    # stripes: enough for the cores where the table allows, no more than the largest ones make
    stripes = max(1, math.ceil(number / (MOST * block)), min(math.ceil(number / (LEAST * block)), 2 * spark.sparkContext.defaultParallelism))
    groups = min(stripes, 2 * rot.dim)
    how = k, rot, probes, kind, 2 * max(LEAST * block, math.ceil(number / stripes)), ASKED * block
    bucket = F.pmod(F.col("axis"), F.lit(groups)).alias("bucket")
    held = hashed.select(bucket, "id", "v", "codes")
    asking = hashed.filter("sums is not null").select(bucket, "id", "v", "sums", "places")
    others = F.explode(F.array_remove(F.sequence(F.lit(0), F.lit(groups - 1)), F.col("bucket"))).alias("bucket")
    # first the stripes of a query's own axis; what scores less than the k-th best there cannot be among its best of all
    found = stash(_rank(_meet(held, asking.withColumn("floor", F.lit(None).cast("double")), *how), k), "ann_first")
    if groups > 1:
        floors = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
        rest = _meet(held, asking.join(floors, "id", "left").select(others, "id", "v", "sums", "places", "floor"), *how)
        found = stash(_rank(found.select("query_id", "vec_id", "score").unionAll(rest), k), "ann_found")

    enough = min(k, number - 1)
    short = (asking.select("id", "v")
             .join(found.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n")), "id", "left")
             .filter(F.coalesce("n", F.lit(0)) < enough).select("id", "v"))
    short = stash(short, "ann_short")
    if short.isEmpty():
        return found
    # the exact way for the rest: every vector of every stripe
    empty = F.lit(b"")
    every = short.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("bucket"), "id", "v", empty.alias("sums"), empty.alias("places"),
                         F.lit(None).cast("double").alias("floor"))
    exact = _rank(_meet(held, every, *how), k)
    return found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(exact)


def op3(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    out = search(e, F.pmod(F.col("vec_id"), F.lit(20)) == 0)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
