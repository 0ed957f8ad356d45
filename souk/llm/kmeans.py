"""Centroid clustering of integer vectors with scalar lookup tables.

Each component x becomes the integer floor(scale * x).  The vectors are written
once in blocks: for every dimension the integers that occur in the block, and
for every component its place among them.  A round tabulates, for each
dimension, occurring integer and centroid, the squared difference; the distances
of a block are gathers from that table, summed over the dimensions.  A task
returns per centroid the number of its vectors and their sums, so a round moves
centroids x dimensions numbers a task, whatever the input.  All arithmetic is in
whole numbers and therefore exact: blocks, partitions and order do not matter.

Defined cases: vectors that are null, of another length or that hold null or
non-finite components take no part; rows with equal ids are vectors of their
own; a null id orders last among the first centroids; fewer vectors than centroids give
fewer centroids; a centroid without vectors stays where it is; ties go to the
smaller number; an empty table gives no rows.  A component so large that a
squared distance might not fit 64 bits raises an error (LIMIT).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stash, table

DIM, SCALE, K, ROUNDS, SEED = 64, 1024, 8, 10, 3
BLOCK = 4096


def limit(dim: int) -> int:
    """Largest size of a component: dim squared differences of twice that fit 63 bits."""
    return int(((1 << 62) / dim) ** 0.5) // 2


def whole_numbers(v: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null where the vector takes no part is left to ``usable``."""
    return F.transform(v.cast("array<double>"), lambda c: F.floor(c * F.lit(float(scale))))


def usable(v: Column, dim: int) -> Column:
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) == dim) & finite


class Block:
    """Vectors of a block: per dimension the occurring integers, and each component's place among all of them."""

    def __init__(self, values: np.ndarray, first: np.ndarray, codes: np.ndarray):
        self.values, self.first, self.codes = values, first, codes

    @classmethod
    def of(cls, x: np.ndarray) -> Block:
        values, first, codes = [], [0], np.empty(x.shape[::-1], np.int32)
        for d in range(x.shape[1]):
            seen, place = np.unique(x[:, d], return_inverse=True)
            codes[d] = place.reshape(-1) + first[-1]
            values.append(seen)
            first.append(first[-1] + len(seen))
        return cls(np.concatenate(values), np.array(first), codes)

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """Squared distance of every vector to every centroid: table gathers and sums."""
        dim = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        table = (self.values[:, None] - centroids[:, dim].T) ** 2
        out = np.zeros((self.codes.shape[1], len(centroids)), np.int64)
        for places in self.codes:
            out += table[places]
        return out

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = self.distances(centroids)
        best = d.argmin(1)
        return best, d[np.arange(len(d)), best]

    def sums(self, best: np.ndarray, k: int) -> np.ndarray:
        """Per cluster the sum of each dimension, exact: occurrences of each integer, times the integer."""
        out = np.zeros((k, len(self.codes)), np.int64)
        order = np.argsort(best, kind="stable")
        ends = np.searchsorted(best[order], np.arange(k + 1))
        for d, places in enumerate(self.codes):
            x = self.values[places[order]]
            run = np.concatenate([[0], np.cumsum(x)])
            out[:, d] = run[ends[1:]] - run[ends[:-1]]
        return out


def _blocks(dim: int):
    """Batches of (id, x) as blocks: ids, occurring integers, their limits, codes."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                if np.abs(x).max(initial=0) > limit(dim):
                    raise ValueError(f"a scaled component exceeds {limit(dim)}: squared distances would not fit 64 bits")
                block = Block.of(x)
                yield pa.record_batch([
                    pa.array([part.column("id").to_pylist()], pa.list_(part.column("id").type)),
                    pa.array([block.values.tobytes()], pa.binary()), pa.array([block.first.astype(np.int64).tobytes()], pa.binary()),
                    pa.array([block.codes.tobytes()], pa.binary())], names=["ids", "values", "first", "codes"])
    return run


def _read(batches):
    for b in batches:
        for i in range(b.num_rows):
            raw = [np.frombuffer(b.column(c)[i].as_py(), kind) for c, kind in (("values", np.int64), ("first", np.int64), ("codes", np.int32))]
            yield b.column("ids")[i].values if "ids" in b.schema.names else None, Block(raw[0], raw[1], raw[2].reshape(len(raw[1]) - 1, -1))


def _step(centroids: np.ndarray):
    k, dim = centroids.shape

    def run(batches):
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _, block in _read(batches):
            best, _ = block.nearest(centroids)
            count += np.bincount(best, minlength=k)
            total += block.sums(best, k)
        some = np.flatnonzero(count)
        if len(some):
            yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(count[some]), pa.array(total[some].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])
    return run


def _assign(centroids: np.ndarray):
    def run(batches):
        for ids, block in _read(batches):
            best, distance = block.nearest(centroids)
            yield pa.record_batch([ids, pa.array(best.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])
    return run


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors whose ids have the smallest sha256 of ``seed:id``."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    rows = vectors.select(key.alias("key"), "x").orderBy(F.col("key").asc_nulls_last(), "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every centroid with vectors becomes the floor of their mean."""
    parts = blocks.select("values", "first", "codes").mapInArrow(_step(centroids), "cluster int, n bigint, sums array<bigint>")
    exact = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    # centroids x dimensions rows
    rows = (parts.select("cluster", "n", F.posexplode("sums").alias("dim", "total"))
            .groupBy("cluster", "dim").agg(exact("n").alias("n"), exact("total").alias("total")).collect())
    out = centroids.copy()
    for r in rows:
        out[r["cluster"], r["dim"]] = int(r["total"]) // int(r["n"])
    return out


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, dim: int = DIM, scale: int = SCALE,
            id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every vector that takes part, and the final centroids."""
    ship(vectors.sparkSession)
    v = F.col("v")
    fit = (vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).filter(usable(v, dim))
           .select("id", whole_numbers(v, scale).alias("x")))
    kind = fit.schema["id"].dataType.simpleString()
    blocks = stash(fit.mapInArrow(_blocks(dim), f"ids array<{kind}>, values binary, first binary, codes binary"), "kmeans_blocks")
    centroids = first_centroids(fit, k, seed)
    if not len(centroids):
        centroids = np.zeros((1, dim), np.int64)
    for _ in range(rounds):
        centroids = moved(blocks, centroids)
    return blocks.mapInArrow(_assign(centroids), f"id {kind}, cluster int, distance bigint"), centroids


def op13(spark, sf_dir: str) -> DataFrame:
    """Cluster, squared distance and inertias of every embedding of 64 finite components."""
    found, centroids = cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    found = stash(found, "kmeans_assigned")
    # one row per centroid
    inertia = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    each = F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in range(len(centroids))])
    sha = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for c in centroids])
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", F.get(each, F.col("cluster")).alias("cluster_inertia"),
                        F.lit(sum(inertia.values())).cast("long").alias("inertia"), F.get(sha, F.col("cluster")).alias("centroid_sha256"))


def _sql() -> str:
    ranked = f"""v AS MATERIALIZED (
  SELECT vec_id, embedding FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS MATERIALIZED (
  SELECT vec_id, unnest(range(1, {DIM + 1})) AS d, floor({SCALE} * unnest(embedding)::DOUBLE)::BIGINT AS x FROM v),
c0 AS MATERIALIZED (
  SELECT c, d, x FROM (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS c FROM v
    QUALIFY c < {K}) JOIN x USING (vec_id))"""
    near = """a{r} AS MATERIALIZED (
  SELECT vec_id, arg_min(c, (distance, c)) AS cluster, min(distance) AS distance FROM (
    SELECT vec_id, c, sum((x.x - k.x) * (x.x - k.x)) AS distance FROM x JOIN c{r} k USING (d) GROUP BY vec_id, c)
  GROUP BY vec_id)"""
    move = """c{s} AS MATERIALIZED (
  SELECT c, d, coalesce(m, x) AS x FROM c{r} LEFT JOIN (
    SELECT cluster AS c, d, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS m
    FROM x JOIN a{r} USING (vec_id) GROUP BY cluster, d) USING (c, d))"""
    steps = [ranked]
    for r in range(ROUNDS):
        steps += [near.format(r=r), move.format(r=r, s=r + 1)]
    steps.append(near.format(r=ROUNDS))
    return f"""WITH {', '.join(steps)},
h AS (SELECT c AS cluster, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY c)
SELECT vec_id, cluster::INTEGER AS cluster, distance::BIGINT AS distance,
  (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN h USING (cluster)"""


SQL = _sql()
