"""Distribution statistics behind the charts: histogram, KDE, box plots, means.

Scalar parameters of a whole column (min, max, count, stddev) are computed by
a one-row aggregate and read back to the driver; nothing else leaves the
executors.  Per-value work is done on pre-counted distinct values with partial
aggregation, so no group of rows is ever gathered in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.operators.quantiles import quantiles
from souk.session import hand_off


def _finite(col: str):
    c = F.col(col).cast("double")
    return c.isNotNull() & ~F.isnan(c)


def column_range(df: DataFrame, col: str) -> tuple[float | None, float | None, int]:
    """(min, max, count) of the finite values of a column: one 1-row aggregate."""
    r = df.where(_finite(col)).agg(F.min(F.col(col).cast("double")).alias("lo"),
                                   F.max(F.col(col).cast("double")).alias("hi"),
                                   F.count(F.lit(1)).alias("n")).first()
    return r["lo"], r["hi"], int(r["n"])


def histogram_edges(lo: float, hi: float) -> tuple[float, float]:
    """Range used for binning; an all-equal column is widened by 0.5 each side."""
    if lo == hi:
        return lo - 0.5, hi + 0.5
    return lo, hi


def value_counts(df: DataFrame, keys: list[str], y: str) -> DataFrame:
    """Rows of every group and distinct finite value of ``y``: keys, _y, _c.

    One pass over the rows with partial aggregation; written, because several
    steps read it.
    """
    v = F.col(y).cast("double").alias("_y")
    return hand_off(df.where(_finite(y)).groupBy(*keys, v).agg(F.count(F.lit(1)).alias("_c")), "value_counts")


def histogram(df: DataFrame, col: str, bins: int = 30, digits: int = 6) -> DataFrame:
    """Equal-width histogram over [min, max]; the last bin is closed on the right.

    Columns: bin (1-based), bin_lo, bin_hi, n.  Every bin is present, empty
    ones with n = 0.
    """
    return histogram_of(value_counts(df, [], col), bins, digits)


def histogram_of(counts: DataFrame, bins: int = 30, digits: int = 6) -> DataFrame:
    """The histogram of a table of values and their counts (_y, _c)."""
    grid = counts.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    x, c = F.col("_y"), F.col("_c")
    r = counts.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    if r["lo"] is None:
        return grid.select("bin", F.lit(None).cast("double").alias("bin_lo"),
                           F.lit(None).cast("double").alias("bin_hi"), F.lit(0).cast("bigint").alias("n"))
    lo, hi = histogram_edges(r["lo"], r["hi"])
    idx = F.floor((x - F.lit(lo)) * (F.lit(float(bins)) / (F.lit(hi) - F.lit(lo))))
    b = (F.least(idx, F.lit(bins - 1)) + 1).cast("int")
    found = counts.groupBy(b.alias("bin")).agg(F.sum(c).alias("n"))
    step = (F.lit(hi) - F.lit(lo)) / F.lit(float(bins))
    edges = grid.select(
        "bin",
        F.round(F.lit(lo) + (F.col("bin") - 1) * step, digits).alias("bin_lo"),
        F.round(F.when(F.col("bin") == bins, F.lit(hi)).otherwise(F.lit(lo) + F.col("bin") * step),
                digits).alias("bin_hi"),
    )
    return edges.join(found, "bin", "left").select(
        "bin", "bin_lo", "bin_hi", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def kde_curve(df: DataFrame, col: str, grid: int = 200, bins: int = 30, digits: int = 6) -> DataFrame:
    """Gaussian KDE over [min, max] on ``grid`` points, Scott's bandwidth
    (n^(-1/5) x sample stddev), scaled to histogram counts (x n x bin width).

    Works on distinct values weighted by their count: one pass over the rows counts them.
    Columns: grid_idx (0-based), x, density (count scale).
    """
    return kde_of(value_counts(df, [], col), grid, bins, digits)


#: sums of one aggregate of the KDE; more than 100 fields would leave whole-stage code generation
KDE_BLOCK = 25


def kde_of(counts: DataFrame, grid: int = 200, bins: int = 30, digits: int = 6) -> DataFrame:
    """The KDE curve of a table of values and their counts (_y, _c).

    The grid is cut into blocks of KDE_BLOCK points.  Every distinct value meets
    each block once and adds its kernel to the block's running sums, in one
    partially aggregated pass within generated code.
    """
    spark = counts.sparkSession
    c, v = F.col("_c"), F.col("_y")
    first = counts.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.sum(c).alias("n"), F.sum(c * v).alias("s")).first()
    n = int(first["n"] or 0)
    mean = first["s"] / n if n else 0.0
    square = counts.agg(F.sum(c * (v - F.lit(mean)) * (v - F.lit(mean))).alias("q")).first()["q"] if n > 1 else 0.0
    if n < 2 or not square:
        return spark.range(0).select(F.col("id").cast("int").alias("grid_idx"),
                                     F.lit(None).cast("double").alias("x"),
                                     F.lit(None).cast("double").alias("density"))
    lo, hi, sd = first["lo"], first["hi"], math.sqrt(square / (n - 1))
    h = sd * n ** (-1.0 / 5.0)
    blo, bhi = histogram_edges(lo, hi)
    scale = n * (bhi - blo) / bins
    norm = 1.0 / (n * h * math.sqrt(2 * math.pi))
    step = (hi - lo) / (grid - 1)

    blocks = -(-grid // KDE_BLOCK)
    each = counts.select(v, c, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_b"))
    each = each.select("_b", c, ((F.lit(lo) + F.col("_b") * F.lit(KDE_BLOCK * step) - v) / F.lit(h)).alias("_t"))
    at = [F.col("_t") + F.lit(j * step / h) for j in range(KDE_BLOCK)]
    sums = each.groupBy("_b").agg(*[F.sum(c * F.exp(F.lit(-0.5) * t * t)).alias(f"s{j}") for j, t in enumerate(at)])
    points = F.array(*[F.struct((F.col("_b") * KDE_BLOCK + j).cast("int").alias("grid_idx"), F.col(f"s{j}").alias("s")) for j in range(KDE_BLOCK)])
    x = F.when(F.col("grid_idx") == grid - 1, F.lit(hi)).otherwise(F.lit(lo) + F.col("grid_idx") * F.lit(step))
    return (sums.select(F.inline(points)).where(F.col("grid_idx") < grid)
            .select("grid_idx", F.round(x, digits).alias("x"), F.round(F.col("s") * F.lit(norm * scale), digits).alias("density")))


def _same_group(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on the group keys; a NULL group is a group like any other.

    ``right`` has one row of a few numbers per group and goes to every task: rows
    dealt by their group would put a label's rows, of any number, into one task.
    """
    renamed = right.withColumnsRenamed({k: f"_g{i}" for i, k in enumerate(keys)})
    cond = [left[k].eqNullSafe(renamed[f"_g{i}"]) for i, k in enumerate(keys)]
    return left.join(F.broadcast(renamed), cond, how).drop(*[f"_g{i}" for i in range(len(keys))])


def _fences(whis: float):
    width = F.lit(whis) * (F.col("q3") - F.col("q1"))
    return F.col("q1") - width, F.col("q3") + width


def box_stats(df: DataFrame, group: str, y: str, whis: float = 1.5, digits: int = 6) -> DataFrame:
    """Box-plot statistics of ``y`` per ``group``: quartiles (linear), whiskers
    at the most extreme values inside Q1 - whis*IQR .. Q3 + whis*IQR (or the
    quartile when no value lies between), outlier count, mean and n.

    The rows are read once, into counts of distinct values; quartiles, fences
    and sums come from the counts.
    """
    return box_of(value_counts(df, [group], y), group, whis, digits)


def box_of(counts: DataFrame, group: str, whis: float = 1.5, digits: int = 6) -> DataFrame:
    """Box-plot statistics of a table of values and their counts (group, _y, _c)."""
    q = quantiles(counts, [("q1", "_y", 0.25), ("med", "_y", 0.5), ("q3", "_y", 0.75)], by=[group], weight="_c")
    j = _same_group(counts, q, [group])
    lo_f, hi_f = _fences(whis)
    v, c = F.col("_y"), F.col("_c")
    agg = j.groupBy(group).agg(
        F.sum(c).alias("n"),
        F.first("q1").alias("q1"), F.first("med").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(v >= lo_f, v)).alias("_wlo"),
        F.max(F.when(v <= hi_f, v)).alias("_whi"),
        F.coalesce(F.sum(F.when((v < lo_f) | (v > hi_f), c)), F.lit(0)).alias("n_outliers"),
        (F.sum(v * c) / F.sum(c)).alias("mean"),
    )
    whislo = F.when(F.col("_wlo").isNull() | (F.col("_wlo") > F.col("q1")), F.col("q1")).otherwise(F.col("_wlo"))
    whishi = F.when(F.col("_whi").isNull() | (F.col("_whi") < F.col("q3")), F.col("q3")).otherwise(F.col("_whi"))
    r = lambda c: F.round(c, digits)
    return agg.select(
        group, "n", r(F.col("q1")).alias("q1"), r(F.col("median")).alias("median"), r(F.col("q3")).alias("q3"),
        r(F.col("q3") - F.col("q1")).alias("iqr"), r(whislo).alias("whislo"), r(whishi).alias("whishi"),
        "n_outliers", r(F.col("mean")).alias("mean"))


def box_outliers(df: DataFrame, group: str, y: str, keep: list[str], whis: float = 1.5) -> DataFrame:
    """Rows whose ``y`` lies outside the whisker fences of their group."""
    q = quantiles(value_counts(df, [group], y), [("q1", "_y", 0.25), ("q3", "_y", 0.75)], by=[group], weight="_c")
    lo_f, hi_f = _fences(whis)
    v = F.col(y).cast("double")
    return (_same_group(df.where(_finite(y)), q, [group])
            .where((v < lo_f) | (v > hi_f))
            .select(group, *keep, v.alias(y)))


def outliers_of(counts: DataFrame, group: str, y: str, whis: float = 1.5) -> DataFrame:
    """The fliers of a box plot from a table of counts (group, _y, _c): group, value and how many rows have it."""
    q = quantiles(counts, [("q1", "_y", 0.25), ("q3", "_y", 0.75)], by=[group], weight="_c")
    lo_f, hi_f = _fences(whis)
    v = F.col("_y")
    return _same_group(counts, q, [group]).where((v < lo_f) | (v > hi_f)).select(group, v.alias(y), F.col("_c").alias("n"))


def mean_of(counts: DataFrame, group: str, out: str = "mean", z: float | None = None, digits: int = 6) -> DataFrame:
    """Mean of a table of counts (group, _y, _c), with the normal confidence interval if ``z`` is given."""
    v, c = F.col("_y"), F.col("_c")
    a = counts.groupBy(group).agg(F.sum(c).alias("n"), (F.sum(v * c) / F.sum(c)).alias("m"))
    if z is None:
        return a.select(group, F.round("m", digits).alias(out), "n")
    square = _same_group(counts, a, [group]).groupBy(group).agg(F.sum(c * (v - F.col("m")) * (v - F.col("m"))).alias("q"))
    a = _same_group(a, square, [group])
    n = F.col("n").cast("double")
    half = F.lit(z) * F.sqrt(F.col("q") / F.when(n > 1, n - 1)) / F.sqrt(n)
    return a.select(group, "n", F.round("m", digits).alias(out), F.round(F.col("m") - half, digits).alias("ci_lo"),
                    F.round(F.col("m") + half, digits).alias("ci_hi"))


def group_mean(df: DataFrame, keys: list[str], y: str, out: str = "mean", digits: int = 6) -> DataFrame:
    return df.groupBy(*keys).agg(F.round(F.avg(F.col(y).cast("double")), digits).alias(out),
                                 F.count(F.col(y)).alias("n"))


# Fixed value: two-sided 95 % normal quantile.
Z_95 = 1.959963984540054


def mean_ci_normal(df: DataFrame, keys: list[str], y: str, z: float = Z_95, digits: int = 6) -> DataFrame:
    """Mean with a normal-approximation confidence interval per group."""
    v = F.col(y).cast("double")
    a = df.groupBy(*keys).agg(F.avg(v).alias("m"), F.stddev_samp(v).alias("sd"), F.count(v).alias("n"))
    half = F.lit(z) * F.col("sd") / F.sqrt(F.col("n").cast("double"))
    return a.select(*keys, "n", F.round("m", digits).alias("mean"),
                    F.round(F.col("m") - half, digits).alias("ci_lo"),
                    F.round(F.col("m") + half, digits).alias("ci_hi"))


def _poisson1(u):
    """Poisson(1) draw by inverting its CDF at the uniform ``u`` (a Column);
    draws above 16, of probability below 1e-14, count as 16."""
    cdf, p, acc = [], math.exp(-1.0), 0.0
    for k in range(16):
        if k > 0:
            p = p / k
        acc += p
        cdf.append(acc)
    w = F.lit(16)
    for k in reversed(range(16)):
        w = F.when(u < F.lit(cdf[k]), F.lit(k)).otherwise(w)
    return w


def _text(*parts):
    """The parts joined by "|", NULL as ""; a part is a column name, a Column or a number."""
    return F.concat_ws("|", *[F.lit(str(p)) if isinstance(p, int) else F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts])


def _hash_number(digits: int, *parts):
    """The first ``digits`` hex digits of md5 of the parts as a number."""
    return F.conv(F.substring(F.md5(_text(*parts).cast("binary")), 1, digits), 16, 10).cast("bigint")


#: draws out of one SHA-256 digest, of 13 hex digits (52 bits) each
DRAWS = 4


def mean_ci_bootstrap(df: DataFrame, keys: list[str], y: str, row_id: list[str], n_boot: int = 1000,
                      level: float = 0.95, seed: int = 0, blocks: int = 1024, digits: int = 6) -> DataFrame:
    """Confidence interval of the mean per group by a Poisson bootstrap of blocks.

    Rows are dealt by a hash of ``row_id`` to ``blocks`` random blocks (the same
    number at every size) and summed per group and block in one partially
    aggregated pass.  Each replicate gives every block a Poisson(1) weight; one
    digest of group, block, replicates and seed gives the weights of DRAWS
    replicates, so they are repeatable whatever the partitioning.  A group's
    blocks are one array (``blocks`` pairs at most), which each task folds into
    its replicates' sums; no row is made for a block and replicate.
    Replicate mean = sum(w * block sum) / sum(w * block count); the interval is
    the (1-level)/2 and (1+level)/2 quantiles of the replicate means.  Blocks are
    random subsets, so the variance of the mean is that of the rows.
    """
    spark = df.sparkSession
    v = F.col(y).cast("double")
    blk = (_hash_number(8, *row_id, seed) % blocks).alias("_blk")
    sums = df.where(_finite(y)).groupBy(*keys, blk).agg(F.sum(v).alias("_s"), F.count(v).alias("_c"))
    folded = sums.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_blk", "_s", F.col("_c").cast("double").alias("_c")))).alias("_v"))
    turns = -(-n_boot // DRAWS)
    # a row per group and turn: the turns are the units of work, dealt to all cores
    reps = (folded.select(*keys, "_v", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("_turn"))
            .repartition(max(1, spark.sparkContext.defaultParallelism), *keys, "_turn"))
    digest = F.transform("_v", lambda b: F.struct(b["_s"].alias("s"), b["_c"].alias("c"),
                                                  F.sha2(_text(*keys, b["_blk"], "_turn", seed).cast("binary"), 256).alias("h")))
    weight = lambda part: _poisson1(part)
    uniform = lambda h, k: F.conv(F.substring(h, 1 + 13 * k, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))
    weights = F.transform(digest, lambda b: F.struct(b["s"].alias("s"), b["c"].alias("c"),
                                                     F.transform(F.array(*[uniform(b["h"], k) for k in range(DRAWS)]), weight).alias("w")))
    zero = F.array(*[F.lit(0.0) for _ in range(2 * DRAWS)])
    total = F.aggregate(weights, zero, lambda acc, b: F.array(
        *[F.get(acc, F.lit(k)) + F.get(b["w"], F.lit(k)) * b["s"] for k in range(DRAWS)],
        *[F.get(acc, F.lit(DRAWS + k)) + F.get(b["w"], F.lit(k)) * b["c"] for k in range(DRAWS)]))
    per = reps.select(*keys, "_turn", total.alias("_t"))
    per = per.select(*keys, F.inline(F.array(*[F.struct(
        (F.col("_turn") * DRAWS + k).alias("_b"), F.get("_t", F.lit(k)).alias("_ws"), F.get("_t", F.lit(DRAWS + k)).alias("_wc")) for k in range(DRAWS)])))
    per = per.where((F.col("_b") < n_boot) & (F.col("_wc") > 0)).withColumn("_m", F.col("_ws") / F.col("_wc"))
    lo_q, hi_q = (1 - level) / 2, (1 + level) / 2
    ci = quantiles(per, [("ci_lo", "_m", lo_q), ("ci_hi", "_m", hi_q)], by=keys)
    means = df.groupBy(*keys).agg(F.avg(v).alias("mean"), F.count(v).alias("n"))
    return _same_group(means, ci, keys, "left").select(
        *keys, "n", F.round("mean", digits).alias("mean"),
        F.round("ci_lo", digits).alias("ci_lo"), F.round("ci_hi", digits).alias("ci_hi"))


__all__ = ["column_range", "histogram", "histogram_of", "value_counts", "kde_curve", "kde_of", "box_stats", "box_of", "box_outliers",
           "outliers_of", "group_mean", "mean_of", "mean_ci_normal", "mean_ci_bootstrap"]
