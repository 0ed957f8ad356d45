"""Exact, linearly interpolated quantiles without a single-task bottleneck.

Spark's ``percentile`` aggregate merges every distinct value of a group into
one task.  Here the work is spread out:

1. count rows per distinct (group, column, value)  – partial aggregation;
2. range-partition those counts by (group, column, value) and write them with
   their partition id as Parquet (so a retried task sees the same layout);
3. per (partition, group, column) totals -> running offsets across partitions
   (at most #partitions rows per group);
4. rank interval of every distinct value = offset + running sum inside its
   partition (a window over one range partition, never a whole group);
5. keep the few values whose interval holds rank floor(h) or ceil(h), with
   h = (n - 1) * q, and interpolate: x_lo + (h - floor(h)) * (x_hi - x_lo).

This is the definition pandas ``Series.quantile``, NumPy's "linear" method and
SQL ``quantile_cont`` use.  NULL and NaN values are skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.session import hand_off


def quantiles(df: DataFrame, specs: list[tuple[str, str, float]], by: list[str] | tuple = (),
              num_partitions: int | None = None, checkpoint: bool = True, weight: str | None = None) -> DataFrame:
    """Quantiles of several columns, optionally per group.

    ``specs`` is a list of (output name, column, q).  Returns one row per group
    of ``by`` (one row overall without groups) with one double column per spec.
    With ``weight`` a row stands for that many rows (a table of counts).
    """
    by = list(by)
    if not specs:
        raise ValueError("no quantile specs")
    value_cols = list(dict.fromkeys(c for _, c, _ in specs))
    stacked = df.select(*by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("k"), F.col(c).cast("double").alias("v")) for c in value_cols
    ])).alias("_kv"), *([F.col(weight).alias("_w")] if weight else [F.lit(1).alias("_w")])).select(*by, "_kv.k", "_kv.v", "_w")
    stacked = stacked.where(F.col("v").isNotNull() & ~F.isnan("v"))
    counts = stacked.groupBy(*by, "k", "v").agg(F.sum("_w").alias("c") if weight else F.count(F.lit(1)).alias("c"))

    keys = [*by, "k", "v"]
    ranged = (counts.repartitionByRange(num_partitions, *keys) if num_partitions
              else counts.repartitionByRange(*keys))
    ranged = ranged.withColumn("_pid", F.spark_partition_id())
    if checkpoint:
        ranged = hand_off(ranged, "ranged_counts")

    grp = [*by, "k"]
    part = ranged.groupBy("_pid", *grp).agg(F.sum("c").alias("_pc"))
    wg = Window.partitionBy(*grp)
    part = part.select(
        "_pid", *grp,
        F.coalesce(F.sum("_pc").over(wg.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off"),
        F.sum("_pc").over(wg).alias("_n"),
    )
    wp = Window.partitionBy("_pid", *grp).orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.withColumn("_before", F.coalesce(F.sum("c").over(wp), F.lit(0)))
    # null-safe on the group keys: a NULL group is a group like any other
    part = part.select(*[F.col(c).alias(f"_p{i}") for i, c in enumerate(["_pid", *grp])], "_off", "_n")
    cond = [ranked[c].eqNullSafe(part[f"_p{i}"]) for i, c in enumerate(["_pid", *grp])]
    ranked = ranked.join(part, cond).drop(*[f"_p{i}" for i in range(len(grp) + 1)])
    ranked = ranked.withColumns({
        "_start": F.col("_off") + F.col("_before"),
    }).withColumn("_end", F.col("_start") + F.col("c") - 1)

    # targets of each column: array of (name, q)
    target_expr = None
    for c in value_cols:
        arr = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(q)).alias("q"))
                        for n, cc, q in specs if cc == c])
        target_expr = (F.when(F.col("k") == c, arr) if target_expr is None
                       else target_expr.when(F.col("k") == c, arr))
    t = ranked.select(*by, "v", "_start", "_end", "_n", F.explode(target_expr).alias("_t"))
    t = t.withColumn("_h", (F.col("_n") - 1).cast("double") * F.col("_t.q"))
    t = t.withColumns({"_lo": F.floor("_h"), "_hi": F.ceil("_h")})
    in_lo = F.col("_lo").between(F.col("_start"), F.col("_end"))
    in_hi = F.col("_hi").between(F.col("_start"), F.col("_end"))
    t = t.where(in_lo | in_hi)
    picked = t.groupBy(*by, F.col("_t.name").alias("name")).agg(
        F.max(F.when(in_lo, F.col("v"))).alias("x_lo"),
        F.max(F.when(in_hi, F.col("v"))).alias("x_hi"),
        F.first("_h").alias("h"),
    )
    picked = picked.withColumn(
        "value", F.col("x_lo") + (F.col("h") - F.floor("h")) * (F.col("x_hi") - F.col("x_lo")))
    names = [n for n, _, _ in specs]
    wide = [F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names]
    if by:
        # groups without any non-null value get no row: left-join from all groups
        result = picked.groupBy(*by).agg(*wide)
        groups = df.select(*by).distinct()
        cond = [groups[c].eqNullSafe(result[c]) for c in by]
        return groups.join(result, cond, "left").select(*[groups[c] for c in by], *[result[n] for n in names])
    return picked.agg(*wide)
