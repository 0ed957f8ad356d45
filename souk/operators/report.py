"""Report datasets: counts, shares, top-k tables, previews and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def label_distribution(df: DataFrame, label_col: str = "label", digits: int = 6) -> DataFrame:
    """Rows per label and each label's share of all rows.

    The share's denominator comes from a window over the aggregated result,
    which has one row per label, not one per input row.
    """
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.select(label_col, "n", F.round(F.col("n") / total, digits).alias("share"))


def _order_cols(by) -> list[Column]:
    return [F.col(b) if isinstance(b, str) else b for b in by]


def top_k_per_group(df: DataFrame, key: str, by: list, k: int = 3, rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group in the given order.

    ``by`` should end in a unique tie-break column so the result is
    deterministic.  Spark pushes a partial per-group limit below the shuffle
    (WindowGroupLimit), so a huge group ships at most k rows per map task.
    """
    w = Window.partitionBy(key).orderBy(*_order_cols(by))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def top_k(df: DataFrame, by: list, k: int) -> DataFrame:
    """Global top-k (per-partition top-k, then a k-row merge)."""
    return df.orderBy(*_order_cols(by)).limit(k)


def preview(df: DataFrame, order: list, n: int = 5) -> DataFrame:
    """First ``n`` rows in input order."""
    return top_k(df, order, n)


def limit_rows(df: DataFrame, n: int, order: list) -> DataFrame:
    """Stop at a target row count: exactly the first ``n`` rows in ``order``."""
    return top_k(df, order, n)


def scatter_data(df: DataFrame, x: str, y: str, hue: str) -> DataFrame:
    """The (x, y, hue) points of a scatter chart, every row kept."""
    return df.select(x, y, hue)


def scatter_bins(df: DataFrame, x: str, y: str, hue: str, bins: tuple[int, int] = (40, 40)) -> DataFrame:
    """The scatter as a grid: rows of every cell and hue that has any.

    Cells are of equal width over [min, max] of each axis, the last one closed on
    the right; columns: x_bin, y_bin (1-based), hue, n.  Rows without both
    values are left out, as a scatter leaves them out.  At most bins x bins x
    hues rows, whatever the input.
    """
    v = [F.col(c).cast("double") for c in (x, y)]
    rows = df.where(F.nanvl(v[0], F.lit(None)).isNotNull() & F.nanvl(v[1], F.lit(None)).isNotNull())
    r = rows.agg(F.min(v[0]).alias("x0"), F.max(v[0]).alias("x1"), F.min(v[1]).alias("y0"), F.max(v[1]).alias("y1")).first()
    cells = []
    for c, (lo, hi), n in zip(v, ((r["x0"], r["x1"]), (r["y0"], r["y1"])), bins, strict=True):
        if lo is None or lo == hi:  # no rows, or all on one line
            cells.append(F.lit(1))
        else:
            at = F.floor((c - F.lit(lo)) * (F.lit(float(n)) / (F.lit(hi) - F.lit(lo))))
            cells.append((F.least(at, F.lit(n - 1)) + 1).cast("int"))
    return rows.groupBy(cells[0].alias("x_bin"), cells[1].alias("y_bin"), hue).agg(F.count(F.lit(1)).alias("n"))


def scatter_sample(df: DataFrame, x: str, y: str, hue: str, row_id: list[str], max_rows: int = 5000, seed: int = 0) -> DataFrame:
    """A bounded, repeatable sample of the scatter's points: the ``max_rows`` rows of smallest md5 of row id and seed.

    The hash alone decides, so partitions and order do not matter; every task
    keeps ``max_rows`` rows at most.  Ties (rows with equal ids) go by the values.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in row_id], F.lit(str(seed)))
    rows = df.select(F.md5(text.cast("binary")).alias("_h"), x, y, hue)
    return rows.orderBy("_h", F.asc_nulls_first(x), F.asc_nulls_first(y), F.asc_nulls_first(hue)).limit(max_rows).drop("_h")


def null_audit(df: DataFrame, stage: str | None = None) -> DataFrame:
    """NULL count of every column: one aggregate pass, then one row per column."""
    cols = df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', c{i}" for i, c in enumerate(cols))
    out = agg.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, null_count)")
    if stage is not None:
        out = out.select(F.lit(stage).alias("stage"), "column_name", "null_count")
    return out


def null_audit_observed(df: DataFrame):
    """The NULL counts of every column as an observation of the pass that runs
    ``df`` anyway: (df, observation); ``observation.get`` has them after it."""
    from pyspark.sql import Observation
    obs = Observation()
    return df.observe(obs, *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]), obs


def dedup_report(deduped_with_counts: DataFrame, count_col: str, n_columns: int | None = None) -> DataFrame:
    """Rows before/after de-duplication from a ``dedup_first(count_col=...)``
    result: one aggregate over the survivors, no second pass over the input."""
    ncol = n_columns if n_columns is not None else len([c for c in deduped_with_counts.columns if c != count_col])
    return deduped_with_counts.agg(
        F.sum(count_col).cast("bigint").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        (F.sum(count_col) - F.count(F.lit(1))).cast("bigint").alias("rows_removed"),
    ).withColumn("n_columns", F.lit(ncol))


def crawl_summary(df: DataFrame, keys=("platform", "category_name", "page")) -> DataFrame:
    """Rows per platform / category / page."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def observe_rows(df: DataFrame, name: str):
    """Attach a row counter that fills in when the plan runs (no extra pass).

    Returns (df, observation); ``observation.get["rows"]`` holds the count
    after the first action on the returned DataFrame.
    """
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
