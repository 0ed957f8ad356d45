"""One pass over the labelled rows for every chart of distributions.

``chart_counts`` reads the rows once: GROUPING SETS count them for each label and
distinct value of each chart's column.  The label distribution, histogram, KDE,
box plots, outliers and means are worked out from that table of counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.session import hand_off


def chart_counts(df: DataFrame, group: str, values: dict[str, str]) -> DataFrame:
    """(chart, group, _y, _c): rows of every group and distinct value of each column of ``values`` (chart -> column).

    One aggregate with partial counts below its shuffle; written, because the
    charts read it.  Missing values are counted too (NULL ``_y``).
    """
    names = [f"_v{i}" for i in range(len(values))]
    rows = df.select(F.col(group).alias("_g"), *[F.col(c).cast("double").alias(n) for n, c in zip(names, values.values(), strict=True)])
    # the bit of a column is set where the set leaves it out; the group stands in every set
    every = (1 << len(names)) - 1
    bits = [every ^ (1 << (len(names) - 1 - i)) for i in range(len(names))]
    sets = rows.groupingSets([["_g", n] for n in names], "_g", *names).agg(F.count(F.lit(1)).alias("_c"), F.grouping_id().alias("_id"))
    chart = value = None
    for bit, chart_name, n in zip(bits, values, names, strict=True):
        here = F.col("_id") == bit
        chart = F.when(here, F.lit(chart_name)) if chart is None else chart.when(here, F.lit(chart_name))
        value = F.when(here, F.col(n)) if value is None else value.when(here, F.col(n))
    return hand_off(sets.select(chart.alias("chart"), F.col("_g").alias(group), value.alias("_y"), F.col("_c")), "chart_counts")


def of_chart(counts: DataFrame, chart: str) -> DataFrame:
    """The counts of one chart's finite values: group, _y, _c."""
    return counts.where((F.col("chart") == chart) & F.col("_y").isNotNull() & ~F.isnan("_y")).drop("chart")


def without_group(counts: DataFrame) -> DataFrame:
    """Counts of distinct values whatever their group: _y, _c."""
    return counts.groupBy("_y").agg(F.sum("_c").alias("_c"))


def shares(counts: DataFrame, group: str, chart: str, digits: int = 6) -> DataFrame:
    """Rows of every group, and their share of all rows (one row per group in the window)."""
    n = counts.where(F.col("chart") == chart).groupBy(group).agg(F.sum("_c").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return n.select(group, "n", F.round(F.col("n") / total, digits).alias("share"))


__all__ = ["chart_counts", "of_chart", "without_group", "shares"]
