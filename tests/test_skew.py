"""A third of all rows on one key: results stay exact (no sampling, no caps)."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from souk.operators import report, stats
from souk.operators.dedup import dedup_first
from souk.operators.quantiles import quantiles


def _hot_frame(spark, n=30000, seed=1):
    rng = np.random.default_rng(seed)
    key = np.where(np.arange(n) % 3 == 0, "HOT", [f"k{i}" for i in rng.integers(0, 2000, n)])
    y = np.round(rng.gamma(2.0, 50.0, n), 2)
    pdf = pd.DataFrame({"key": key, "o": np.arange(n), "y": y})
    return pdf, spark.createDataFrame(pdf).repartition(12)


def test_dedup_hot_key(spark):
    pdf, df = _hot_frame(spark)
    out = {r.key: (r.o, r.n) for r in dedup_first(df, ["key"], ["o"], count_col="n").collect()}
    exp = pdf.sort_values("o").groupby("key").agg(o=("o", "first"), n=("o", "size"))
    assert out == {k: (int(v.o), int(v.n)) for k, v in exp.iterrows()}


def test_top_k_hot_group(spark):
    pdf, df = _hot_frame(spark)
    grp = df.withColumn("label", F.when(F.col("key") == "HOT", "HOT").otherwise("other"))
    top = report.top_k_per_group(grp, "label", [F.desc("y"), F.asc("o")], k=3).collect()
    hot = sorted((r.y, -r.o) for r in top if r.label == "HOT")[::-1]
    exp = pdf[pdf.key == "HOT"].sort_values(["y", "o"], ascending=[False, True]).head(3)
    assert [(y, -o) for y, o in zip(exp.y, exp.o)] == hot


def test_quantiles_and_box_hot_group(spark):
    pdf, df = _hot_frame(spark)
    grp = df.withColumn("label", F.when(F.col("key") == "HOT", "HOT").otherwise("other"))
    pdf["label"] = np.where(pdf.key == "HOT", "HOT", "other")
    q = {r.label: r for r in quantiles(grp, [("q1", "y", .25), ("q3", "y", .75)], by=["label"],
                                       num_partitions=7).collect()}
    box = {r.label: r for r in stats.box_stats(grp, "label", "y").collect()}
    for lab, sub in pdf.groupby("label"):
        q1, q3 = sub.y.quantile(.25), sub.y.quantile(.75)
        assert abs(q[lab].q1 - q1) < 1e-9 and abs(q[lab].q3 - q3) < 1e-9
        iqr = q3 - q1
        assert box[lab].n == len(sub)
        assert box[lab].n_outliers == int(((sub.y < q1 - 1.5 * iqr) | (sub.y > q3 + 1.5 * iqr)).sum())
        assert box[lab].whishi == sub.y[sub.y <= q3 + 1.5 * iqr].max()


def test_box_outliers_deal_no_rows_by_group(spark):
    """The quartiles go to the rows: a label's rows never meet in one task, however large Spark takes the quartiles to be."""
    _, df = _hot_frame(spark)
    grp = df.withColumn("label", F.when(F.col("key") == "HOT", "HOT").otherwise("other"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = stats.box_outliers(grp, "label", "y", keep=["o"])
        last = next(x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in x)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert "BroadcastHashJoin" in last
