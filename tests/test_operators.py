"""Operators on small hand-made frames: dedup survivors, quantiles, labels, statistics."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from souk.operators.canonical import canonicalize
from souk.operators.clean import CLEANED_COLUMNS, clean_listings, fill_defaults
from souk.operators.dedup import dedup_first
from souk.operators.features import add_features
from souk.operators.labels import LABELS, label_products, thresholds
from souk.operators.quantiles import quantiles
from souk.operators import report, stats

RUN_TS = "2024-01-01 00:00:00"


def test_dedup_first_keeps_smallest_order(spark):
    df = spark.createDataFrame([("a", 3, "x3"), ("a", 1, "x1"), ("b", 2, "y2"), ("a", 2, "x2")], "k string, o int, v string")
    out = sorted(dedup_first(df, ["k"], ["o"]).collect())
    assert [(r.k, r.v) for r in out] == [("a", "x1"), ("b", "y2")]


def test_dedup_null_policy(spark):
    df = spark.createDataFrame([("", 1), ("", 2), ("", 3), ("u", 4)], "product_url string, o int")
    assert dedup_first(df, ["product_url"], ["o"]).count() == 2
    assert dedup_first(df, ["product_url"], ["o"], null_policy="keep").count() == 4


def test_dedup_is_idempotent(spark):
    df = spark.createDataFrame([(i % 5, i) for i in range(50)], "k int, o int")
    once = dedup_first(df, ["k"], ["o"])
    twice = dedup_first(once, ["k"], ["o"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_dedup_count_col(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(10)], "k int, o int")
    r = report.dedup_report(dedup_first(df, ["k"], ["o"], count_col="n"), "n").first()
    assert (r.rows_before, r.rows_after, r.rows_removed) == (10, 3, 7)


def test_quantiles_match_pandas(spark):
    rng = np.random.default_rng(7)
    vals = np.round(rng.exponential(10, 500), 2)
    vals[::37] = np.nan
    grp = rng.integers(0, 4, 500)
    pdf = pd.DataFrame({"g": grp, "v": vals})
    df = spark.createDataFrame(pdf).withColumn("v", F.when(F.isnan("v"), None).otherwise(F.col("v")))
    specs = [("q10", "v", 0.1), ("q50", "v", 0.5), ("q85", "v", 0.85), ("q100", "v", 1.0), ("q0", "v", 0.0)]
    glob = quantiles(df, specs, num_partitions=5).first().asDict()
    for name, _, q in specs:
        assert abs(glob[name] - pdf["v"].quantile(q)) < 1e-9
    by = {r.g: r for r in quantiles(df, specs, by=["g"], num_partitions=3).collect()}
    for g, sub in pdf.groupby("g"):
        for name, _, q in specs:
            assert abs(by[g][name] - sub["v"].quantile(q)) < 1e-9


def test_quantile_skips_nan(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "v double")
    assert quantiles(df, [("m", "v", 0.5)]).first().m == 1.5


def _featured(spark, rows):
    raw = spark.createDataFrame(rows, "name string, price string, discount string, rating string, "
                                      "review_count string, sold_value string, url string, o int")
    return add_features(clean_listings(raw, RUN_TS, order_by=["o"]))


def test_labels_every_row_once_and_p85_zero(spark):
    rows = [(f"p{i}", "100", "0%", "4.5", str(i), str(i * 3), f"/p/{i}", i) for i in range(40)]
    lab = label_products(_featured(spark, rows))
    # p85(discount) is 0, so every row is a deal
    assert {r.label for r in lab.collect()} == {"uu_dai"}
    assert lab.count() == 40


def test_labels_cascade(spark):
    rows = [(f"p{i}", "100", f"{i % 7}%", str(i % 6), str(i * 11 % 97), str(i * 13 % 101), f"/p/{i}", i)
            for i in range(200)]
    f = _featured(spark, rows)
    th = thresholds(f).first().asDict()
    pdf = f.toPandas()
    for k, col, q in [("p80_sold", "sold_velocity", .8), ("p85_discount", "discount_percent", .85)]:
        assert abs(th[k] - pdf[col].quantile(q)) < 1e-9
    lab = label_products(f, th).toPandas()
    assert set(lab.label) <= set(LABELS)
    exp = np.where(lab.discount_percent >= th["p85_discount"], "uu_dai",
                   np.where((lab.sold_velocity >= th["p80_sold"]) & (lab.popularity_score >= th["p80_popularity"]),
                            "ban_chay",
                            np.where((lab.sold_velocity >= th["p70_sold"]) & (lab.rating_score >= th["p80_rating"]),
                                     "hot_trend", "binh_thuong")))
    assert (lab.label.values == exp).all()
    dist = report.label_distribution(label_products(f, th)).toPandas()
    assert dist.n.sum() == 200 and abs(dist.share.sum() - 1) < 1e-5


def test_clean_all_urls_missing_collapse(spark):
    rows = [(f"p{i}", "1", "1%", "1", "1", "1", None, i) for i in range(3)]
    raw = spark.createDataFrame(rows, "name string, price string, discount string, rating string, "
                                      "review_count string, sold_value string, url string, o int")
    assert clean_listings(raw, RUN_TS, order_by=["o"]).count() == 1
    assert clean_listings(raw, RUN_TS, order_by=["o"], null_policy="keep").count() == 3


def test_clean_fallback_without_url(spark):
    raw = spark.createDataFrame([("a", "1", 1), ("a", "1", 2), ("b", "1", 3)], "name string, price string, o int")
    out = clean_listings(raw, RUN_TS, order_by=["o"])
    assert out.count() == 2 and out.columns == CLEANED_COLUMNS
    from souk.operators.clean import FILL_DEFAULTS
    filled = [c for c, _ in FILL_DEFAULTS]
    audit = {r.column_name: r.null_count for r in report.null_audit(out).collect()}
    assert all(audit[c] == 0 for c in filled)  # every column with a default is complete
    assert audit["platform"] == 2  # no default for an absent platform


def test_clean_empty_frame(spark):
    raw = spark.createDataFrame([], "name string, price string, url string, o int")
    out = clean_listings(raw, RUN_TS, order_by=["o"])
    assert out.count() == 0 and out.columns == CLEANED_COLUMNS


def test_colliding_aliases_coalesce_in_map_order(spark):
    raw = spark.createDataFrame([("5", "7", None, "4.1"), (None, "8", "3.0", None)],
                                "discount string, discount_rate string, rating string, ratingScore string")
    out = canonicalize(raw).select("discount_rate", "rating_average").collect()
    assert [tuple(r) for r in out] == [("5", "4.1"), ("8", "3.0")]


def test_shopee_only_columns(spark):
    from souk.sources.payloads import shopee_as_listing
    rows = spark.createDataFrame(
        [("1", "2", "n", 1.5, 10, 3, 4.5, "5%", "HN", "", "u", "k", 1, None, 0)],
        "itemid string, shopid string, name string, price double, historical_sold bigint, liked_count bigint, "
        "rating_star double, discount string, location string, image string, url string, url_key string, "
        "page int, fetched_at timestamp, item_pos int")
    c = clean_listings(shopee_as_listing(rows), RUN_TS, order_by=["item_pos"]).first()
    assert (c.platform, c.quantity_sold_value, c.rating_average, c.seller_location) == ("Shopee", 10, 4.5, "HN")


def test_histogram_all_equal(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "current_price double")
    h = stats.histogram(df, "current_price").orderBy("bin").collect()
    assert len(h) == 30 and sum(r.n for r in h) == 4
    occupied = [r for r in h if r.n > 0]
    assert len(occupied) == 1 and occupied[0].bin_lo <= 5.0 <= occupied[0].bin_hi
    assert h[0].bin_lo == 4.5 and h[-1].bin_hi == 5.5


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(3)
    v = np.round(rng.lognormal(10, 1, 1000), 2)
    df = spark.createDataFrame(pd.DataFrame({"x": v}))
    counts, edges = np.histogram(v, bins=30)
    h = stats.histogram(df, "x").orderBy("bin").collect()
    assert [r.n for r in h] == counts.tolist()
    assert np.allclose([r.bin_lo for r in h], np.round(edges[:-1], 6))


def test_kde_matches_direct_sum(spark):
    rng = np.random.default_rng(5)
    v = np.round(rng.normal(50, 10, 300), 1)
    df = spark.createDataFrame(pd.DataFrame({"x": v}))
    out = stats.kde_curve(df, "x").orderBy("grid_idx").toPandas()
    n, sd = len(v), v.std(ddof=1)
    h = sd * n ** (-0.2)
    grid = np.linspace(v.min(), v.max(), 200)
    dens = np.exp(-0.5 * ((grid[:, None] - v[None, :]) / h) ** 2).sum(1) / (n * h * np.sqrt(2 * np.pi))
    scaled = dens * n * (v.max() - v.min()) / 30
    assert np.allclose(out.density.values, scaled, atol=1e-5)


def test_box_stats_match_matplotlib_rule(spark):
    v = np.array([1, 2, 3, 4, 5, 6, 7, 8, 9, 100.0])
    df = spark.createDataFrame(pd.DataFrame({"g": ["a"] * 10, "y": v}))
    r = stats.box_stats(df, "g", "y").first()
    q1, q3 = np.percentile(v, [25, 75])
    iqr = q3 - q1
    assert r.q1 == round(q1, 6) and r.q3 == round(q3, 6)
    assert r.whishi == v[v <= q3 + 1.5 * iqr].max() and r.whislo == v[v >= q1 - 1.5 * iqr].min()
    assert r.n_outliers == 1
    out = stats.box_outliers(df, "g", "y", keep=[]).collect()
    assert [o.y for o in out] == [100.0]


def test_top_k_per_group(spark):
    df = spark.createDataFrame([(g, i, f"u{i}") for g in "ab" for i in range(10)], "label string, sold int, url string")
    top = report.top_k_per_group(df, "label", [F.desc("sold"), F.asc("url")], k=3).collect()
    assert len(top) == 6 and all(r.sold >= 7 for r in top)


def test_mean_ci(spark):
    rng = np.random.default_rng(11)
    v = rng.poisson(20, 400).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"g": ["a"] * 400, "y": v, "id": [str(i) for i in range(400)]}))
    normal = stats.mean_ci_normal(df, ["g"], "y").first()
    boot = stats.mean_ci_bootstrap(df, ["g"], "y", row_id=["id"], n_boot=200, seed=1).first()
    blocked = stats.mean_ci_bootstrap(df, ["g"], "y", row_id=["id"], n_boot=200, seed=1, blocks=64).first()
    assert normal.ci_lo < v.mean() < normal.ci_hi
    assert boot.ci_lo < v.mean() < boot.ci_hi
    # both intervals describe the same spread
    width = normal.ci_hi - normal.ci_lo
    assert abs((boot.ci_hi - boot.ci_lo) - width) < 0.5 * width
    assert abs((blocked.ci_hi - blocked.ci_lo) - width) < 0.5 * width
    again = stats.mean_ci_bootstrap(df, ["g"], "y", row_id=["id"], n_boot=200, seed=1).first()
    assert again == boot  # repeatable


def test_custom_rules_and_thresholds(spark):
    rows = [(f"p{i}", "100", f"{i % 5}%", "4", str(i), str(i), f"/p/{i}", i) for i in range(20)]
    f = _featured(spark, rows)
    rules = [("discounted", "discount_percent >= 3"),
             ("popular", F.col("popularity_score") >= F.col("p50_pop"))]
    th = {"p50_pop": 10.0}
    lab = {r.product_name: r.label for r in label_products(f, th, rules=rules, default="other").collect()}
    assert lab["p3"] == "discounted" and lab["p15"] == "popular" and lab["p1"] == "other"


def test_threshold_table_of_two_rows_fails(spark):
    f = _featured(spark, [("p", "10", "5%", "4", "3", "2", "/p/1", 1)])
    th = thresholds(f)
    with pytest.raises(Exception, match="single row"):
        label_products(f, th.unionAll(th)).collect()
    assert label_products(f, th).count() == 1


def test_null_group_in_box_statistics(spark):
    rows = [(None, float(i)) for i in range(10)] + [(None, 1000.0), ("a", 1.0), ("a", 2.0), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "g string, y double").withColumn("id", F.monotonically_increasing_id())
    box = {r.g: r for r in stats.box_stats(df, "g", "y").collect()}
    assert (box[None].n, box[None].n_outliers, box["a"].n) == (11, 1, 2)
    assert [(r.g, r.y) for r in stats.box_outliers(df, "g", "y", keep=[]).collect()] == [(None, 1000.0)]
    boot = {r.g: r for r in stats.mean_ci_bootstrap(df.where("not isnan(y)"), ["g"], "y", row_id=["id"], n_boot=50).collect()}
    assert boot[None].ci_lo is not None and boot["a"].ci_hi is not None


def test_callable_defaults_may_take_the_frame(spark):
    df = spark.createDataFrame([(None, 2.0)], "a double, b double")
    assert fill_defaults(df, [("a", lambda d: d["b"] * 2)]).first().a == 4.0
    assert fill_defaults(df, [("a", lambda: 7.0)]).first().a == 7.0


def test_bad_clean_timestamp_raises(spark):
    with pytest.raises(ValueError):
        clean_listings(spark.createDataFrame([("p", 1)], "name string, o int"), "yesterday", order_by=["o"])


def test_dedup_keep_policy_single_pass(spark):
    df = spark.createDataFrame([("", 1), (None, 2), ("u", 3), ("u", 4), ("", 5)], "k string, o int")
    out = dedup_first(df, ["k"], ["o"], null_policy="keep", count_col="n")
    got = sorted(((r.k or "-"), r.o, r.n) for r in out.collect())
    assert got == [("-", 1, 1), ("-", 2, 1), ("-", 5, 1), ("u", 3, 2)]
    fresh = dedup_first(df, ["k"], ["o"], null_policy="keep")
    plan = fresh._jdf.queryExecution().executedPlan().toString()  # not yet run: one plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_one_row_and_empty_labels(spark):
    one = _featured(spark, [("p", "10", "5%", "4", "3", "2", "/p/1", 1)])
    lab = label_products(one).collect()
    assert len(lab) == 1 and lab[0].label == "uu_dai"  # every threshold equals the only value
    empty = _featured(spark, [])
    assert label_products(empty).count() == 0
    assert thresholds(empty).first().p80_sold is None


def test_observe_rows(spark):
    df, obs = report.observe_rows(spark.range(17), "n")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 17


def test_file_stamp_and_formats(spark):
    from souk.functions.text import date_text, file_stamp, timestamp_text
    r = spark.sql("SELECT timestamp_ntz'2024-01-31 13:05:09' AS t").select(
        file_stamp("t").alias("a"), date_text("t").alias("b"), timestamp_text("t").alias("c")).first()
    assert (r.a, r.b, r.c) == ("2024-01-31_13-05", "2024-01-31", "2024-01-31 13:05:09")


def test_quantiles_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 10.0)], "g string, v double")
    got = {r.g: r.m for r in quantiles(df, [("m", "v", 0.5)], by=["g"]).collect()}
    assert got == {None: 2.0, "a": 10.0}


def test_cluster_conf_sizes():
    from souk.session import cluster_conf
    c = cluster_conf(100 * 10**12, 8000)
    assert c["spark.sql.shuffle.partitions"] == str(100 * 10**12 // (256 << 20))
    assert c["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    small = cluster_conf(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_dedup_takes_plain_keys_from_the_group_and_others_from_the_row(spark):
    df = spark.createDataFrame([("a", -0.0, 1, "x"), ("a", 0.0, 2, "y"), (None, 1.0, 3, "z"), (None, 1.0, 2, None)], "k string, d double, o int, v string")
    out = dedup_first(df, ["k", "d"], ["o"], count_col="n")
    assert out.columns == ["k", "d", "o", "v", "n"]
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == ["('a', -0.0, 1, 'x', 2)", "(None, 1.0, 2, None, 2)"]
    assert sorted(map(str, (tuple(r) for r in dedup_first(df, ["k"], ["o"], columns=["v", "k"]).collect()))) == ["('x', 'a')", "(None, None)"]
    assert sorted(map(str, (tuple(r) for r in dedup_first(df.select("k"), ["k"], ["k"]).collect()))) == ["('a',)", "(None,)"]
    assert [tuple(r) for r in dedup_first(df, ["k"], ["o"], null_policy="keep", columns=["v"]).orderBy("v").collect()] == [(None,), ("x",), ("z",)]
