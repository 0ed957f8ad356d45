"""The report's shared pass, scatter grids and samples, and the plans behind them."""

import hashlib
import math
import random

from pyspark.sql import functions as F

from souk.operators import report, stats
from souk.operators.charts import chart_counts, of_chart, shares, without_group
from souk.operators.labels import label_products
from souk.plans import stages as P
from souk.plans.run import report_tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(spark, n=4000, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        label = r.choice(["a", "a", "a", "b", None])
        price = r.choice([None, float("nan"), float(r.randrange(50)), 10000.0 * (r.random() < 0.01), round(r.random() * 40, 2)])
        out.append((label, price, r.choice([None, round(r.random() * 5, 1)]), r.choice([None, r.randrange(500)]), f"u{i}", f"name {i % 7}"))
    return spark.createDataFrame(out, "label string, current_price double, rating_score double, sold long, product_url string, product_name string")


def same(a, b):
    order = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert order(a) == order(b)


def test_charts_from_counts_equal_charts_from_rows(spark):
    df = rows(spark)
    counts = chart_counts(df, "label", {"price": "current_price", "rating": "rating_score", "sold": "sold"})
    price, sold = of_chart(counts, "price"), of_chart(counts, "sold")
    same(shares(counts, "label", "rating"), report.label_distribution(df))
    same(stats.histogram_of(without_group(price)), stats.histogram(df, "current_price"))
    same(stats.kde_of(without_group(price)), stats.kde_curve(df, "current_price"))
    same(stats.box_of(price, "label"), stats.box_stats(df, "label", "current_price"))
    same(stats.mean_of(sold, "label", out="mean_sold").select("label", "mean_sold", "n"), stats.group_mean(df, ["label"], "sold", out="mean_sold"))
    same(stats.mean_of(sold, "label", z=stats.Z_95), stats.mean_ci_normal(df, ["label"], "sold"))
    fliers = stats.box_outliers(df, "label", "current_price", keep=["product_url"]).groupBy("label", "current_price").agg(F.count("*").alias("n"))
    same(stats.outliers_of(price, "label", "current_price"), fliers)


def test_empty_and_single_row_charts(spark):
    empty = rows(spark, 0)
    counts = chart_counts(empty, "label", {"price": "current_price", "rating": "rating_score"})
    price = of_chart(counts, "price")
    assert [r["n"] for r in stats.histogram_of(without_group(price)).collect()] == [0] * 30
    assert stats.kde_of(without_group(price)).count() == 0 and stats.box_of(price, "label").count() == 0
    one = spark.createDataFrame([("a", 5.0, 1.0)], "label string, current_price double, rating_score double")
    price = of_chart(chart_counts(one, "label", {"price": "current_price"}), "price")
    assert sum(r["n"] for r in stats.histogram_of(price.drop("label")).collect()) == 1
    assert stats.mean_of(price, "label", z=1.0).first()["ci_lo"] is None


def test_the_rows_are_counted_in_one_scan(spark, tmp_path):
    path = str(tmp_path / "labelled")
    rows(spark).withColumnRenamed("sold", "quantity_sold_value").write.parquet(path)
    out = report_tables(spark.read.parquet(path))
    for name, df in out.items():
        reads = name in ("price_vs_sold", "top_products")  # these show rows
        assert any(path in f for f in df.inputFiles()) == reads, name


def test_thresholds_are_constants_of_the_plan(spark, sf_small):
    lab = P.labeled(spark, sf_small)
    p = plan(lab.select("current_price"))
    assert "Window" not in p and "Join" not in p and "Exchange" not in p
    assert "Join" not in plan(lab.groupBy("label").count())


def test_label_of_an_empty_table(spark):
    df = spark.createDataFrame([], "sold_velocity double, rating_score double, discount_percent double, popularity_score double")
    assert label_products(df).collect() == []


def test_kde_stays_in_generated_code(spark):
    counts = spark.range(3000).select((F.col("id") * 7 % 1000).cast("double").alias("_y"), F.lit(2).cast("long").alias("_c"))
    curve = stats.kde_of(counts)
    text = curve._jdf.queryExecution().executedPlan().toString()
    values = {r["grid_idx"]: r["density"] for r in curve.collect()}
    assert sorted(values) == list(range(200))
    final = curve._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in text
    # "*(n)" marks operators inside generated code
    assert all(line.lstrip("+- :").startswith("*(") for line in final[:final.index("Initial Plan")].splitlines() if "HashAggregate" in line)
    v = [float(i * 7 % 1000) for i in range(3000)] * 2
    n, mean = len(v), sum(v) / len(v)
    h = math.sqrt(sum((x - mean) ** 2 for x in v) / (n - 1)) * n ** -0.2
    for k in (0, 24, 25, 100, 199):
        x = 999.0 * k / 199
        want = sum(math.exp(-0.5 * ((x - y) / h) ** 2) for y in v) / (n * h * math.sqrt(2 * math.pi)) * n * 999.0 / 30
        assert abs(values[k] - want) < 1e-5


def test_scatter_grid(spark):
    df = rows(spark)
    got = {(r["x_bin"], r["y_bin"], r["label"]): r["n"] for r in report.scatter_bins(df, "current_price", "sold", "label", (10, 5)).collect()}
    pts = [(r["current_price"], r["sold"], r["label"]) for r in df.collect() if r["current_price"] is not None and not math.isnan(r["current_price"]) and r["sold"] is not None]
    (x0, x1), (y0, y1) = ((min(z), max(z)) for z in (list(zip(*pts))[0], list(zip(*pts))[1]))
    want = {}
    for x, y, g in pts:
        k = (min(int((x - x0) * (10.0 / (x1 - x0))), 9) + 1, min(int((y - y0) * (5.0 / (y1 - y0))), 4) + 1, g)
        want[k] = want.get(k, 0) + 1
    assert got == want
    assert report.scatter_bins(df.limit(0), "current_price", "sold", "label").count() == 0
    line = spark.createDataFrame([(1.0, 2, "a"), (1.0, 3, "a")], "x double, y long, label string")
    assert [tuple(r) for r in report.scatter_bins(line, "x", "y", "label", (4, 2)).orderBy("y_bin").collect()] == [(1, 1, "a", 1), (1, 2, "a", 1)]


def test_scatter_sample_is_bounded_and_repeatable(spark):
    df = rows(spark)
    take = lambda d, n: sorted(map(str, report.scatter_sample(d, "current_price", "sold", "label", ["product_url"], n, 3).collect()))
    assert take(df, 100) == take(df.repartition(7), 100) and len(take(df, 100)) == 100
    assert len(take(df, 10 ** 6)) == df.count()
    first = sorted((r["product_url"] for r in df.collect()), key=lambda u: hashlib.md5(f"{u}|3".encode()).hexdigest())[:100]
    want = df.where(F.col("product_url").isin(first)).select("current_price", "sold", "label")
    assert take(df, 100) == sorted(map(str, want.collect()))
    assert "TakeOrderedAndProject" in plan(report.scatter_sample(df, "current_price", "sold", "label", ["product_url"], 100))


def test_bootstrap_makes_no_row_for_a_block_and_replicate(spark):
    df = rows(spark).where("sold is not null")
    out = stats.mean_ci_bootstrap(df, ["label"], "sold", ["product_url"], n_boot=203, seed=5)
    got = {r["label"]: r for r in out.collect()}
    for label, r in got.items():
        v = [x["sold"] for x in df.where(F.col("label").eqNullSafe(F.lit(label))).collect()]
        mean = sum(v) / len(v)
        half = 1.96 * math.sqrt(sum((x - mean) ** 2 for x in v) / (len(v) - 1) / len(v))
        assert r["n"] == len(v) and abs(r["ci_lo"] - (mean - half)) < half and abs(r["ci_hi"] - (mean + half)) < half
    again = stats.mean_ci_bootstrap(df.repartition(5), ["label"], "sold", ["product_url"], n_boot=203, seed=5)
    same(out, again)
