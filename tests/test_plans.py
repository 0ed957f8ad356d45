"""Physical-plan properties the design relies on at scale."""

from pyspark.sql import functions as F

from souk.operators import report, stats
from souk.operators.dedup import dedup_first
from souk.plans import stages as P
from souk.sources.categories import category_dim
from souk.sources.fixture import landing_from_tables, raw_listing_rows
from souk.sources.payloads import attach_category, flatten_tiki

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_clean_plan_is_jvm_only_and_pruned(spark, sf_small):
    p = plan(P.cleaned(spark, sf_small))
    assert not any(n in p for n in PYTHON_NODES)
    # the scan reads only the lineitem columns the listing rows use
    scan = [line for line in p.splitlines() if "lineitem.parquet" in line][0]
    assert "l_tax" not in scan and "l_returnflag" not in scan
    # de-duplication: partial aggregate below the single hash exchange on the link
    assert "partial_min_by" in p
    assert p.count("Exchange hashpartitioning(product_url") == 1


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(100000).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    p = plan(dedup_first(df, ["k"], ["o"]))
    before_exchange = p[p.index("Exchange"):]
    assert "partial_min_by" in before_exchange


def test_top_k_limits_below_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("label"), F.col("id").alias("sold"))
    p = plan(report.top_k_per_group(df, "label", [F.desc("sold")], k=3))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_payload_flatten_has_no_shuffle(spark, sf_small):
    landing = landing_from_tables(spark, sf_small).checkpoint(eager=True)
    p = plan(attach_category(flatten_tiki(landing), category_dim(spark)))
    assert "Exchange hashpartitioning" not in p
    assert "BroadcastHashJoin" in p
    assert not any(n in p for n in PYTHON_NODES)


def test_charts_read_their_columns_only(spark, sf_small):
    p = plan(P.labeled(spark, sf_small).select("current_price"))
    assert "ReadSchema: struct<current_price:double>" in p
    assert "featured" not in plan(P.featured(spark, sf_small, persist=False))


def test_box_stats_reads_the_rows_once(spark, tmp_path):
    spark.range(5000).select((F.col("id") % 4).cast("string").alias("label"),
                             (F.col("id") * 7 % 1000).cast("double").alias("y"), F.lit("wide").alias("w")).write.parquet(str(tmp_path / "t"))
    sc = spark.sparkContext
    sc.setJobGroup("box", "box")
    box = stats.box_stats(spark.read.parquet(str(tmp_path / "t")), "label", "y")
    jobs = sc.statusTracker().getJobIdsForGroup("box")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert str(tmp_path / "t") not in plan(box) and len(jobs) < 10


def test_raw_rows_push_filters_to_scan(spark, sf_small):
    p = plan(raw_listing_rows(spark, sf_small))
    assert "PushedFilters: [IsNotNull(l_partkey), IsNotNull(l_suppkey)]" in p


def test_pages_are_written_out_behind_their_only_shuffle_by_order(spark, sf_small):
    """Short rows are dealt by order, once a platform; lists of payload items are never shuffled, however large the tables."""
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(landing_from_tables(spark, sf_small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert p.count("Exchange hashpartitioning(l_orderkey") == 3
    assert all("collect_list" not in part.split("Union")[0] for part in p.split("Exchange hashpartitioning(l_orderkey")[3:])


def test_survivors_are_shuffled_without_what_follows_from_them(spark, sf_small):
    p = plan(P.cleaned(spark, sf_small))
    below = p[p.index("Exchange hashpartitioning(product_url"):]
    assert not any(c in below for c in ("has_discount", "is_sold", "clean_date"))
    df = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"), (F.col("id") * 3).alias("v"), (F.col("id") * 5).alias("w"))
    p = plan(dedup_first(df, ["k"], ["o"], columns=["k", "v"]))
    assert "min_by(struct(v, v" in p and "struct(k" not in p and "* 5" not in p


def test_facts_of_many_splits_are_not_dealt_again(spark, sf_small, tmp_path):
    from souk.sources.fixture import table
    assert "REPARTITION_BY_NUM" in plan(table(spark, sf_small, "lineitem"))
    table(spark, sf_small, "lineitem").repartition(2 * spark.sparkContext.defaultParallelism, F.rand(1)).write.parquet(str(tmp_path / "lineitem.parquet"))
    held = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # a split a file
    try:
        assert "Exchange" not in plan(table(spark, str(tmp_path), "lineitem"))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", held)
