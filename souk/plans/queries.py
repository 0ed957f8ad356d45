"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's test tables (through the stand-in listing rows
of ``souk.sources.fixture`` or the payload builders) and runs the library's
operators on all of it.  ``ORACLE`` holds the DuckDB SQL for the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from souk.functions import (clip, first_truthy, parse_money, parse_percent, rating_trunc, safe_name,
                            sold_text_count, to_count, to_number, url_key, url_repair)
from souk.operators import report, stats
from souk.operators.canonical import WANTED, canonicalize
from souk.operators.clean import CLEANED_COLUMNS, fill_defaults, parse_fields, prepare_listings
from souk.operators.dedup import dedup_fallback, dedup_first, dedup_id, dedup_url
from souk.operators.labels import thresholds as thresholds_op
from souk.plans import oracle as O
from souk.plans import stages as P
from souk.plans.ingest import ingest, merged_listings
from souk.plans.run import labeled_from_landing
from souk.session import hand_off, scratch_path
from souk.sources.categories import category_dim
from souk.sources.files import PANDAS_NA_TOKENS, array_lines, read_table, write_table
from souk.sources.fixture import RAW_ORDER, landing_from_tables, raw_listing_rows, table
from souk.sources.payloads import cap_pages, empty_categories

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _round(c, d=6):
    return F.round(c, d)


FEATURE_COLS = ["sold_velocity", "rating_score", "discount_percent", "popularity_score"]

# ---------------------------------------------------------------- pipeline


@query("label_distribution", O.with_ctes("labeled", """
SELECT label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM labeled GROUP BY label"""))
def q_label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many products fall in each label, and their share."""
    return report.label_distribution(P.labeled(spark, sf_dir))


@query("thresholds", O.with_ctes("thresh", """
SELECT round(p80_sold, 6) AS p80_sold, round(p70_sold, 6) AS p70_sold, round(p80_rating, 6) AS p80_rating,
       round(p85_discount, 6) AS p85_discount, round(p80_popularity, 6) AS p80_popularity FROM thresh"""))
def q_thresholds(spark, sf_dir):
    th = thresholds_op(P.featured(spark, sf_dir))
    return th.select(*[_round(F.col(c)).alias(c) for c in th.columns])


@query("label_products", O.with_ctes("labeled", "SELECT * FROM labeled"))
def q_label_products(spark, sf_dir):
    return P.labeled(spark, sf_dir)


@query("features", O.with_ctes("featured", "SELECT * FROM featured"))
def q_features(spark, sf_dir):
    return P.featured(spark, sf_dir, persist=False)


@query("clean_listings", O.with_ctes("cleaned", "SELECT * FROM cleaned"))
def q_clean_listings(spark, sf_dir):
    return P.cleaned(spark, sf_dir)


@query("canonical_columns", O.with_ctes("canon", "SELECT * EXCLUDE (ord_key, ord_line, id) FROM canon"))
def q_canonical_columns(spark, sf_dir):
    return canonicalize(P.listing_rows(spark, sf_dir))


@query("fill_defaults", O.with_ctes("filled", "SELECT * EXCLUDE (ord_key, ord_line, id) FROM filled"))
def q_fill_defaults(spark, sf_dir):
    return fill_defaults(parse_fields(canonicalize(P.listing_rows(spark, sf_dir))))


# ---------------------------------------------------------------- scalar functions

@query("parse_money", O.with_ctes("raw", f"""
SELECT price, {O.money('price')} AS price_value, {O.money_vnd('price')} AS price_vnd,
       original_price, {O.money('original_price')} AS original_price_value FROM raw"""))
def q_parse_money(spark, sf_dir):
    r = raw_listing_rows(spark, sf_dir)
    return r.select("price", parse_money("price").alias("price_value"),
                    parse_money("price", mode="vnd").alias("price_vnd"),
                    "original_price", parse_money("original_price").alias("original_price_value"))


@query("parse_percent", O.with_ctes("raw", f"""
SELECT discount, {O.pct('discount')} AS discount_value,
       coalesce({O.clip(O.pct('discount'), 0, 100)}, 0::DOUBLE) AS discount_rate FROM raw"""))
def q_parse_percent(spark, sf_dir):
    r = raw_listing_rows(spark, sf_dir)
    return r.select("discount", parse_percent("discount").alias("discount_value"),
                    F.coalesce(clip(parse_percent("discount"), 0.0, 100.0), F.lit(0.0)).alias("discount_rate"))


@query("clip", O.with_ctes("raw", f"""
SELECT rating, {O.clip(O.num('rating'), 0, 5)} AS rating_average,
       {O.clip(O.pct('discount'), 0, 100)} AS discount_rate FROM raw"""))
def q_clip(spark, sf_dir):
    r = raw_listing_rows(spark, sf_dir)
    return r.select("rating", clip(to_number("rating"), 0.0, 5.0).alias("rating_average"),
                    clip(parse_percent("discount"), 0.0, 100.0).alias("discount_rate"))


@query("to_count", O.with_ctes("raw", f"""
SELECT review_count, {O.count('review_count')} AS review_count_value,
       {O.count('price')} AS price_count FROM raw"""))
def q_to_count(spark, sf_dir):
    r = raw_listing_rows(spark, sf_dir)
    return r.select("review_count", to_count("review_count").alias("review_count_value"),
                    to_count("price").alias("price_count"))


@query("sold_text", O.with_ctes("raw", f"""
SELECT sold_text, {O.sold_parity('sold_text')} AS sold_value,
       {O.sold_decimal('sold_text')} AS sold_value_decimal FROM raw"""))
def q_sold_text(spark, sf_dir):
    r = raw_listing_rows(spark, sf_dir)
    return r.select("sold_text", sold_text_count("sold_text").alias("sold_value"),
                    sold_text_count("sold_text", mode="decimal").alias("sold_value_decimal"))


@query("url_repair", O.with_ctes("raw", f"""
SELECT url, {O.url_repair('url')} AS url_parity, {O.url_repair_fixed('url')} AS url_fixed FROM raw"""))
def q_url_repair(spark, sf_dir):
    r = raw_listing_rows(spark, sf_dir)
    return r.select("url", url_repair("url").alias("url_parity"),
                    url_repair("url", mode="fixed").alias("url_fixed"))


@query("url_normalize", f"""
SELECT page_id, url, {O.url_norm(O.url_repair('url'))} AS url_key,
       {O.url_norm(O.url_repair_fixed('url'))} AS url_key_fixed FROM pages""")
def q_url_normalize(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", "url", url_key("url").alias("url_key"),
                    url_key("url", mode="fixed").alias("url_key_fixed"))


@query("first_truthy", O.with_ctes("raw", f"""
SELECT price, original_price, coalesce({O.truthy('price')}, {O.truthy('original_price')}) AS shown_price,
       coalesce({O.truthy('review_count')}, {O.truthy('sold_text')}) AS first_signal FROM raw"""))
def q_first_truthy(spark, sf_dir):
    r = raw_listing_rows(spark, sf_dir)
    return r.select("price", "original_price", first_truthy("price", "original_price").alias("shown_price"),
                    first_truthy("review_count", "sold_text").alias("first_signal"))


@query("safe_name", O.with_ctes("raw", """
SELECT category_name, name, substr(regexp_replace(category_name || ' / ' || seller_name || ': ' || name,
       '[<>:"/\\\\|?*]', '_', 'g'), 1, 50) AS safe_name FROM raw"""))
def q_safe_name(spark, sf_dir):
    r = raw_listing_rows(spark, sf_dir)
    full = F.concat(F.col("category_name"), F.lit(" / "), F.col("seller_name"), F.lit(": "), F.col("name"))
    return r.select("category_name", "name", safe_name(full).alias("safe_name"))


@query("rating_trunc", """
SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_retailprice / 400 END AS rating_star,
       floor(coalesce(CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_retailprice / 400 END, 0::DOUBLE) * 10) / 10
         AS rating_value FROM part""")
def q_rating_trunc(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    star = F.when(F.col("p_partkey") % 10 != 0, F.col("p_retailprice") / 400)
    return p.select("p_partkey", star.alias("rating_star"), rating_trunc(star).alias("rating_value"))


# ---------------------------------------------------------------- dedup family

_PREP_COLS = O.CLEAN_COLS


@query("dedup_first", O.with_ctes("raw", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY platform, category_name
  ORDER BY crawl_date, ord_key, ord_line, id) AS rn FROM raw) WHERE rn = 1"""))
def q_dedup_first(spark, sf_dir):
    """Keep-first per (platform, category): few keys, each holding many rows."""
    return dedup_first(raw_listing_rows(spark, sf_dir), ["platform", "category_name"], RAW_ORDER)


@query("dedup_url", O.with_ctes("prepared", f"""
SELECT {_PREP_COLS} FROM (SELECT * REPLACE ({O.url_norm('product_url')} AS product_url) FROM prepared)
QUALIFY product_url = '' OR row_number() OVER (PARTITION BY product_url
  ORDER BY crawl_date, ord_key, ord_line, id) = 1"""))
def q_dedup_url(spark, sf_dir):
    """URL keep-first with rows lacking a URL kept (null_policy='keep')."""
    prep = prepare_listings(P.listing_rows(spark, sf_dir), P.RUN_TS, keep=["ord_key", "ord_line", "id"])
    return dedup_url(prep, RAW_ORDER, null_policy="keep").select(*CLEANED_COLUMNS)


@query("dedup_fallback", O.with_ctes("prepared", f"""
SELECT {_PREP_COLS} FROM prepared QUALIFY row_number() OVER (
  PARTITION BY product_name, current_price, seller_name, category_name
  ORDER BY crawl_date, ord_key, ord_line, id) = 1"""))
def q_dedup_fallback(spark, sf_dir):
    prep = prepare_listings(P.listing_rows(spark, sf_dir), P.RUN_TS, keep=["ord_key", "ord_line", "id"])
    return dedup_fallback(prep, RAW_ORDER).select(*CLEANED_COLUMNS)


@query("dedup_id", O.with_ctes("prepared", f"""
SELECT {_PREP_COLS}, id FROM (SELECT * REPLACE ({O.strip('id')} AS id) FROM prepared)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY crawl_date, ord_key, ord_line, id) = 1"""))
def q_dedup_id(spark, sf_dir):
    prep = prepare_listings(P.listing_rows(spark, sf_dir), P.RUN_TS, keep=["ord_key", "ord_line", "id"])
    return dedup_id(prep, RAW_ORDER).select(*CLEANED_COLUMNS, "id")


@query("dedup_report", O.with_ctes("prepared", f"""
SELECT count(*) AS rows_before, count(DISTINCT {O.url_norm('product_url')}) AS rows_after,
       count(*) - count(DISTINCT {O.url_norm('product_url')}) AS rows_removed, 18 AS n_columns
FROM prepared"""))
def q_dedup_report(spark, sf_dir):
    c = P.cleaned(spark, sf_dir, count_col="_n")
    return report.dedup_report(c, "_n", n_columns=len(CLEANED_COLUMNS))


@query("null_audit", O.with_ctes("cleaned", """
SELECT 'raw' AS stage, column_name, null_count FROM (
  UNPIVOT (SELECT count(*) - count(crawl_date) AS crawl_date, count(*) - count(platform) AS platform,
    count(*) - count(category_name) AS category_name, count(*) - count(id) AS id, count(*) - count(name) AS name,
    count(*) - count(price) AS price, count(*) - count(original_price) AS original_price,
    count(*) - count(discount) AS discount, count(*) - count(rating) AS rating,
    count(*) - count(review_count) AS review_count, count(*) - count(sold_text) AS sold_text,
    count(*) - count(brand) AS brand, count(*) - count(seller_name) AS seller_name, count(*) - count(url) AS url,
    count(*) - count(ord_key) AS ord_key, count(*) - count(ord_line) AS ord_line FROM raw)
  ON COLUMNS(*) INTO NAME column_name VALUE null_count)
UNION ALL
SELECT 'cleaned' AS stage, column_name, null_count FROM (
  UNPIVOT (SELECT count(*) - count(crawl_date) AS crawl_date, count(*) - count(platform) AS platform,
    count(*) - count(category_name) AS category_name, count(*) - count(product_name) AS product_name,
    count(*) - count(current_price) AS current_price, count(*) - count(original_price) AS original_price,
    count(*) - count(discount_rate) AS discount_rate, count(*) - count(has_discount) AS has_discount,
    count(*) - count(rating_average) AS rating_average, count(*) - count(review_count) AS review_count,
    count(*) - count(quantity_sold_value) AS quantity_sold_value,
    count(*) - count(quantity_sold_text) AS quantity_sold_text, count(*) - count(is_sold) AS is_sold,
    count(*) - count(brand) AS brand, count(*) - count(seller_location) AS seller_location,
    count(*) - count(seller_name) AS seller_name, count(*) - count(product_url) AS product_url,
    count(*) - count(clean_date) AS clean_date FROM cleaned)
  ON COLUMNS(*) INTO NAME column_name VALUE null_count)"""))
def q_null_audit(spark, sf_dir):
    raw = report.null_audit(raw_listing_rows(spark, sf_dir), stage="raw")
    cleaned = report.null_audit(P.cleaned(spark, sf_dir), stage="cleaned")
    return raw.unionByName(cleaned)


# ---------------------------------------------------------------- chart datasets

_HIST = """, st AS (SELECT min(current_price) AS lo0, max(current_price) AS hi0 FROM labeled),
rg AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
              CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM st),
bins AS (SELECT CAST(b AS INTEGER) AS bin FROM range(1, 31) t(b)),
cnt AS (SELECT CAST(least(floor((current_price - lo) * (30::DOUBLE / (hi - lo))), 29) + 1 AS INTEGER) AS bin,
               count(*) AS n FROM labeled, rg WHERE current_price IS NOT NULL AND NOT isnan(current_price) GROUP BY 1)
SELECT bins.bin, round(lo + (bins.bin - 1) * ((hi - lo) / 30::DOUBLE), 6) AS bin_lo,
       round(CASE WHEN bins.bin = 30 THEN hi ELSE lo + bins.bin * ((hi - lo) / 30::DOUBLE) END, 6) AS bin_hi,
       CAST(coalesce(cnt.n, 0) AS BIGINT) AS n
FROM bins CROSS JOIN rg LEFT JOIN cnt ON cnt.bin = bins.bin"""


@query("price_histogram", O.with_ctes("labeled", _HIST))
def q_price_histogram(spark, sf_dir):
    return stats.histogram(P.labeled(spark, sf_dir), "current_price", bins=30)


_KDE = """, st AS (SELECT min(current_price) AS lo, max(current_price) AS hi, count(*) AS n,
                 stddev_samp(current_price) AS sd FROM labeled),
par AS (SELECT lo, hi, n, sd * pow(n, -1.0 / 5.0) AS h, (hi - lo) / 199.0 AS step,
               n * (CASE WHEN hi = lo THEN 1.0 ELSE hi - lo END) / 30.0 AS scale FROM st),
vc AS (SELECT current_price AS v, count(*) AS c FROM labeled GROUP BY 1),
g AS (SELECT CAST(i AS INTEGER) AS grid_idx FROM range(0, 200) t(i)),
gx AS (SELECT grid_idx, CASE WHEN grid_idx = 199 THEN hi ELSE lo + grid_idx * step END AS x, h, n, scale FROM g, par)
SELECT grid_idx, round(x, 6) AS x,
       round(sum(c * exp(-0.5 * pow((x - v) / h, 2))) * (1.0 / (n * h * sqrt(2 * pi()))) * scale, 6) AS density
FROM gx, vc GROUP BY grid_idx, x, h, n, scale"""


@query("price_kde", O.with_ctes("labeled", _KDE))
def q_price_kde(spark, sf_dir):
    return stats.kde_curve(P.labeled(spark, sf_dir), "current_price")


def _box_sql(y: str) -> str:
    return f""", q AS (SELECT label, quantile_cont({y}, 0.25) AS q1, quantile_cont({y}, 0.5) AS med,
                  quantile_cont({y}, 0.75) AS q3 FROM labeled GROUP BY label),
j AS (SELECT l.label, l.{y} AS y, q1, med, q3, q1 - 1.5 * (q3 - q1) AS lof, q3 + 1.5 * (q3 - q1) AS hif
      FROM labeled l JOIN q USING (label)),
a AS (SELECT label, count(*) AS n, any_value(q1) AS q1, any_value(med) AS med, any_value(q3) AS q3,
             min(y) FILTER (WHERE y >= lof) AS wlo, max(y) FILTER (WHERE y <= hif) AS whi,
             count(*) FILTER (WHERE y < lof OR y > hif) AS n_outliers, avg(y) AS mean FROM j GROUP BY label)
SELECT label, n, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
       round(CASE WHEN wlo IS NULL OR wlo > q1 THEN q1 ELSE wlo END, 6) AS whislo,
       round(CASE WHEN whi IS NULL OR whi < q3 THEN q3 ELSE whi END, 6) AS whishi,
       n_outliers, round(mean, 6) AS mean FROM a"""


@query("price_by_label", O.with_ctes("labeled", _box_sql("current_price")))
def q_price_by_label(spark, sf_dir):
    return stats.box_stats(P.labeled(spark, sf_dir), "label", "current_price")


@query("rating_by_label", O.with_ctes("labeled", _box_sql("rating_score")))
def q_rating_by_label(spark, sf_dir):
    return stats.box_stats(P.labeled(spark, sf_dir), "label", "rating_score")


@query("price_outliers", O.with_ctes("labeled", """
, q AS (SELECT label, quantile_cont(current_price, 0.25) AS q1, quantile_cont(current_price, 0.75) AS q3
        FROM labeled GROUP BY label)
SELECT l.label, l.product_url, l.current_price FROM labeled l JOIN q USING (label)
WHERE l.current_price < q1 - 1.5 * (q3 - q1) OR l.current_price > q3 + 1.5 * (q3 - q1)"""))
def q_price_outliers(spark, sf_dir):
    return stats.box_outliers(P.labeled(spark, sf_dir), "label", "current_price", keep=["product_url"])


@query("rating_outliers", O.with_ctes("labeled", """
, q AS (SELECT label, quantile_cont(rating_score, 0.25) AS q1, quantile_cont(rating_score, 0.75) AS q3
        FROM labeled GROUP BY label)
SELECT l.label, l.product_url, l.rating_score FROM labeled l JOIN q USING (label)
WHERE l.rating_score < q1 - 1.5 * (q3 - q1) OR l.rating_score > q3 + 1.5 * (q3 - q1)"""))
def q_rating_outliers(spark, sf_dir):
    """Fliers of the rating-score box plot per label."""
    return stats.box_outliers(P.labeled(spark, sf_dir), "label", "rating_score", keep=["product_url"])


@query("avg_sold_by_label", O.with_ctes("labeled", """
SELECT label, round(avg(quantity_sold_value), 6) AS mean_sold, count(quantity_sold_value) AS n
FROM labeled GROUP BY label"""))
def q_avg_sold_by_label(spark, sf_dir):
    lab = P.labeled(spark, sf_dir).withColumn("sold", F.col("quantity_sold_value"))
    return stats.group_mean(lab, ["label"], "sold", out="mean_sold")


@query("avg_sold_ci", O.with_ctes("labeled", f"""
, a AS (SELECT label, avg(quantity_sold_value::DOUBLE) AS m, stddev_samp(quantity_sold_value::DOUBLE) AS sd,
               count(quantity_sold_value) AS n FROM labeled GROUP BY label)
SELECT label, n, round(m, 6) AS mean, round(m - {stats.Z_95} * sd / sqrt(n), 6) AS ci_lo,
       round(m + {stats.Z_95} * sd / sqrt(n), 6) AS ci_hi FROM a"""))
def q_avg_sold_ci(spark, sf_dir):
    lab = P.labeled(spark, sf_dir).withColumn("sold", F.col("quantity_sold_value"))
    return stats.mean_ci_normal(lab, ["label"], "sold")


def _poisson_sql(u: str) -> str:
    """Poisson(1) by inversion: the cumulated probabilities as literals."""
    import math
    total, cases = 0.0, []
    p = math.exp(-1.0)
    for k in range(16):
        p = p / k if k else p
        total += p
        cases.append(f"WHEN {u} < {total!r}::DOUBLE THEN {k}")
    return "CASE " + " ".join(cases) + " ELSE 16 END"


@query("avg_sold_ci_boot", O.with_ctes("labeled", f"""
, blk AS (SELECT label, ('0x' || substr(md5(product_url || '|42'), 1, 8))::BIGINT % 1024 AS b,
                 sum(quantity_sold_value::DOUBLE) AS s, count(quantity_sold_value) AS c FROM labeled GROUP BY 1, 2),
dig AS (SELECT label, s, c, r.t, sha256(label || '|' || b::VARCHAR || '|' || r.t::VARCHAR || '|42') AS h
        FROM blk CROSS JOIN range(0, 250) AS r(t)),
rep AS (SELECT label, t * 4 + k.k AS i, s, c, ('0x' || substr(h, 1 + 13 * k.k::INT, 13))::BIGINT::DOUBLE / 4503599627370496::DOUBLE AS u
        FROM dig CROSS JOIN range(0, 4) AS k(k)),
m AS (SELECT label, i, sum(w * s) / sum(w * c) AS m FROM (SELECT *, {_poisson_sql('u')} AS w FROM rep)
      GROUP BY label, i HAVING sum(w * c) > 0),
ci AS (SELECT label, quantile_cont(m, 0.025) AS lo, quantile_cont(m, 0.975) AS hi FROM m GROUP BY label)
SELECT l.label, count(quantity_sold_value) AS n, round(avg(quantity_sold_value::DOUBLE), 6) AS mean,
       round(any_value(lo), 6) AS ci_lo, round(any_value(hi), 6) AS ci_hi
FROM labeled l LEFT JOIN ci ON ci.label IS NOT DISTINCT FROM l.label GROUP BY l.label"""))
def q_avg_sold_ci_boot(spark, sf_dir):
    """Bootstrap CI of mean sold per label (1000 replicates of a block Poisson bootstrap)."""
    lab = P.labeled(spark, sf_dir).withColumn("sold", F.col("quantity_sold_value"))
    return stats.mean_ci_bootstrap(lab, ["label"], "sold", row_id=["product_url"], n_boot=1000, seed=42)


_TOP_ROWS = """
SELECT label, product_name, product_url, quantity_sold_value AS sold, CAST(rn AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY quantity_sold_value DESC NULLS LAST,
                               product_url) AS rn FROM labeled) WHERE rn <= 3"""


@query("top_products_rows", O.with_ctes("labeled", _TOP_ROWS))
def q_top_products_rows(spark, sf_dir):
    lab = P.labeled(spark, sf_dir).withColumn("sold", F.col("quantity_sold_value"))
    top = report.top_k_per_group(lab, "label", [F.desc_nulls_last("sold"), F.asc("product_url")], k=3)
    return top.select("label", "product_name", "product_url", "sold", "rank")


@query("top_products", O.with_ctes("labeled", f"""
SELECT label, product_name, round(avg(sold), 6) AS mean_sold FROM ({_TOP_ROWS}) GROUP BY label, product_name"""))
def q_top_products(spark, sf_dir):
    top = q_top_products_rows(spark, sf_dir)
    return stats.group_mean(top, ["label", "product_name"], "sold", out="mean_sold").drop("n")


@query("top_sold", O.with_ctes("labeled", """
SELECT product_url, product_name, quantity_sold_value AS sold, label FROM labeled
ORDER BY quantity_sold_value DESC NULLS LAST, product_url LIMIT 10"""))
def q_top_sold(spark, sf_dir):
    lab = P.labeled(spark, sf_dir).withColumn("sold", F.col("quantity_sold_value"))
    return report.top_k(lab, [F.desc_nulls_last("sold"), F.asc("product_url")], 10).select(
        "product_url", "product_name", "sold", "label")


@query("price_vs_sold", O.with_ctes("labeled", """
SELECT current_price, quantity_sold_value AS sold, label FROM labeled"""))
def q_price_vs_sold(spark, sf_dir):
    lab = P.labeled(spark, sf_dir).withColumn("sold", F.col("quantity_sold_value"))
    return report.scatter_data(lab, "current_price", "sold", "label")


@query("price_sold_bins", O.with_ctes("labeled", """
, p AS (SELECT current_price::DOUBLE AS x, quantity_sold_value::DOUBLE AS y, label FROM labeled
        WHERE current_price IS NOT NULL AND NOT isnan(current_price::DOUBLE) AND quantity_sold_value IS NOT NULL),
r AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p)
SELECT CAST(least(floor((x - x0) * (40::DOUBLE / (x1 - x0))), 39) + 1 AS INTEGER) AS x_bin,
       CAST(least(floor((y - y0) * (40::DOUBLE / (y1 - y0))), 39) + 1 AS INTEGER) AS y_bin, label, count(*) AS n
FROM p, r GROUP BY ALL"""))
def q_price_sold_bins(spark, sf_dir):
    """The price / sold scatter as a 40 x 40 grid of counts per label."""
    lab = P.labeled(spark, sf_dir).withColumn("sold", F.col("quantity_sold_value"))
    return report.scatter_bins(lab, "current_price", "sold", "label")


@query("price_sold_sample", O.with_ctes("labeled", """
SELECT current_price, quantity_sold_value AS sold, label FROM labeled
ORDER BY md5(product_url || '|7'), current_price NULLS FIRST, quantity_sold_value NULLS FIRST, label NULLS FIRST LIMIT 2000"""))
def q_price_sold_sample(spark, sf_dir):
    """A bounded sample of the scatter: the 2,000 rows of smallest seeded hash."""
    lab = P.labeled(spark, sf_dir).withColumn("sold", F.col("quantity_sold_value"))
    return report.scatter_sample(lab, "current_price", "sold", "label", row_id=["product_url"], max_rows=2000, seed=7)


@query("preview", O.with_ctes("raw", "SELECT * FROM raw ORDER BY crawl_date, ord_key, ord_line, id LIMIT 5"))
def q_preview(spark, sf_dir):
    return report.preview(raw_listing_rows(spark, sf_dir), RAW_ORDER, 5)


@query("limit_target", O.with_ctes("raw", """
SELECT * FROM (SELECT * FROM raw WHERE platform = 'Shopee'
               QUALIFY row_number() OVER (PARTITION BY id ORDER BY crawl_date, ord_key, ord_line) = 1)
ORDER BY crawl_date, ord_key, ord_line, id LIMIT 800"""))
def q_limit_target(spark, sf_dir):
    """Shopee-style run: keep-first per item id, stop at exactly 800 rows."""
    raw = raw_listing_rows(spark, sf_dir).where(F.col("platform") == "Shopee")
    firsts = dedup_first(raw, ["id"], ["crawl_date", "ord_key", "ord_line"])
    return report.limit_rows(firsts, 800, RAW_ORDER)


# ---------------------------------------------------------------- payload ingest


TIKI_OUT = ["crawl_date", "platform", "category_name", "id", "name", "price", "original_price", "discount_rate",
            "rating_average", "review_count", "quantity_sold_value", "quantity_sold_text", "brand", "seller_name",
            "thumbnail_url", "url", "badges", "url_key", "page", "item_pos"]
LAZADA_OUT = ["crawl_date", "platform", "category_name", "id", "name", "price", "original_price", "discount",
              "rating", "review_count", "sold_value", "sold_text", "brand", "location", "seller_name", "url",
              "image", "url_key", "page", "item_pos"]
SHOPEE_OUT = ["itemid", "shopid", "name", "price", "historical_sold", "liked_count", "rating_star", "discount",
              "location", "image", "url", "url_key", "page", "item_pos"]


def _ingested(spark, sf_dir, **kw):
    return ingest(landing_from_tables(spark, sf_dir), category_dim(spark), **kw)


@query("ingest_tiki", O.ingest_sql(f"SELECT {', '.join(TIKI_OUT)} FROM tiki_rows"))
def q_ingest_tiki(spark, sf_dir):
    """Tiki pages -> rows (listings/data fallback, null items skipped, badges joined, category attached)."""
    return _ingested(spark, sf_dir)["tiki"].select(*TIKI_OUT)


@query("ingest_lazada", O.ingest_sql(f"SELECT {', '.join(LAZADA_OUT)} FROM lz_rows"))
def q_ingest_lazada(spark, sf_dir):
    """Lazada pages -> rows (shown price first, sold text parsed, absolute links, bad pages skipped)."""
    return _ingested(spark, sf_dir)["lazada"].select(*LAZADA_OUT)


@query("ingest_shopee", O.ingest_sql(f"SELECT {', '.join(SHOPEE_OUT)} FROM sp_rows"))
def q_ingest_shopee(spark, sf_dir):
    """Shopee responses -> rows (two payload shapes, id-less items dropped, price scaled, rating truncated)."""
    return _ingested(spark, sf_dir)["shopee"].select(*SHOPEE_OUT)


@query("ingest_quarantine", O.ingest_sql(f"""
SELECT 'Lazada' AS platform, {O.LZ_KEY} AS url_key, {O.LZ_PAGE} AS page, 'not_json' AS reason
FROM lz_orders WHERE {O.LZ_HTML}
UNION ALL
SELECT 'Lazada', {O.LZ_KEY}, {O.LZ_PAGE}, 'malformed' FROM lz_orders WHERE {O.LZ_BAD}
UNION ALL
SELECT 'Lazada', {O.LZ_KEY}, {O.LZ_PAGE}, 'trailing_text' FROM lz_orders WHERE l_orderkey % {O.FX.TRAILING_MOD} = 1
UNION ALL
SELECT 'Lazada', {O.LZ_KEY}, {O.LZ_PAGE}, 'trailing_text' FROM lz_orders WHERE l_orderkey % {O.FX.SECOND_MOD} BETWEEN 1 AND 4
UNION ALL
SELECT platform, url_key, page, 'not_a_list' FROM (
  SELECT DISTINCT 'Tiki' AS platform, {O.TIKI_KEY} AS url_key, {O.TIKI_PAGE} AS page, l_orderkey FROM base
    WHERE l_suppkey % 3 = 1 AND l_orderkey % {O.FX.TIKI_TEXT_MOD} = 1
  UNION ALL SELECT DISTINCT 'Tiki', {O.TIKI_KEY}, {O.TIKI_PAGE}, l_orderkey FROM base
    WHERE l_suppkey % 3 = 1 AND l_orderkey % {O.FX.TIKI_OBJECT_MOD} = 1
  UNION ALL SELECT DISTINCT 'Shopee', '{O.FX.SHOPEE_KEY}', {O.SP_PAGE}, l_orderkey FROM base
    WHERE l_suppkey % 3 = 2 AND l_orderkey % {O.FX.SHOPEE_OBJECT_MOD} = 1)"""))
def q_ingest_quarantine(spark, sf_dir):
    """Payloads that are not one whole JSON object with a list of items, with the reason."""
    return _ingested(spark, sf_dir)["quarantine"].select("platform", "url_key", "page", "reason")


@query("ingest_category", O.ingest_sql("""
SELECT platform, url_key, category_name, count(*) AS n_rows FROM (
  SELECT platform, url_key, category_name FROM tiki_rows UNION ALL
  SELECT platform, url_key, category_name FROM lz_rows) GROUP BY ALL"""))
def q_ingest_category(spark, sf_dir):
    """Rows per category after the broadcast join to the category dimension."""
    parts = _ingested(spark, sf_dir)
    rows = parts["tiki"].select("platform", "url_key", "category_name").unionByName(
        parts["lazada"].select("platform", "url_key", "category_name"))
    return report.crawl_summary(rows, keys=("platform", "url_key", "category_name"))


@query("empty_categories", O.ingest_sql("""
SELECT d.platform, d.url_key, d.category_name FROM dim d WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT platform, url_key FROM tiki_rows UNION ALL SELECT platform, url_key FROM lz_rows) r
  WHERE r.platform = d.platform AND r.url_key = d.url_key)"""))
def q_empty_categories(spark, sf_dir):
    """Categories of the dimension that produced no rows."""
    parts = _ingested(spark, sf_dir)
    rows = parts["tiki"].select("platform", "url_key").unionByName(parts["lazada"].select("platform", "url_key"))
    return empty_categories(category_dim(spark), rows).select("platform", "url_key", "category_name")


@query("page_cap", O.ingest_sql("SELECT platform, url_key, page FROM pay WHERE page BETWEEN 1 AND 20"))
def q_page_cap(spark, sf_dir):
    """Landing pages kept by a 20-page cap per category."""
    return cap_pages(landing_from_tables(spark, sf_dir), 20).select("platform", "url_key", "page")


@query("crawl_summary", O.ingest_sql("""
SELECT platform, category_name, page, count(*) AS n_rows FROM (
  SELECT platform, category_name, page FROM tiki_rows UNION ALL
  SELECT platform, category_name, page FROM lz_rows UNION ALL
  SELECT 'Shopee', NULL, page FROM sp_rows) GROUP BY ALL"""))
def q_crawl_summary(spark, sf_dir):
    """Rows per platform / category / page over all ingested rows."""
    m = merged_listings(_ingested(spark, sf_dir))
    return report.crawl_summary(m.withColumn("page", F.col("page").cast("int")))


@query("dedup_itemid", O.ingest_sql(f"""
SELECT {', '.join(SHOPEE_OUT)} FROM sp_rows
QUALIFY row_number() OVER (PARTITION BY itemid ORDER BY o, item_pos) = 1"""))
def q_dedup_itemid(spark, sf_dir):
    """Shopee rows, first occurrence of each item id in arrival order."""
    sp = _ingested(spark, sf_dir)["shopee"]
    return dedup_first(sp, ["itemid"], ["fetched_at", "item_pos"]).select(*SHOPEE_OUT)


_MERGE_OUT = [*WANTED, "url_key", "page", "item_pos"]


@query("merge_platforms", O.ingest_sql(f"""
SELECT {', '.join(_MERGE_OUT)} FROM (
  SELECT crawl_date, platform, category_name, name AS product_name, price AS current_price, original_price,
    discount_rate, rating_average, review_count, quantity_sold_value, quantity_sold_text, brand,
    NULL AS seller_location, seller_name, url AS product_url, url_key, {O._v('page')} AS page,
    {O._v('item_pos')} AS item_pos FROM tiki_rows
  UNION ALL
  SELECT crawl_date, platform, category_name, name, price, original_price, discount, rating, review_count,
    {O._v('sold_value')}, sold_text, brand, location, seller_name, url, url_key, {O._v('page')},
    {O._v('item_pos')} FROM lz_rows
  UNION ALL
  SELECT crawl_date, 'Shopee', NULL, name, {O._v('price')}, NULL, discount, {O._v('rating_star')}, NULL,
    {O._v('historical_sold')}, NULL, NULL, location, NULL, url, url_key, {O._v('page')}, {O._v('item_pos')}
  FROM sp_rows)"""))
def q_merge_platforms(spark, sf_dir):
    """All platforms appended by column name, then mapped to canonical columns."""
    m = merged_listings(_ingested(spark, sf_dir))
    return canonicalize(m, keep=["url_key", "page", "item_pos"])


# ---------------------------------------------------------------- five stages from payloads



@query("landing_to_labels", O.ingest_chain("labeled", """
SELECT platform, label, count(*) AS n FROM labeled GROUP BY platform, label"""))
def q_landing_to_labels(spark, sf_dir):
    """All five stages from landing pages: ingest -> merge -> clean -> features -> labels; rows per label."""
    lab = labeled_from_landing(landing_from_tables(spark, sf_dir), category_dim(spark), P.RUN_TS)
    return report.crawl_summary(lab, keys=("platform", "label")).withColumnRenamed("n_rows", "n")


def _report_sql() -> str:
    """Every chart's values as rows (dataset, item, measure, value), from plain SQL over the labelled rows."""
    def box(name: str, y: str) -> str:
        return f"""{name}_q AS (SELECT label, quantile_cont({y}, 0.25) AS q1, quantile_cont({y}, 0.5) AS med, quantile_cont({y}, 0.75) AS q3 FROM labeled GROUP BY label),
{name}_j AS (SELECT l.label, l.{y} AS y, q1, med, q3, q1 - 1.5 * (q3 - q1) AS lof, q3 + 1.5 * (q3 - q1) AS hif FROM labeled l JOIN {name}_q USING (label)),
{name}_b AS (SELECT label, any_value(q1) AS q1, any_value(med) AS median, any_value(q3) AS q3,
  greatest(0, count(*) FILTER (WHERE y < lof OR y > hif))::DOUBLE AS n_outliers, avg(y) AS mean,
  CASE WHEN min(y) FILTER (WHERE y >= lof) > any_value(q1) THEN any_value(q1) ELSE coalesce(min(y) FILTER (WHERE y >= lof), any_value(q1)) END AS whislo,
  CASE WHEN max(y) FILTER (WHERE y <= hif) < any_value(q3) THEN any_value(q3) ELSE coalesce(max(y) FILTER (WHERE y <= hif), any_value(q3)) END AS whishi
  FROM {name}_j GROUP BY label)"""

    def rows(dataset: str, item: str, source: str, measures: str) -> str:
        return "\nUNION ALL ".join(f"SELECT '{dataset}' AS dataset, {item} AS item, '{m}' AS measure, round(({m})::DOUBLE, 6) AS value FROM {source}"
                                   for m in measures.split())
    boxes = "q1 median q3 whislo whishi n_outliers mean"
    hist = _HIST.split("SELECT bins.bin", 1)
    kde = _KDE.split("SELECT grid_idx, round(x, 6)", 1)
    # both start with a CTE named st; the second one is renamed
    kde_ctes = kde[0].replace(", st AS", ", kst AS", 1).replace("FROM st)", "FROM kst)")
    return f"""{hist[0]}, hist AS (SELECT bins.bin{hist[1]}){kde_ctes}, kde AS (SELECT grid_idx, round(x, 6){kde[1]}),
{box('pr', 'current_price')}, {box('ra', 'rating_score')},
dist AS (SELECT label, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM labeled GROUP BY label),
sold AS (SELECT label, avg(quantity_sold_value::DOUBLE) AS mean, avg(quantity_sold_value::DOUBLE) AS mean_sold, count(quantity_sold_value) AS n,
  avg(quantity_sold_value::DOUBLE) - {stats.Z_95} * stddev_samp(quantity_sold_value::DOUBLE) / sqrt(count(quantity_sold_value)) AS ci_lo,
  avg(quantity_sold_value::DOUBLE) + {stats.Z_95} * stddev_samp(quantity_sold_value::DOUBLE) / sqrt(count(quantity_sold_value)) AS ci_hi
  FROM labeled GROUP BY label),
pout AS (SELECT label, y, count(*) AS n FROM pr_j WHERE y < lof OR y > hif GROUP BY ALL),
rout AS (SELECT label, y, count(*) AS n FROM ra_j WHERE y < lof OR y > hif GROUP BY ALL),
top AS (SELECT label, product_name, avg(sold) AS mean_sold FROM (
  SELECT label, product_name, quantity_sold_value AS sold, row_number() OVER (PARTITION BY label ORDER BY quantity_sold_value DESC NULLS LAST, product_url) AS rn
  FROM labeled) WHERE rn <= 3 GROUP BY ALL),
points AS (SELECT label, count(*) AS n, sum(current_price::DOUBLE) AS current_price, sum(quantity_sold_value::DOUBLE) AS sold FROM labeled GROUP BY label)
{rows('label_distribution', 'label', 'dist', 'n share')}
UNION ALL {rows('price_histogram', 'bin::VARCHAR', 'hist', 'bin_lo bin_hi n')}
UNION ALL {rows('price_kde', 'grid_idx::VARCHAR', 'kde', 'x density')}
UNION ALL {rows('price_by_label', 'label', 'pr_b', boxes)}
UNION ALL {rows('rating_by_label', 'label', 'ra_b', boxes)}
UNION ALL {rows('price_outliers', "label || '|' || round(y, 4)::DECIMAL(20,4)::VARCHAR", 'pout', 'n')}
UNION ALL {rows('rating_outliers', "label || '|' || round(y, 4)::DECIMAL(20,4)::VARCHAR", 'rout', 'n')}
UNION ALL {rows('avg_sold_ci', 'label', 'sold', 'n mean ci_lo ci_hi')}
UNION ALL {rows('avg_sold_by_label', 'label', 'sold', 'n mean_sold')}
UNION ALL {rows('price_vs_sold', 'label', 'points', 'n current_price sold')}
UNION ALL {rows('top_products', "label || '|' || product_name", 'top', 'mean_sold')}
UNION ALL {rows('labeled', 'label', 'dist', 'n')}"""


def _values(df: DataFrame, dataset: str, item, measures: str) -> DataFrame:
    """A chart's numbers as rows (dataset, item, measure, value)."""
    each = F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), F.round(F.col(m).cast("double"), 6).alias("value")) for m in measures.split()]))
    return df.select(F.lit(dataset).alias("dataset"), item.cast("string").alias("item"), each)


@query("report_run", O.ingest_chain("labeled", _report_sql()))
def q_report_run(spark, sf_dir):
    """All stages from landing pages to the report: the values of every chart."""
    from functools import reduce

    from souk.plans.run import run
    out = run(landing_from_tables(spark, sf_dir), category_dim(spark), P.RUN_TS)
    label, boxes = F.col("label"), "q1 median q3 whislo whishi n_outliers mean"
    point = lambda y: F.concat_ws("|", label, F.round(y, 4).cast("decimal(20,4)").cast("string"))
    sums = out["price_vs_sold"].groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("current_price").cast("double")).alias("current_price"),
                                                     F.sum(F.col("sold").cast("double")).alias("sold"))
    items = {"label_distribution": (label, "n share"), "price_histogram": (F.col("bin"), "bin_lo bin_hi n"), "price_kde": (F.col("grid_idx"), "x density"),
             "price_by_label": (label, boxes), "rating_by_label": (label, boxes), "price_outliers": (point("current_price"), "n"),
             "rating_outliers": (point("rating_score"), "n"), "avg_sold_ci": (label, "n mean ci_lo ci_hi"), "avg_sold_by_label": (label, "n mean_sold"),
             "price_vs_sold": (label, "n current_price sold"), "top_products": (F.concat_ws("|", label, "product_name"), "mean_sold"), "labeled": (label, "n")}
    out |= {"price_vs_sold": sums, "labeled": sums.select("label", "n")}
    return reduce(DataFrame.unionByName, [_values(out[k], k, *items[k]) for k in items])


@query("landing_to_clean", O.ingest_chain("cleaned", "SELECT * FROM cleaned"))
def q_landing_to_clean(spark, sf_dir):
    """Landing pages of all platforms -> cleaned, de-duplicated listing rows."""
    from souk.operators.clean import clean_listings
    from souk.plans.run import INGEST_ORDER
    merged = merged_listings(_ingested(spark, sf_dir))
    return clean_listings(merged, P.RUN_TS, order_by=INGEST_ORDER)


# ---------------------------------------------------------------- file sources and sinks


_RAW_COLS = ["crawl_date", "platform", "category_name", "id", "name", "price", "original_price", "discount",
             "rating", "review_count", "sold_text", "brand", "seller_name", "url", "ord_key", "ord_line"]


@query("src_json", O.with_ctes("raw", "SELECT * FROM raw"))
def q_src_json(spark, sf_dir):
    """Raw rows written as compressed JSON Lines (NULL fields kept) and read back with their schema."""
    raw = raw_listing_rows(spark, sf_dir)
    path = write_table(raw, scratch_path(spark, "raw.json"), fmt="json", compression="gzip", file_rows=250_000)
    return read_table(spark, path, schema=raw.schema)


def _na_sql(col: str) -> str:
    toks = ", ".join("'" + t.replace("'", "''") + "'" for t in PANDAS_NA_TOKENS)
    return f"CASE WHEN CAST({col} AS VARCHAR) IN ({toks}) THEN NULL ELSE CAST({col} AS VARCHAR) END AS {col}"


_NOTE_SQL = r"""'  ' || coalesce(name, '') || chr(10) || 'say "' || coalesce(brand, '') || '", ' || chr(13) || chr(10) || '\n \\' || chr(13) || coalesce(seller_name, '') || ' ' || chr(10) AS note"""


@query("src_json_array", O.with_ctes("raw", f"SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in _RAW_COLS)} FROM raw"))
def q_src_json_array(spark, sf_dir):
    """Raw rows as indented JSON arrays, a compressed file a task, read back with every array split at its records."""
    raw = raw_listing_rows(spark, sf_dir)
    cols = [F.col(c).cast("string").alias(c) for c in _RAW_COLS]
    record = F.concat(F.lit("  "), F.regexp_replace(F.to_json(F.struct(*cols), {"pretty": "true", "ignoreNullFields": "false"}), "\n", "\n  "))
    path = scratch_path(spark, "raw_arrays.json")
    array_lines(raw.select(record.alias("value"))).write.option("compression", "gzip").text(path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in _RAW_COLS])
    return read_table(spark, path, fmt="json", schema=schema, multi_line=True)


@query("src_csv", O.with_ctes("raw", f"SELECT {', '.join(_na_sql(c) for c in _RAW_COLS)}, {_NOTE_SQL} FROM raw"))
def q_src_csv(spark, sf_dir):
    """Raw rows, and a text with line breaks, quotes, backslashes and blanks, written as compressed CSV with a header and read
    back as text; missing-value text becomes NULL."""
    part = lambda c: F.coalesce(F.col(c), F.lit(""))
    note = F.concat(F.lit("  "), part("name"), F.lit('\nsay "'), part("brand"), F.lit('", \r\n\\n \\\\\r'), part("seller_name"), F.lit(" \n"))
    raw = raw_listing_rows(spark, sf_dir).withColumn("note", note)
    path = write_table(raw, scratch_path(spark, "raw.csv"), fmt="csv", compression="gzip", file_rows=250_000)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in raw.columns])
    return read_table(spark, path, schema=schema)


@query("sink_partitioned", O.with_ctes("raw", """
SELECT platform, substr(regexp_replace(category_name, '[<>:"/\\\\|?*]', '_', 'g'), 1, 50) AS safe_category,
       count(*) AS n_rows FROM raw GROUP BY ALL"""))
def q_sink_partitioned(spark, sf_dir):
    """Rows written as parquet, one folder per platform and file-safe category name, then counted per folder."""
    raw = raw_listing_rows(spark, sf_dir).withColumn("safe_category", safe_name("category_name"))
    path = write_table(raw, scratch_path(spark, "by_category"), fmt="parquet",
                       partition_by=["platform", "safe_category"], run_ts="2024-01-01_00-00")
    back = read_table(spark, path, fmt="parquet")
    return report.crawl_summary(back, keys=("platform", "safe_category"))


# ---------------------------------------------------------------- streaming


def _stream_slices(spark, sf_dir, n_slices: int = 4):
    """Shopee landing pages split into ``n_slices`` consecutive fetch-time ranges:
    the files that land between two runs of the incremental job."""
    # the pages are made once, for their times and for every slice
    land = hand_off(landing_from_tables(spark, sf_dir).where(F.col("platform") == "Shopee"), "pages")
    r = land.agg(F.min("fetched_at").cast("long").alias("lo"), F.max("fetched_at").cast("long").alias("hi")).first()
    lo, hi = r["lo"], r["hi"]
    step = (hi - lo) // n_slices + 1
    ts = F.col("fetched_at").cast("long")
    return [land.where((ts >= lo + i * step) & (ts < lo + (i + 1) * step)) for i in range(n_slices)]


def _stream_sink(spark, sf_dir, watermark=None, target=None) -> str:
    """Land each slice, then rerun the streaming job from the same checkpoint
    (trigger once, resume): every rerun reads only the newly landed files."""
    from souk.streaming.ingest import stream_ingest
    src, out, ck = (scratch_path(spark, "landing"), scratch_path(spark, "stream_out"),
                    scratch_path(spark, "stream_ck"))
    for part in _stream_slices(spark, sf_dir):
        part.write.mode("append").json(src)
        stream_ingest(spark, src, out, ck, watermark=watermark, target=target)
    return out


def _run_incremental(spark, sf_dir, watermark=None):
    return spark.read.parquet(_stream_sink(spark, sf_dir, watermark))


_STREAM_OUT = f"{', '.join(SHOPEE_OUT)}"


@query("stream_ingest", O.ingest_sql(f"""
SELECT {_STREAM_OUT} FROM sp_rows QUALIFY row_number() OVER (PARTITION BY itemid ORDER BY o, item_pos) = 1"""))
def q_stream_ingest(spark, sf_dir):
    """Incremental ingest over four arrivals of files, resumed from its checkpoint: the rows the batch de-duplication keeps."""
    return _run_incremental(spark, sf_dir).select(*SHOPEE_OUT)


def _watermark_sql() -> str:
    """The watermark rule slice by slice: a first row is written unless its id stands
    in a row written before it within an hour of the latest written one."""
    ts = f"(o * 60 + {O.FX.PLATFORM_OFFSET['Shopee']})"
    parts = [f""", lim AS (SELECT min(l_orderkey) * 60 + {O.FX.PLATFORM_OFFSET['Shopee']} AS lo, (max(l_orderkey) - min(l_orderkey)) * 60 // 4 + 1 AS step
       FROM base WHERE l_suppkey % 3 = 2),
f AS (SELECT *, {ts} AS ts, CAST(({ts} - lo) // step AS INTEGER) AS batch_id FROM sp_rows, lim
      QUALIFY row_number() OVER (PARTITION BY CAST(({ts} - lo) // step AS INTEGER), itemid ORDER BY o, item_pos) = 1),
a0 AS (SELECT * FROM f WHERE batch_id = 0)"""]
    for k in (1, 2, 3):
        parts.append(f"""a{k} AS (SELECT * FROM a{k - 1} UNION ALL SELECT * FROM f WHERE batch_id = {k} AND itemid NOT IN (
  SELECT itemid FROM a{k - 1} WHERE ts > (SELECT max(ts) FROM a{k - 1}) - 3600))""")
    return O.ingest_sql(",\n".join(parts) + f"\nSELECT {_STREAM_OUT}, batch_id FROM a3")


@query("stream_ingest_wm", _watermark_sql())
def q_stream_ingest_wm(spark, sf_dir):
    """Incremental ingest that remembers the last hour only: a repeat after that is written again, a first-seen item always."""
    return _run_incremental(spark, sf_dir, watermark="1 hour").select(*SHOPEE_OUT, "batch_id")


@query("stream_target", O.ingest_sql(f"""
SELECT {_STREAM_OUT} FROM (SELECT * FROM sp_rows QUALIFY row_number() OVER (PARTITION BY itemid ORDER BY o, item_pos) = 1)
ORDER BY o, item_pos LIMIT 800"""))
def q_stream_target(spark, sf_dir):
    """The first 800 rows of the ingested table, in arrival order (the run's target count)."""
    from souk.streaming.ingest import read_sink
    return read_sink(spark, _stream_sink(spark, sf_dir), limit=800).select(*SHOPEE_OUT)


@query("stream_stops_at_target", ORACLE["stream_target"])
def q_stream_stops_at_target(spark, sf_dir):
    """A stream that ends by itself when its sink holds 800 rows: the whole sink."""
    from souk.streaming.ingest import read_sink
    return read_sink(spark, _stream_sink(spark, sf_dir, target=800)).select(*SHOPEE_OUT)
