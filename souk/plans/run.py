"""The five stages in order: landing pages -> ingest -> clean -> features -> labels -> report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.operators import report, stats
from souk.operators.charts import chart_counts, of_chart, shares, without_group
from souk.operators.clean import clean_listings
from souk.operators.features import add_features
from souk.operators.labels import label_products
from souk.plans.ingest import ingest, merged_listings
from souk.session import hand_off

# Input order of ingested rows: fetch time, then position in the page.
INGEST_ORDER = ["crawl_date", "fetched_at", "item_pos"]


def labeled_from_landing(landing: DataFrame, dim: DataFrame, run_ts: str, *, max_pages: int | None = None,
                         persist: bool = True) -> DataFrame:
    """Landing pages of all platforms -> labelled listing rows.

    The featured table feeds both the threshold quantiles and the labelling
    pass; it is handed off once as Parquet, so ingest and clean run a single
    time and later passes read only their columns.
    """
    parts = ingest(landing, dim, max_pages=max_pages)
    merged = merged_listings(parts)
    cleaned = clean_listings(merged, run_ts, order_by=INGEST_ORDER)
    featured = add_features(cleaned)
    if persist:
        featured = hand_off(featured, "featured")
    return label_products(featured)


CHARTS = {"price": "current_price", "rating": "rating_score", "sold": "sold"}


def report_tables(labeled: DataFrame) -> dict[str, DataFrame]:
    """Datasets behind the seven charts, outliers and confidence intervals included.

    The rows are counted once (``chart_counts``); every chart of a distribution
    is worked out from the counts.  Only the charts that show rows read them: the
    top products and the scatter.
    """
    with_sold = labeled.withColumn("sold", labeled["quantity_sold_value"])
    counts = chart_counts(with_sold, "label", CHARTS)
    price, rating, sold = (of_chart(counts, c) for c in CHARTS)
    all_prices = without_group(price)
    top = report.top_k_per_group(with_sold, "label", [F.desc_nulls_last("sold"), F.asc("product_url")], k=3)
    return {
        "label_distribution": shares(counts, "label", "price"),
        "price_histogram": stats.histogram_of(all_prices),
        "price_kde": stats.kde_of(all_prices),
        "price_by_label": stats.box_of(price, "label"),
        "rating_by_label": stats.box_of(rating, "label"),
        "price_outliers": stats.outliers_of(price, "label", "current_price"),
        "rating_outliers": stats.outliers_of(rating, "label", "rating_score"),
        "avg_sold_ci": stats.mean_of(sold, "label", z=stats.Z_95),
        "avg_sold_by_label": stats.mean_of(sold, "label", out="mean_sold"),
        "price_vs_sold": report.scatter_data(with_sold, "current_price", "sold", "label"),
        "top_products": stats.group_mean(top, ["label", "product_name"], "sold", out="mean_sold"),
    }


def run(landing: DataFrame, dim: DataFrame, run_ts: str, **kw) -> dict[str, DataFrame]:
    """All stages; returns the labelled table and every report dataset."""
    labeled = labeled_from_landing(landing, dim, run_ts, **kw)
    out = {"labeled": labeled}
    out.update(report_tables(labeled))
    return out
