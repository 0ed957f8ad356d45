"""Stage runners: raw rows -> cleaned -> featured -> labelled."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from souk.operators.clean import clean_listings
from souk.operators.features import add_features
from souk.operators.labels import label_products
from souk.session import hand_off
from souk.sources.fixture import RAW_ORDER, raw_listing_rows
from souk.sources.payloads import lazada_sold_fields

# A fixed clean timestamp keeps query output repeatable.
RUN_TS = "2024-01-01 00:00:00"


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listing rows as a Lazada crawl emits them (sold count parsed from text)."""
    return lazada_sold_fields(raw_listing_rows(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    kw.setdefault("order_by", RAW_ORDER)
    return clean_listings(listing_rows(spark, sf_dir), RUN_TS, **kw)


def featured(spark: SparkSession, sf_dir: str, persist: bool = True, **kw) -> DataFrame:
    """Cleaned rows with features.  The table feeds several passes (threshold
    quantiles, labelling, statistics), so by default it is handed off once as
    Parquet: later passes read the columns they need and do not run the scan,
    parse and de-duplication again."""
    f = add_features(cleaned(spark, sf_dir, **kw))
    return hand_off(f, "featured") if persist else f


def labeled(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    return label_products(featured(spark, sf_dir, **kw))
