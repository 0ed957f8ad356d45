"""Ingest stage: landing pages -> flat listing rows of every platform."""

from __future__ import annotations

from pyspark.sql import DataFrame

from souk.operators.merge import merge_platforms
from souk.sources.payloads import (attach_category, cap_pages, flatten_lazada, flatten_shopee, flatten_tiki,
                                   shopee_as_listing, split_malformed)


def ingest(landing: DataFrame, dim: DataFrame, max_pages: int | None = None) -> dict[str, DataFrame]:
    """Flatten a landing table.

    Returns ``tiki``, ``lazada`` (with category names from ``dim``),
    ``shopee`` and ``quarantine`` (payloads that are not JSON objects).
    ``max_pages`` keeps only pages 1..max_pages.
    """
    if max_pages is not None:
        landing = cap_pages(landing, max_pages)
    good, bad = split_malformed(landing)
    return {
        "tiki": attach_category(flatten_tiki(good), dim),
        "lazada": attach_category(flatten_lazada(good), dim),
        "shopee": flatten_shopee(good),
        "quarantine": bad,
    }


def merged_listings(parts: dict[str, DataFrame]) -> DataFrame:
    """All platforms' rows under one set of (text) columns, lineage kept."""
    return merge_platforms(parts["tiki"], parts["lazada"], shopee_as_listing(parts["shopee"]))
