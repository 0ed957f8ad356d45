"""The clean stage: canonical names -> typed, defaulted, repaired, de-duplicated rows.

Everything before the de-duplication is one Project (Catalyst collapses the
steps); the de-duplication is the only shuffle.
"""

from __future__ import annotations

import inspect
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.numbers import (clip, count_of, flag_positive, guarded_double, money_text, number_text,
                                    percent_text)
from souk.functions.text import DEFAULT_HOST, apply_steps, url_repair_steps
from souk.operators.canonical import ALIASES, WANTED, canonicalize, sources_for
from souk.operators.dedup import dedup_fallback, dedup_first, dedup_id, dedup_url

# Output columns of the clean stage, in order.
CLEANED_COLUMNS = [
    "crawl_date", "platform", "category_name", "product_name",
    "current_price", "original_price", "discount_rate", "has_discount",
    "rating_average", "review_count",
    "quantity_sold_value", "quantity_sold_text", "is_sold",
    "brand", "seller_location", "seller_name",
    "product_url", "clean_date",
]

# Types of the cleaned columns (for reading a cleaned table back from text files).
CLEANED_DDL = ("crawl_date DATE, platform STRING, category_name STRING, product_name STRING, "
               "current_price DOUBLE, original_price DOUBLE, discount_rate DOUBLE, has_discount INT, "
               "rating_average DOUBLE, review_count BIGINT, quantity_sold_value BIGINT, "
               "quantity_sold_text STRING, is_sold INT, brand STRING, seller_location STRING, "
               "seller_name STRING, product_url STRING, clean_date TIMESTAMP_NTZ")

UNKNOWN_TEXT = "Không xác định"

# Defaults for missing values, applied in this order.  A callable
# default computes the fill from the (already filled) row.
FILL_DEFAULTS: list[tuple[str, object]] = [
    ("current_price", 0.0),
    ("original_price", lambda df: F.coalesce(df["current_price"], F.lit(0.0))),
    ("discount_rate", 0.0),
    ("rating_average", 0.0),
    ("review_count", 0),
    ("quantity_sold_value", 0),
    ("quantity_sold_text", ""),
    ("brand", "No Brand"),
    ("seller_location", UNKNOWN_TEXT),
    ("seller_name", UNKNOWN_TEXT),
    ("product_url", ""),
]


# Per field: (text step, step after the guarded cast).
_PARSERS = {
    "current_price": (money_text, None),
    "original_price": (money_text, None),
    "discount_rate": (percent_text, lambda c: clip(c, 0.0, 100.0)),
    "rating_average": (number_text, lambda c: clip(c, 0.0, 5.0)),
    "review_count": (number_text, count_of),
    "quantity_sold_value": (number_text, count_of),
}


def parse_fields(df: DataFrame) -> DataFrame:
    """Type the text fields: prices, discount (clipped 0..100), rating (0..5), counts.

    Three projections (text step, guarded cast, clip/truncate): each step reads
    the previous one's column, so no string work is repeated inside a CASE.
    """
    present = [k for k in _PARSERS if k in df.columns]
    if not present:
        return df
    df = df.withColumns({k: _PARSERS[k][0](F.col(k)) for k in present})
    df = df.withColumns({k: guarded_double(k) for k in present})
    post = {k: _PARSERS[k][1](F.col(k)) for k in present if _PARSERS[k][1] is not None}
    return df.withColumns(post) if post else df


def fill_defaults(df: DataFrame, defaults=FILL_DEFAULTS) -> DataFrame:
    """Fill NULLs with constants, or with what a callable gives: a Column (or
    value), built from the row so far; it may take the DataFrame."""
    for col, default in defaults:
        if col not in df.columns:
            continue
        if callable(default):
            d = default(df) if inspect.signature(default).parameters else default()
            filler: Column = d if isinstance(d, Column) else F.lit(d)
        else:
            filler = F.lit(default)
        df = df.withColumn(col, F.coalesce(F.col(col), filler))
    return df


def stamp(df: DataFrame, run_ts: str) -> DataFrame:
    """Flags and the clean timestamp (``run_ts`` is an argument: runs are
    repeatable; one that is no timestamp raises)."""
    datetime.fromisoformat(run_ts)
    return df.withColumns({
        "has_discount": flag_positive("discount_rate"),
        "is_sold": flag_positive("quantity_sold_value"),
        "clean_date": F.lit(run_ts).cast("timestamp_ntz"),
    })


def _typed(raw: DataFrame, host: str, url_mode: str, keep: list[str] | tuple[str, ...],
           mapping=ALIASES, add_missing: bool = True) -> DataFrame:
    """Canonical columns parsed, filled and repaired (+ ``keep``), without flags and stamp."""
    df = canonicalize(raw, mapping=mapping, wanted=WANTED, add_missing=add_missing, keep=keep)
    df = parse_fields(df)
    df = fill_defaults(df)
    if "product_url" in df.columns:
        df = apply_steps(df, "product_url", url_repair_steps(host, url_mode))
    if "crawl_date" in df.columns:
        df = df.withColumn("crawl_date", F.col("crawl_date").try_cast("date"))
    return df


def prepare_listings(raw: DataFrame, run_ts: str, *, host: str = DEFAULT_HOST,
                     url_mode: str = "parity", keep: list[str] | tuple[str, ...] = (),
                     mapping=ALIASES, add_missing: bool = True) -> DataFrame:
    """Clean without de-duplication: the 18 canonical columns (+ ``keep``)."""
    df = stamp(_typed(raw, host, url_mode, keep, mapping, add_missing), run_ts)
    order = [c for c in CLEANED_COLUMNS if c in df.columns]
    return df.select(*order, *[k for k in keep if k not in order])


def dedup_listings(df: DataFrame, order: list, *, method: str = "auto", has_url: bool = True,
                   null_policy: str = "collapse", count_col: str | None = None,
                   columns: list[str] | None = None) -> DataFrame:
    """De-duplicate cleaned listings.

    ``auto`` follows the clean stage: by normalised URL when the input had a
    URL column, else by the fallback key columns.  ``url``, ``fallback``,
    ``id`` and ``none`` force a method.  ``columns`` names the columns to
    return (default: all).
    """
    if method == "auto":
        method = "url" if has_url and "product_url" in df.columns else "fallback"
    if method == "url":
        return dedup_url(df, order, null_policy=null_policy, count_col=count_col, columns=columns)
    if method == "fallback":
        return dedup_fallback(df, order, count_col=count_col, columns=columns)
    if method == "id":
        return dedup_id(df, order, count_col=count_col, columns=columns)
    if method == "none":
        return dedup_first(df, [], order, count_col=count_col, columns=columns)
    raise ValueError(f"unknown dedup method {method!r}")


def clean_listings(raw: DataFrame, run_ts: str, *, order_by: list[str], host: str = DEFAULT_HOST,
                   url_mode: str = "parity", dedup: str = "auto", null_policy: str = "collapse",
                   count_col: str | None = None) -> DataFrame:
    """The whole clean stage: 18 typed columns, one row per product link.

    ``order_by`` names input columns that give the input order; the first row
    in that order survives each duplicate group.  Flags and stamp are worked
    out for the survivors: they take no room in the shuffle.
    """
    has_url = bool(sources_for("product_url", raw.columns))
    keep = [c for c in order_by if c not in CLEANED_COLUMNS]
    if dedup == "id" and "id" not in keep:
        keep.append("id")
    df = _typed(raw, host, url_mode, keep)
    out = dedup_listings(df, order_by, method=dedup, has_url=has_url, null_policy=null_policy,
                         count_col=count_col, columns=WANTED)
    return stamp(out, run_ts).select(*CLEANED_COLUMNS, *([count_col] if count_col else []))

