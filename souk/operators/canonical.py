"""Map differing source column names onto one canonical listing schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Source column -> canonical column, in the reference's map order.
# Several sources may name the same target; the first one present that is not
# NULL wins (coalesce in this order).
ALIASES: list[tuple[str, str]] = [
    ("category_name", "category_name"),
    ("name", "product_name"),
    ("price", "current_price"),
    ("original_price", "original_price"),
    ("discount", "discount_rate"),
    ("discount_rate", "discount_rate"),
    ("rating", "rating_average"),
    ("rating_average", "rating_average"),
    ("ratingScore", "rating_average"),
    ("review_count", "review_count"),
    ("review", "review_count"),
    ("sold_value", "quantity_sold_value"),
    ("sold_text", "quantity_sold_text"),
    ("quantity_sold_value", "quantity_sold_value"),
    ("quantity_sold_text", "quantity_sold_text"),
    ("brand", "brand"),
    ("location", "seller_location"),
    ("seller_name", "seller_name"),
    ("url", "product_url"),
    ("image", "image_url"),
]

# The canonical columns kept after renaming, in order.
WANTED: list[str] = [
    "crawl_date", "platform", "category_name", "product_name",
    "current_price", "original_price", "discount_rate",
    "rating_average", "review_count",
    "quantity_sold_value", "quantity_sold_text",
    "brand", "seller_location", "seller_name",
    "product_url",
]


def sources_for(target: str, columns: list[str], mapping=ALIASES) -> list[str]:
    """Input columns that feed ``target``, in map order (plus the target itself
    when it is not a mapped name)."""
    srcs = [s for s, t in mapping if t == target and s in columns]
    mapped_sources = {s for s, _ in mapping}
    if target in columns and target not in mapped_sources and target not in srcs:
        srcs.append(target)
    return srcs


def canonicalize(df: DataFrame, mapping=ALIASES, wanted=WANTED, add_missing: bool = True,
                 keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Rename source aliases to canonical names and keep the wanted columns.

    Raw fields stay text (every source is cast to string) so that mixed
    sources union safely; parsing happens in the clean stage.  Targets with no
    source are dropped (``add_missing=False``, the reference's behaviour) or
    added as typed NULLs so the output schema is fixed.  ``keep`` passes extra
    columns (e.g. ordering columns) through unchanged.
    """
    cols = df.columns
    out = []
    for target in wanted:
        srcs = sources_for(target, cols, mapping)
        if srcs:
            exprs = [F.col(s).cast("string") for s in srcs]
            out.append((exprs[0] if len(exprs) == 1 else F.coalesce(*exprs)).alias(target))
        elif add_missing:
            out.append(F.lit(None).cast("string").alias(target))
    out.extend(F.col(k) for k in keep if k not in wanted)
    return df.select(*out)
