"""Feature stage: four derived scores appended to every cleaned row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Popularity weights for units sold and reviews.
POPULARITY_SOLD_WEIGHT = 0.7
POPULARITY_REVIEW_WEIGHT = 0.3

FEATURE_COLUMNS = ["sold_velocity", "rating_score", "discount_percent", "popularity_score"]


def add_features(df: DataFrame, sold: str = "quantity_sold_value", rating: str = "rating_average",
                 reviews: str = "review_count", discount: str = "discount_rate") -> DataFrame:
    """Append sold_velocity, rating_score, discount_percent and popularity_score.

    sold_velocity    = round(ln(sold + 1), 4)
    rating_score     = round(rating * ln(reviews + 1), 4)
    discount_percent = round(discount, 2)
    popularity_score = round(0.7 * sold + 0.3 * reviews, 2)
    Missing inputs count as 0.  ``ln`` of a non-positive argument is NULL.
    """
    def val(name):
        if name not in df.columns:
            return F.lit(0.0)
        return F.coalesce(F.col(name).try_cast("double"), F.lit(0.0))

    q, r, n, d = val(sold), val(rating), val(reviews), val(discount)
    return df.withColumns({
        "sold_velocity": F.round(F.ln(q + 1), 4),
        "rating_score": F.round(r * F.ln(n + 1), 4),
        "discount_percent": F.round(d, 2),
        "popularity_score": F.round(F.lit(POPULARITY_SOLD_WEIGHT) * q
                                    + F.lit(POPULARITY_REVIEW_WEIGHT) * n, 2),
    })
