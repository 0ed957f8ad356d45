"""Label stage: percentile thresholds + an ordered rule cascade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.operators.quantiles import quantiles

# The thresholds (name, feature column, quantile) ...
THRESHOLD_SPECS: list[tuple[str, str, float]] = [
    ("p80_sold", "sold_velocity", 0.80),
    ("p70_sold", "sold_velocity", 0.70),
    ("p80_rating", "rating_score", 0.80),
    ("p85_discount", "discount_percent", 0.85),
    ("p80_popularity", "popularity_score", 0.80),
]

# ... and the labels with their rules, tried in this order; ">=" is inclusive.
LABEL_DEAL = "uu_dai"
LABEL_BESTSELLER = "ban_chay"
LABEL_TRENDING = "hot_trend"
LABEL_NORMAL = "binh_thuong"

DEFAULT_RULES: list[tuple[str, str]] = [
    (LABEL_DEAL, "discount_percent >= p85_discount"),
    (LABEL_BESTSELLER, "sold_velocity >= p80_sold AND popularity_score >= p80_popularity"),
    (LABEL_TRENDING, "sold_velocity >= p70_sold AND rating_score >= p80_rating"),
]
LABELS = [LABEL_DEAL, LABEL_BESTSELLER, LABEL_TRENDING, LABEL_NORMAL]


def thresholds(df: DataFrame, specs=THRESHOLD_SPECS) -> DataFrame:
    """One row: every threshold of ``specs`` as an exact interpolated quantile."""
    return quantiles(df, specs)


def compile_rules(rules=DEFAULT_RULES, default: str = LABEL_NORMAL) -> Column:
    """Ordered (label, predicate) pairs -> one CASE WHEN column.

    A predicate is SQL text or a Column over feature and threshold columns.
    A NULL comparison does not match, so such rows fall through to later rules.
    """
    out = None
    for label, pred in rules:
        cond = F.expr(pred) if isinstance(pred, str) else pred
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def label_products(df: DataFrame, th=None, rules=DEFAULT_RULES, default: str = LABEL_NORMAL,
                   label_col: str = "label") -> DataFrame:
    """Append ``label``.  Thresholds are computed from ``df`` unless given
    (dict, or DataFrame of exactly one row, which is joined to every row).

    Computed thresholds are one row of a few numbers; they are worked out once,
    here, and stand in the plan as constants, so no later action repeats them and
    what does not read the label carries nothing of them.
    """
    if th is None:
        th = thresholds(df).first().asDict()
    names = list(th) if isinstance(th, dict) else th.columns
    clash = [k for k in names if k in df.columns]
    if clash:
        raise ValueError(f"threshold names collide with columns: {clash}")
    if isinstance(th, dict):
        tmp = df.withColumns({k: F.lit(v).cast("double") for k, v in th.items()})
    else:
        # an aggregate without keys has one row; more than one threshold row is an error, not more rows
        bad = F.raise_error(F.lit("thresholds must be a single row")).cast("double")
        one = th.agg(*[F.when(F.count(F.lit(1)) <= 1, F.max(k).cast("double")).otherwise(bad).alias(k) for k in names])
        tmp = df.crossJoin(F.broadcast(one))
    return tmp.withColumn(label_col, compile_rules(rules, default)).drop(*names)
