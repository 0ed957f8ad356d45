"""Keep-first de-duplication with a defined survivor.

``dropDuplicates`` keeps an arbitrary row per key.  Here the survivor is the
row with the smallest ordering tuple, picked with ``min_by`` inside a grouped
aggregate: Spark runs it as a partial aggregate before the shuffle, so a hot
key (e.g. every listing without a URL) is reduced to one row per map task
before it reaches the single reducer that owns the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fallback duplicate key when there is no URL column.
FALLBACK_KEYS = ["product_name", "current_price", "seller_name", "category_name"]


def _missing_key(keys: list[str]) -> Column:
    conds = [F.col(k).isNull() | (F.col(k).cast("string") == "") for k in keys]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


# Types whose equal values are the same value: a group's key stands for the key of each of its rows (0.0 equals -0.0).
_PLAIN = (T.StringType(), T.LongType(), T.IntegerType(), T.ShortType(), T.ByteType(), T.BooleanType(), T.DateType(), T.TimestampType(),
          T.TimestampNTZType(), T.BinaryType())


def dedup_first(df: DataFrame, keys: list[str], order: list[str] | list[Column],
                null_policy: str = "collapse", count_col: str | None = None,
                columns: list[str] | None = None) -> DataFrame:
    """One row per ``keys``: the one with the smallest ``order`` tuple.

    ``order`` must make rows unique within a key for a deterministic result.
    ``null_policy="collapse"`` treats NULL/'' keys as an ordinary key value (all
    rows without a key become one row); ``"keep"`` passes such rows through.
    ``count_col`` adds the number of input rows that each survivor stands for.
    ``columns`` names the survivors' columns to return (default: all); a row is
    sorted and shuffled with these, its keys and its ordering values only.
    One grouped aggregate, one shuffle, in both policies: with ``"keep"`` a
    keyless row is grouped on its own (unique) ordering values instead of the
    key, so it forms a group by itself.
    """
    if not keys:
        return _uncounted(df, count_col, columns)
    cols = columns or df.columns
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    if not order_cols:
        raise ValueError("dedup_first needs at least one ordering column")
    if null_policy not in ("collapse", "keep"):
        raise ValueError(f"unknown null_policy {null_policy!r}")
    from_key: set[str] = set()
    if null_policy == "collapse":
        group = [F.col(k) for k in keys]
        from_key = {k for k in keys if df.schema[k].dataType in _PLAIN}
        if from_key.issuperset(cols):
            from_key = set()
    else:
        miss = _missing_key(keys)
        group = ([miss.alias("_nokey")] + [F.when(~miss, F.col(k)).alias(f"_k{i}") for i, k in enumerate(keys)]
                 + [F.when(miss, o).alias(f"_o{i}") for i, o in enumerate(order_cols)])
    aggs = [F.min_by(F.struct(*[c for c in cols if c not in from_key]), F.struct(*order_cols)).alias("_first")]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    first = F.col("_first")
    return df.groupBy(*group).agg(*aggs).select(*[F.col(c) if c in from_key else first[c].alias(c) for c in cols], *([count_col] if count_col else []))


def _uncounted(df: DataFrame, count_col: str | None, columns: list[str] | None) -> DataFrame:
    """All rows as they are, each standing for itself."""
    out = df.select(*columns) if columns else df
    return out if count_col is None else out.withColumn(count_col, F.lit(1).cast("bigint"))


def dedup_url(df: DataFrame, order, url_col: str = "product_url", normalize: bool = True,
              null_policy: str = "collapse", count_col: str | None = None,
              columns: list[str] | None = None) -> DataFrame:
    """Keep-first by product link; the link is first normalised (trim, https,
    no "www.", no trailing "/") and the normalised form is what is kept."""
    if normalize:
        from souk.functions.text import apply_steps, url_normalize_steps
        df = apply_steps(df, url_col, url_normalize_steps())
    return dedup_first(df, [url_col], order, null_policy=null_policy, count_col=count_col, columns=columns)


def dedup_fallback(df: DataFrame, order, keys=FALLBACK_KEYS, count_col: str | None = None,
                   columns: list[str] | None = None) -> DataFrame:
    """Keep-first on the fallback key columns that exist; unchanged when none do."""
    return dedup_first(df, [k for k in keys if k in df.columns], order, count_col=count_col, columns=columns)


def dedup_id(df: DataFrame, order, id_col: str = "id", count_col: str | None = None,
             columns: list[str] | None = None) -> DataFrame:
    """Keep-first on the trimmed text form of an item id."""
    from souk.functions.text import strip_ws
    df = df.withColumn(id_col, strip_ws(F.col(id_col).cast("string")))
    return dedup_first(df, [id_col], order, count_col=count_col, columns=columns)


__all__ = ["dedup_first", "dedup_url", "dedup_fallback", "dedup_id", "FALLBACK_KEYS"]
