"""Text and URL column functions (native expressions, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour:
#   host prefix used for root-relative product links,
#   characters that are not allowed in file names,
#   maximum length of a file-safe name.
DEFAULT_HOST = "https://www.lazada.vn/"
UNSAFE_FILENAME_CHARS = r'[<>:"/\\|?*]'
SAFE_NAME_MAX = 50


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters Python's ``str.strip`` takes as white space.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
              "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip_ws(c) -> Column:
    """Remove leading and trailing white space, no-break and other Unicode spaces included.

    ``btrim`` with an explicit character set: no regex engine per row.
    """
    return F.btrim(_c(c), F.lit(WHITESPACE))


def nullif_empty(c) -> Column:
    """'' -> NULL."""
    return F.nullif(_c(c), F.lit(""))


def _collapse_slashes(u: Column) -> Column:
    return F.regexp_replace(u, "//+", "/")


def _absolute(host: str):
    def step(u: Column) -> Column:
        return F.when(u.startswith("/"), F.concat(F.lit(host), F.substring(u, 2, 1 << 30))).otherwise(u)
    return step


def _scheme_https(u: Column) -> Column:
    return F.regexp_replace(u, r"^https?://(www\.)?", "https://")


def _no_trailing_slash(u: Column) -> Column:
    return F.rtrim(u, F.lit("/"))


def _fixed_repair(host: str):
    def step(u: Column) -> Column:
        scheme = F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*:)?//", 0)
        rest = F.substring(u, F.length(scheme) + 1, 1 << 30)
        rest = F.regexp_replace(rest, "//+", "/")
        absolute = F.when(scheme == "//", F.concat(F.lit("https:"), scheme, rest))
        rel = F.when(scheme == "", F.regexp_replace(rest, "^/", host))
        return F.coalesce(absolute, rel, F.concat(scheme, rest))
    return step


def url_repair_steps(host: str = DEFAULT_HOST, mode: str = "parity") -> list:
    """``url_repair`` as a list of Column -> Column steps (apply one projection each)."""
    if mode == "parity":
        return [_collapse_slashes, _absolute(host)]
    if mode == "fixed":
        return [_fixed_repair(host)]
    raise ValueError(f"unknown url mode {mode!r}")


def url_normalize_steps() -> list:
    """``url_normalize`` as a list of Column -> Column steps."""
    return [strip_ws, _scheme_https, _no_trailing_slash]


def _compose(c, steps) -> Column:
    u = _c(c)
    for f in steps:
        u = f(u)
    return u


def url_repair(c, host: str = DEFAULT_HOST, mode: str = "parity") -> Column:
    """Collapse repeated slashes, then make root-relative links absolute.

    ``parity`` collapses every run of slashes, the scheme's "//" included, so
    "https://x/a" becomes "https:/x/a" and "//host/p" becomes host + "host/p".
    ``fixed`` keeps the scheme (and a protocol-relative "//") intact and only
    collapses slashes in the rest of the link.
    """
    return _compose(c, url_repair_steps(host, mode))


def url_normalize(c) -> Column:
    """Key form of a link: trim, unify scheme to https, drop "www.", drop trailing "/"."""
    return _compose(c, url_normalize_steps())


def url_key(c, host: str = DEFAULT_HOST, mode: str = "parity") -> Column:
    """Repair then normalise: the full chain used as the dedup key."""
    return _compose(c, url_repair_steps(host, mode) + url_normalize_steps())


def apply_steps(df, col: str, steps):
    """Apply Column steps to one column, one projection per step, so a step
    that reads its input more than once does not repeat the earlier steps."""
    for f in steps:
        df = df.withColumn(col, f(F.col(col)))
    return df


def safe_name(c, max_len: int = SAFE_NAME_MAX) -> Column:
    """File-safe name: unsafe characters -> "_", then the first ``max_len`` characters."""
    return F.substring(F.regexp_replace(_c(c), UNSAFE_FILENAME_CHARS, "_"), 1, max_len)


def sold_text_count(c, mode: str = "parity") -> Column:
    """Sold-count text -> bigint.

    ``parity``: remove ",", take the first run of digits, times 1000 when the
    text contains "k" in any case ("1.2k" -> 1000, "1,2k" -> 12000).
    ``decimal``: read the first decimal number ("1.2k" -> 1200), "," as a
    thousands separator, then times 1000 when a "k" follows.
    Empty or digit-free text -> NULL.
    """
    t = _c(c)
    has_k = F.lower(t).contains("k")
    mult = F.when(has_k, F.lit(1000)).otherwise(F.lit(1))
    if mode == "parity":
        digits = F.regexp_extract(F.replace(t, F.lit(","), F.lit("")), r"\d+", 0)
        return F.nullif(digits, F.lit("")).try_cast("bigint") * mult
    if mode == "decimal":
        num = F.regexp_extract(F.replace(t, F.lit(","), F.lit("")), r"\d+(\.\d+)?", 0)
        val = F.nullif(num, F.lit("")).try_cast("double") * mult
        return F.floor(val).cast("bigint")
    raise ValueError(f"unknown sold-text mode {mode!r}")


# Text formats of crawl dates, clean timestamps and file stamps.
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
FILE_STAMP_FORMAT = "yyyy-MM-dd_HH-mm"


def date_text(c) -> Column:
    return F.date_format(_c(c), DATE_FORMAT)


def timestamp_text(c) -> Column:
    return F.date_format(_c(c), TIMESTAMP_FORMAT)


def file_stamp(c) -> Column:
    """Timestamp -> the stamp used in output names (2024-01-31_13-05)."""
    return F.date_format(_c(c), FILE_STAMP_FORMAT)
