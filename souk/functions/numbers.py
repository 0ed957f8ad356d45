"""Numeric parsing and shaping of marketplace text fields.

Every function takes and returns a ``Column`` and compiles to built-in
Catalyst expressions, so it stays inside whole-stage codegen.  None of them
raise under ANSI mode: bad input becomes NULL (or the documented default).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from souk.functions.text import strip_ws

# Plain decimal numbers only: optional sign, digits with an optional fraction
# (or a bare fraction) and an optional exponent.  This rejects Java suffixes
# ("1.5d"), "nan"/"inf" text, hex and underscores before ``try_cast`` sees them.
NUMERIC_RE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

# Characters removed from money text (comma group separators and the "đ" suffix).
MONEY_STRIP_CHARS = ",đ"
# Extra characters removed in ``mode="vnd"``: the dong sign and dot group separators.
VND_EXTRA_STRIP = "₫."


def _as_text(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


# Each parser is split into a text step (``*_text``: drop characters, trim)
# and ``guarded_double`` on that text.  ``guarded_double`` reads its input
# twice (test, then cast); applied to a column that an earlier projection has
# already computed, the text step runs once per row instead of twice - the
# clean stage parses that way (see ``souk.operators.clean.parse_fields``).


def number_text(c) -> Column:
    """Text step of ``to_number``: surrounding whitespace removed."""
    return strip_ws(_as_text(c))


def guarded_double(s) -> Column:
    """Prepared text -> double when it is a plain decimal, else NULL (no NaN)."""
    s = F.col(s) if isinstance(s, str) else s
    return F.when(s.rlike(NUMERIC_RE), s.try_cast("double"))


def to_number(c) -> Column:
    """Text (or number) -> double, NULL when the text is not a plain decimal.

    Surrounding whitespace is ignored; NaN never comes out (see NUMERIC_RE).
    """
    return guarded_double(number_text(c))


def _remove_chars(s: Column, chars: str) -> Column:
    for ch in chars:
        s = F.replace(s, F.lit(ch), F.lit(""))
    return s


def money_text(c, mode: str = "parity") -> Column:
    """Text step of ``parse_money``."""
    s = _remove_chars(_as_text(c), MONEY_STRIP_CHARS)
    if mode == "vnd":
        s = _remove_chars(s, VND_EXTRA_STRIP)
    elif mode != "parity":
        raise ValueError(f"unknown money mode {mode!r}")
    return strip_ws(s)


def parse_money(c, mode: str = "parity") -> Column:
    """Money text -> double.

    ``parity``: drop "," and "đ", then parse ("1.234.000" stays unparseable).
    ``vnd``: also drop "₫" and "." group separators, for dong amounts written
    with dot grouping.
    """
    return guarded_double(money_text(c, mode))


def percent_text(c) -> Column:
    """Text step of ``parse_percent``."""
    return strip_ws(F.replace(_as_text(c), F.lit("%"), F.lit("")))


def parse_percent(c) -> Column:
    """Percent text -> double: drop every "%", trim, parse ("10% Off" -> NULL)."""
    return guarded_double(percent_text(c))


def clip(c, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound a number to [lo, hi]; NULL stays NULL (bare least/greatest would not)."""
    c = F.col(c) if isinstance(c, str) else c
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNotNull(), out)


def to_count(c, default: int = 0) -> Column:
    """Text -> bigint, truncating toward zero; unparseable or NULL -> ``default``."""
    return count_of(to_number(c), default)


def count_of(x, default: int = 0) -> Column:
    """Parsed double -> bigint, truncating toward zero; NULL/out of range -> ``default``."""
    x = F.col(x) if isinstance(x, str) else x
    return F.coalesce(x.try_cast("bigint"), F.lit(default).cast("bigint"))


# A number whose digits are all zero, with at least one digit before any exponent.
_ZERO_TEXT_RE = r"^[+-]?(0+[.]?0*|[.]0+)([eE][+-]?[0-9]+)?$"


def is_truthy(c) -> Column:
    """Python truthiness of a payload value: NULL, '' and numeric zero are false.

    Payload numbers are landed as text, so zero written as a number ("0",
    "0.0") counts as false as well; text that is no number ("-", ".") is true.
    """
    s = _as_text(c)
    return F.coalesce((s != "") & ~s.rlike(_ZERO_TEXT_RE), F.lit(False))


def truthy(c) -> Column:
    """The value when it is truthy, else NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(is_truthy(c), c)


def first_truthy(*cols) -> Column:
    """First truthy value of the columns (Python ``a or b or ...``); NULL if none."""
    return F.coalesce(*[truthy(c) for c in cols])


def rating_trunc(c) -> Column:
    """Truncate a rating to one decimal; NULL -> 0.0 (floor(r*10)/10)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(F.coalesce(c.cast("double"), F.lit(0.0)) * 10) / F.lit(10.0)


def scaled_price(c, divisor: float = 100000.0, scale: int = 2) -> Column:
    """Price in minor units -> major units, rounded half up; NULL/0 -> 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(F.coalesce(c.cast("double"), F.lit(0.0)) / F.lit(float(divisor)), scale)


def flag_positive(c) -> Column:
    """1 when the value is > 0, else 0 (NULL counts as not positive)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce((c > 0).cast("int"), F.lit(0))
