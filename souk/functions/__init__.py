"""Column functions: every helper returns a native Spark ``Column``."""

from souk.functions.numbers import (  # noqa: F401
    NUMERIC_RE,
    clip,
    first_truthy,
    flag_positive,
    is_truthy,
    parse_money,
    parse_percent,
    rating_trunc,
    scaled_price,
    to_count,
    to_number,
    truthy,
)
from souk.functions.text import (  # noqa: F401
    DEFAULT_HOST,
    nullif_empty,
    safe_name,
    sold_text_count,
    strip_ws,
    url_key,
    url_normalize,
    url_repair,
)
