"""DuckDB SQL for the correctness check of each registered query.

Written independently of the Spark code: plain SQL over the driver's views,
using window/aggregate forms (ROW_NUMBER, quantile_cont) where the Spark side
uses distributed operators.  Small templates keep each rule in one place.
"""

from __future__ import annotations

from souk.sources.fixture import RAW_LISTING_SQL, duckdb_sql

NUM_RE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
HOST = "https://www.lazada.vn/"
RUN_TS = "2024-01-01 00:00:00"


# Everything Unicode calls a separator, the control characters that end lines or pages, and U+0085.
_SPACE = r"[\p{Z}\x09-\x0d\x1c-\x1f\x{85}]+"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{_SPACE}', ''), '{_SPACE}$', '')"


def num(x: str) -> str:
    s = strip(f"CAST({x} AS VARCHAR)")
    return f"(CASE WHEN regexp_matches({s}, '{NUM_RE}') THEN TRY_CAST({s} AS DOUBLE) END)"


def money(x: str) -> str:
    return num(f"replace(replace(CAST({x} AS VARCHAR), ',', ''), 'đ', '')")


def money_vnd(x: str) -> str:
    return num(f"replace(replace(replace(replace(CAST({x} AS VARCHAR), ',', ''), 'đ', ''), '₫', ''), '.', '')")


def pct(x: str) -> str:
    return num(f"replace(CAST({x} AS VARCHAR), '%', '')")


def clip(x: str, lo: float, hi: float) -> str:
    return f"(CASE WHEN {x} IS NULL THEN NULL ELSE least(greatest({x}, {lo}::DOUBLE), {hi}::DOUBLE) END)"


def count(x: str) -> str:
    return f"coalesce(TRY_CAST(trunc({num(x)}) AS BIGINT), 0)"


def sold_parity(t: str) -> str:
    return (f"(TRY_CAST(NULLIF(regexp_extract(replace({t}, ',', ''), '[0-9]+', 0), '') AS BIGINT)"
            f" * CASE WHEN contains(lower({t}), 'k') THEN 1000 ELSE 1 END)")


def sold_decimal(t: str) -> str:
    return (f"CAST(floor(TRY_CAST(NULLIF(regexp_extract(replace({t}, ',', ''), '[0-9]+([.][0-9]+)?', 0), '')"
            f" AS DOUBLE) * CASE WHEN contains(lower({t}), 'k') THEN 1000 ELSE 1 END) AS BIGINT)")


def url_repair(u: str) -> str:
    return f"regexp_replace(regexp_replace({u}, '//+', '/', 'g'), '^/', '{HOST}')"


def url_repair_fixed(u: str) -> str:
    scheme = f"regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*:)?//', 0)"
    rest = f"regexp_replace(substr({u}, length({scheme}) + 1), '//+', '/', 'g')"
    return (f"(CASE WHEN {scheme} = '//' THEN 'https:' || {scheme} || {rest}"
            f" WHEN {scheme} = '' THEN regexp_replace({rest}, '^/', '{HOST}')"
            f" ELSE {scheme} || {rest} END)")


def url_norm(u: str) -> str:
    return rf"regexp_replace(regexp_replace({strip(u)}, '^https?://(www\.)?', 'https://'), '/+$', '')"


def truthy(x: str) -> str:
    s = f"CAST({x} AS VARCHAR)"
    zero = f"(regexp_matches({s}, '{NUM_RE}') AND TRY_CAST({s} AS DOUBLE) = 0)"
    return f"(CASE WHEN {s} = '' OR coalesce({zero}, false) THEN NULL ELSE {x} END)"


RAW = f"raw AS ({duckdb_sql(RAW_LISTING_SQL)})"

# Lazada crawl form: sold text trimmed ('' -> NULL) and parsed into sold_value.
LZ = f"""lz0 AS (SELECT * REPLACE (NULLIF({strip('sold_text')}, '') AS sold_text) FROM raw),
lz AS (SELECT *, {sold_parity('sold_text')} AS sold_value FROM lz0)"""

CANON = """canon AS (
  SELECT CAST(crawl_date AS VARCHAR) AS crawl_date, CAST(platform AS VARCHAR) AS platform,
         CAST(category_name AS VARCHAR) AS category_name, CAST(name AS VARCHAR) AS product_name,
         CAST(price AS VARCHAR) AS current_price, CAST(original_price AS VARCHAR) AS original_price,
         CAST(discount AS VARCHAR) AS discount_rate, CAST(rating AS VARCHAR) AS rating_average,
         CAST(review_count AS VARCHAR) AS review_count, CAST(sold_value AS VARCHAR) AS quantity_sold_value,
         CAST(sold_text AS VARCHAR) AS quantity_sold_text, CAST(brand AS VARCHAR) AS brand,
         CAST(NULL AS VARCHAR) AS seller_location, CAST(seller_name AS VARCHAR) AS seller_name,
         CAST(url AS VARCHAR) AS product_url, ord_key, ord_line, id
  FROM lz)"""

PARSED = f"""parsed AS (
  SELECT crawl_date, platform, category_name, product_name,
         {money('current_price')} AS current_price, {money('original_price')} AS original_price,
         {clip(pct('discount_rate'), 0, 100)} AS discount_rate,
         {clip(num('rating_average'), 0, 5)} AS rating_average,
         {count('review_count')} AS review_count, {count('quantity_sold_value')} AS quantity_sold_value,
         quantity_sold_text, brand, seller_location, seller_name, product_url, ord_key, ord_line, id
  FROM canon)"""

FILLED = """filled AS (
  SELECT crawl_date, platform, category_name, product_name,
         coalesce(current_price, 0::DOUBLE) AS current_price,
         coalesce(original_price, current_price, 0::DOUBLE) AS original_price,
         coalesce(discount_rate, 0::DOUBLE) AS discount_rate,
         coalesce(rating_average, 0::DOUBLE) AS rating_average,
         review_count, quantity_sold_value,
         coalesce(quantity_sold_text, '') AS quantity_sold_text,
         coalesce(brand, 'No Brand') AS brand,
         coalesce(seller_location, 'Không xác định') AS seller_location,
         coalesce(seller_name, 'Không xác định') AS seller_name,
         coalesce(product_url, '') AS product_url, ord_key, ord_line, id
  FROM parsed)"""

PREPARED = f"""prepared AS (
  SELECT TRY_CAST(crawl_date AS DATE) AS crawl_date, platform, category_name, product_name,
         current_price, original_price, discount_rate,
         CAST(discount_rate > 0 AS INTEGER) AS has_discount,
         rating_average, review_count, quantity_sold_value, quantity_sold_text,
         CAST(quantity_sold_value > 0 AS INTEGER) AS is_sold,
         brand, seller_location, seller_name, {url_repair('product_url')} AS product_url,
         TIMESTAMP '{RUN_TS}' AS clean_date, ord_key, ord_line, id
  FROM filled)"""

CLEAN_COLS = ("crawl_date, platform, category_name, product_name, current_price, original_price, "
              "discount_rate, has_discount, rating_average, review_count, quantity_sold_value, "
              "quantity_sold_text, is_sold, brand, seller_location, seller_name, product_url, clean_date")

CLEANED = f"""cleaned AS (
  SELECT {CLEAN_COLS} FROM (
    SELECT * REPLACE ({url_norm('product_url')} AS product_url) FROM prepared)
  QUALIFY row_number() OVER (PARTITION BY product_url ORDER BY crawl_date, ord_key, ord_line, id) = 1)"""

FEATURED = """featured AS (
  SELECT *, round(ln(CAST(quantity_sold_value AS DOUBLE) + 1), 4) AS sold_velocity,
         round(rating_average * ln(CAST(review_count AS DOUBLE) + 1), 4) AS rating_score,
         round(discount_rate, 2) AS discount_percent,
         round(0.7::DOUBLE * quantity_sold_value + 0.3::DOUBLE * review_count, 2) AS popularity_score
  FROM cleaned)"""

THRESH = """thresh AS (
  SELECT quantile_cont(sold_velocity, 0.80) AS p80_sold, quantile_cont(sold_velocity, 0.70) AS p70_sold,
         quantile_cont(rating_score, 0.80) AS p80_rating, quantile_cont(discount_percent, 0.85) AS p85_discount,
         quantile_cont(popularity_score, 0.80) AS p80_popularity
  FROM featured)"""

LABELED = """labeled AS (
  SELECT f.*, CASE
      WHEN f.discount_percent >= t.p85_discount THEN 'uu_dai'
      WHEN f.sold_velocity >= t.p80_sold AND f.popularity_score >= t.p80_popularity THEN 'ban_chay'
      WHEN f.sold_velocity >= t.p70_sold AND f.rating_score >= t.p80_rating THEN 'hot_trend'
      ELSE 'binh_thuong' END AS label
  FROM featured f CROSS JOIN thresh t)"""

CHAIN = [RAW, LZ, CANON, PARSED, FILLED, PREPARED, CLEANED, FEATURED, THRESH, LABELED]


STAGES = ["raw", "lz", "canon", "parsed", "filled", "prepared", "cleaned", "featured", "thresh", "labeled"]


def with_ctes(upto: str, body: str) -> str:
    """``WITH`` every stage up to and including ``upto`` (by CTE name), then ``body``."""
    return "WITH " + ",\n".join(CHAIN[: STAGES.index(upto) + 1]) + "\n" + body


def stages_after_canon(upto: str) -> str:
    """The stage CTEs that follow ``canon`` (parsed .. ``upto``), comma-joined."""
    return ",\n".join(CHAIN[STAGES.index("parsed"): STAGES.index(upto) + 1])


# ---------------------------------------------------------------- payload ingest
from souk.sources import fixture as FX  # noqa: E402
from souk.sources.categories import LAZADA_CATEGORIES, TIKI_CATEGORIES, values_sql  # noqa: E402


def _list(keys):
    return "[" + ", ".join("'" + k.replace("'", "''") + "'" for k in keys) + "]"


def _v(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def _r(x: str) -> str:
    return f"CAST(round({x}) AS BIGINT)"


def _date(platform: str) -> str:
    off = FX.PLATFORM_OFFSET[platform]
    return f"CAST(DATE '2024-01-01' + CAST((l_orderkey * 60 + {off}) // 86400 AS INTEGER) AS VARCHAR)"


TIKI_CAT_KEY = (f"CASE WHEN l_orderkey % {FX.TIKI_BUCKETS} < {len(TIKI_CATEGORIES)} THEN "
                f"{_list([k for _, k, _ in TIKI_CATEGORIES])}[l_orderkey % {FX.TIKI_BUCKETS} + 1] "
                f"ELSE 'tiki-extra-' || {_v(f'l_orderkey % {FX.TIKI_BUCKETS}')} END")
TIKI_KEY = (f"CASE WHEN l_orderkey % {FX.TIKI_BUCKETS} = {FX.TIKI_EMPTY} THEN 'tiki-extra-{FX.TIKI_EMPTY}' "
            f"ELSE {TIKI_CAT_KEY} END")
TIKI_PAGE = f"CAST((l_orderkey // {FX.TIKI_BUCKETS}) % {FX.TIKI_PAGES} + 1 AS INTEGER)"
LZ_CAT_KEY = (f"CASE WHEN l_orderkey % {FX.LAZADA_BUCKETS} < {len(LAZADA_CATEGORIES)} THEN "
              f"{_list([k for _, k in LAZADA_CATEGORIES])}[l_orderkey % {FX.LAZADA_BUCKETS} + 1] "
              f"ELSE 'lazada-extra-' || {_v(f'l_orderkey % {FX.LAZADA_BUCKETS}')} END")
LZ_KEY = (f"CASE WHEN l_orderkey % {FX.LAZADA_BUCKETS} = {FX.LAZADA_EMPTY} THEN 'lazada-extra-{FX.LAZADA_EMPTY}' "
          f"ELSE {LZ_CAT_KEY} END")
LZ_PAGE = f"CAST((l_orderkey // {FX.LAZADA_BUCKETS}) % {FX.LAZADA_PAGES} + 1 AS INTEGER)"
SP_PAGE = f"CAST((l_orderkey // {FX.SHOPEE_PAGE_DIV}) % {FX.SHOPEE_PAGES} + 1 AS INTEGER)"
LZ_HTML = f"l_orderkey % {FX.LAZADA_HTML_MOD} = {FX.LAZADA_HTML_REM}"
LZ_BAD = f"l_orderkey % {FX.LAZADA_BAD_MOD} = {FX.LAZADA_BAD_REM}"
POS = (f"CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(FX.ITEM_ORDER)}) - 1 AS INTEGER)"
       " AS item_pos")

ING = f"""base AS (SELECT * FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
                  JOIN supplier s ON l.l_suppkey = s.s_suppkey),
dim AS (SELECT * FROM {values_sql()}),
tiki_items AS (SELECT *, {POS} FROM base WHERE l_suppkey % 3 = 1),
tiki_rows0 AS (
  SELECT {_date('Tiki')} AS crawl_date, 'Tiki' AS platform, {_v('l_partkey')} AS id, p_name AS name,
    {_v(_r('l_extendedprice'))} AS price,
    CASE WHEN l_linenumber = 2 THEN {_v(_r('p_retailprice * 1000'))} ELSE {_v(_r('p_retailprice * 1100'))} END
      AS original_price,
    {_v(_r('l_discount * 100'))} AS discount_rate,
    {_v('CAST(p_size % 50 AS DOUBLE) / 10')} AS rating_average,
    {_v('(l_orderkey * 31 + l_linenumber) % 1200')} AS review_count,
    CASE WHEN l_linenumber = 5 THEN NULL ELSE {_v(_r('l_quantity * 10'))} END AS quantity_sold_value,
    CASE WHEN l_linenumber = 5 THEN NULL ELSE 'Đã bán ' || {_v(_r('l_quantity * 10'))} END AS quantity_sold_text,
    CASE WHEN l_linenumber = 3 THEN NULL ELSE p_brand END AS brand, s_name AS seller_name,
    'https://img.example/' || {_v('p_partkey')} || '.jpg' AS thumbnail_url,
    'https://tiki.vn' || CASE WHEN l_linenumber = 4 THEN '' ELSE
      '/p' || {_v('p_partkey')} || '-s' || {_v('l_suppkey')} || '.html' END AS url,
    CASE WHEN l_linenumber % 3 = 0 THEN 'Freeship, ' || p_brand ELSE '' END AS badges,
    {TIKI_KEY} AS url_key, {TIKI_PAGE} AS page, item_pos, l_orderkey AS o
  FROM tiki_items),
tiki_rows AS (SELECT t.*, d.category_name FROM tiki_rows0 t LEFT JOIN dim d
              ON d.platform = t.platform AND d.url_key = t.url_key),
lz_items AS (SELECT *, {POS} FROM base WHERE l_suppkey % 3 = 0),
lz_rows0 AS (
  SELECT {_date('Lazada')} AS crawl_date, 'Lazada' AS platform, {_v('l_partkey * 1000 + l_suppkey')} AS id,
    p_brand || ' ' || p_name AS name,
    CASE WHEN l_linenumber % 3 = 0 THEN {_v(_r('l_extendedprice'))} ELSE {_v(_r('l_extendedprice'))} || 'đ' END
      AS price,
    {_v(_r('p_retailprice * 1100'))} AS original_price,
    '-' || {_v(_r('l_discount * 100'))} || '%' AS discount,
    {_v('CAST((p_partkey * 7 + l_suppkey) % 51 AS DOUBLE) / 10')} AS rating,
    {_v('(l_orderkey * 31 + l_linenumber) % 1200')} AS review_count,
    CASE l_linenumber % 4 WHEN 0 THEN {_r('l_quantity')} * 1000 WHEN 1 THEN {_r('l_quantity')} END AS sold_value,
    CASE l_linenumber % 4 WHEN 0 THEN {_v(_r('l_quantity'))} || '.' || {_v('l_linenumber')} || 'k sold'
                          WHEN 1 THEN {_v(_r('l_quantity'))} || ' sold' END AS sold_text,
    p_brand AS brand, 'Kho ' || {_v('s_nationkey')} AS location, s_name AS seller_name,
    CASE WHEN l_linenumber = 6 THEN NULL ELSE 'https://www.lazada.vn//www.lazada.vn/products/i'
      || {_v('p_partkey')} || '-s' || {_v('l_suppkey')} || '.html' END AS url,
    'https://img.example/lz/' || {_v('p_partkey')} || '.jpg' AS image,
    {LZ_KEY} AS url_key, {LZ_PAGE} AS page, item_pos, l_orderkey AS o
  FROM lz_items),
lz_rows AS (SELECT t.*, d.category_name FROM lz_rows0 t LEFT JOIN dim d
            ON d.platform = t.platform AND d.url_key = t.url_key),
sp_items AS (SELECT *, {POS} FROM base WHERE l_suppkey % 3 = 2),
sp_rows AS (
  SELECT {_v('l_partkey')} AS itemid, {_v('l_suppkey')} AS shopid,
    CASE WHEN l_linenumber = 4 THEN 'N/A' ELSE p_name END AS name,
    round(({_r('l_extendedprice * 100000')} + CASE WHEN l_linenumber = 1 THEN 0.5 ELSE 0 END)::DOUBLE / 100000, 2) AS price,
    {_r('l_quantity * 37')} AS historical_sold, CAST(l_orderkey % 500 AS BIGINT) AS liked_count,
    floor(coalesce(p_retailprice / 400, 0) * 10) / 10 AS rating_star,
    CASE WHEN l_linenumber = 3 THEN '' ELSE {_v(_r('l_discount * 100'))} || '%' END AS discount,
    'Kho ' || {_v('s_nationkey')} AS location,
    CASE WHEN l_linenumber = 2 THEN '' ELSE 'https://down-vn.img.susercontent.com/file/img' || {_v('p_partkey')} END
      AS image,
    'https://shopee.vn/product/' || {_v('l_suppkey')} || '/' || {_v('l_partkey')} AS url,
    '{FX.SHOPEE_KEY}' AS url_key, {SP_PAGE} AS page, item_pos, l_orderkey AS o,
    {_date('Shopee')} AS crawl_date
  FROM sp_items WHERE l_linenumber NOT IN (6, 7) AND l_partkey <> 0 AND l_suppkey <> 0),
lz_orders AS (SELECT DISTINCT l_orderkey FROM base WHERE l_suppkey % 3 = 0),
pay AS (
  SELECT DISTINCT 'Tiki' AS platform, {TIKI_KEY} AS url_key, {TIKI_PAGE} AS page, l_orderkey FROM base
    WHERE l_suppkey % 3 = 1
  UNION ALL SELECT DISTINCT 'Tiki', {TIKI_CAT_KEY}, {TIKI_PAGE}, l_orderkey FROM base
    WHERE l_suppkey % 3 = 1 AND l_orderkey % {FX.TIKI_BUCKETS} = {FX.TIKI_EMPTY}
  UNION ALL SELECT 'Lazada', {LZ_KEY}, {LZ_PAGE}, l_orderkey FROM lz_orders
  UNION ALL SELECT 'Lazada', {LZ_CAT_KEY}, {LZ_PAGE}, l_orderkey FROM lz_orders
    WHERE l_orderkey % {FX.LAZADA_BUCKETS} = {FX.LAZADA_EMPTY}
  UNION ALL SELECT 'Lazada', {LZ_KEY}, {LZ_PAGE}, l_orderkey FROM lz_orders WHERE {LZ_HTML}
  UNION ALL SELECT 'Lazada', {LZ_KEY}, {LZ_PAGE}, l_orderkey FROM lz_orders WHERE {LZ_BAD}
  UNION ALL SELECT DISTINCT 'Tiki', {TIKI_KEY}, {TIKI_PAGE}, l_orderkey FROM base WHERE l_suppkey % 3 = 1 AND l_orderkey % {FX.TIKI_TEXT_MOD} = 1
  UNION ALL SELECT DISTINCT 'Tiki', {TIKI_KEY}, {TIKI_PAGE}, l_orderkey FROM base WHERE l_suppkey % 3 = 1 AND l_orderkey % {FX.TIKI_OBJECT_MOD} = 1
  UNION ALL SELECT 'Lazada', {LZ_KEY}, {LZ_PAGE}, l_orderkey FROM lz_orders WHERE l_orderkey % {FX.TRAILING_MOD} = 1
  UNION ALL SELECT 'Lazada', {LZ_KEY}, {LZ_PAGE}, l_orderkey FROM lz_orders WHERE l_orderkey % {FX.SECOND_MOD} BETWEEN 1 AND 4
  UNION ALL SELECT DISTINCT 'Shopee', '{FX.SHOPEE_KEY}', {SP_PAGE}, l_orderkey FROM base WHERE l_suppkey % 3 = 2
  UNION ALL SELECT DISTINCT 'Shopee', '{FX.SHOPEE_KEY}', {SP_PAGE}, l_orderkey FROM base WHERE l_suppkey % 3 = 2 AND l_orderkey % {FX.SHOPEE_OBJECT_MOD} = 1)
"""


def ingest_sql(body: str) -> str:
    return "WITH " + ING + body


# canonical rows of the merged payload ingest, ordered by fetch time and position
_SP_OFF = FX.PLATFORM_OFFSET["Shopee"]
_TK_OFF = FX.PLATFORM_OFFSET["Tiki"]
_LZ_OFF = FX.PLATFORM_OFFSET["Lazada"]
CANON_INGEST = f"""canon AS (
  SELECT crawl_date, platform, category_name, name AS product_name, price AS current_price, original_price,
    discount_rate, rating_average, review_count, quantity_sold_value, quantity_sold_text, brand,
    CAST(NULL AS VARCHAR) AS seller_location, seller_name, url AS product_url,
    o * 60 + {_TK_OFF} AS ord_key, item_pos AS ord_line, '' AS id FROM tiki_rows
  UNION ALL
  SELECT crawl_date, platform, category_name, name, price, original_price, discount, rating, review_count,
    {_v('sold_value')}, sold_text, brand, location, seller_name, url, o * 60 + {_LZ_OFF}, item_pos, '' FROM lz_rows
  UNION ALL
  SELECT crawl_date, 'Shopee', NULL, name, {_v('price')}, NULL, discount, {_v('rating_star')}, NULL,
    {_v('historical_sold')}, NULL, NULL, location, NULL, url, o * 60 + {_SP_OFF}, item_pos, '' FROM sp_rows)"""


def ingest_chain(upto: str, body: str) -> str:
    return "WITH " + ING + ", " + CANON_INGEST + ",\n" + stages_after_canon(upto) + "\n" + body
