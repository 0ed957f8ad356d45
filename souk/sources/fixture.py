"""Stand-in inputs built from the driver's test tables.

The test data has no listing table, so raw listings are derived from
lineitem x part x supplier with one SQL text that Spark and DuckDB both run
(``{lineitem}`` etc. are placeholders).  Each lineitem row is one observation
of a (part, supplier) offer.  This code only shapes rows into the raw listing
schema; all parsing, cleaning and de-duplication is done by the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

RAW_LISTING_SQL = """
SELECT
  substr(cast(l.l_shipdate AS varchar(32)),1,10) AS crawl_date,
  CASE l.l_suppkey % 3 WHEN 0 THEN 'Lazada' WHEN 1 THEN 'Tiki' ELSE 'Shopee' END AS platform,
  p.p_type AS category_name,
  concat(cast(l.l_partkey AS varchar(20)),'-',cast(l.l_suppkey AS varchar(20))) AS id,
  concat(p.p_brand,' ',p.p_name) AS name,
  CASE WHEN l.l_orderkey % 97 = 0 THEN cast(cast(round(l.l_extendedprice*1000) AS bigint) AS varchar(20)) ELSE CASE l.l_orderkey % 7
    WHEN 0 THEN concat(substr(cast(cast(round(p.p_retailprice*1000) AS bigint) AS varchar(20)),1,3),',',substr(cast(cast(round(p.p_retailprice*1000) AS bigint) AS varchar(20)),4,3))
    WHEN 1 THEN concat(cast(cast(round(p.p_retailprice*1000) AS bigint) AS varchar(20)),'đ')
    WHEN 2 THEN 'N/A'
    WHEN 3 THEN NULL
    ELSE cast(cast(round(l.l_extendedprice) AS bigint) AS varchar(20)) END END AS price,
  CASE WHEN l.l_orderkey % 5 = 0 THEN NULL WHEN l.l_orderkey % 31 = 0 THEN '-' ELSE cast(cast(round(p.p_retailprice*1100) AS bigint) AS varchar(20)) END AS original_price,
  CASE WHEN l.l_orderkey % 11 = 0 THEN '-5%' WHEN l.l_orderkey % 13 = 0 THEN '150%' WHEN l.l_orderkey % 17 = 0 THEN '10% Off'
       WHEN l.l_orderkey % 23 = 0 THEN concat(chr(160),'10%',chr(160))
       ELSE concat(' ',cast(cast(round(l.l_discount*100) AS bigint)*(l.l_orderkey % 9) AS varchar(20)),'% ') END AS discount,
  CASE WHEN l.l_partkey % 10 = 0 THEN NULL ELSE cast((l.l_partkey*7 + l.l_suppkey) % 58 AS double)/10 END AS rating,
  CASE WHEN l.l_orderkey % 6 = 0 THEN NULL WHEN l.l_orderkey % 89 = 0 THEN cast(900000000 + l.l_orderkey AS varchar(20))
       ELSE cast((l.l_orderkey*31 + l.l_linenumber) % 1200 AS varchar(20)) END AS review_count,
  CASE l.l_linenumber % 4 WHEN 0 THEN concat('Da ban ',cast(cast(l.l_quantity AS bigint) AS varchar(20)),'k+')
       WHEN 1 THEN concat(cast(cast(l.l_quantity AS bigint) AS varchar(20)),' sold')
       WHEN 2 THEN concat('1,',cast(cast(l.l_quantity AS bigint)+100 AS varchar(20)),' sold') ELSE NULL END AS sold_text,
  CASE WHEN l.l_orderkey % 8 = 0 THEN NULL ELSE p.p_brand END AS brand,
  s.s_name AS seller_name,
  CASE WHEN l.l_orderkey % 19 = 0 THEN NULL
       WHEN l.l_orderkey % 2 = 0 THEN concat('//www.shop.example//p/',cast(l.l_partkey AS varchar(20)),'-',cast(l.l_suppkey AS varchar(20)),'/')
       ELSE concat('/p/',cast(l.l_partkey AS varchar(20)),'-',cast(l.l_suppkey AS varchar(20))) END AS url,
  l.l_orderkey AS ord_key, l.l_linenumber AS ord_line
FROM {lineitem} l JOIN {part} p ON l.l_partkey=p.p_partkey JOIN {supplier} s ON l.l_suppkey=s.s_suppkey
"""

# Input order of the raw listings (unique per row): the keep-first survivor.
RAW_ORDER = ["crawl_date", "ord_key", "ord_line", "id"]


# The test tables are one file of one row group each: a fact table read in few
# splits is dealt out by its key, as a table of many files would arrive.
FACT_KEYS = {"lineitem": ["l_orderkey"]}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if name in FACT_KEYS and df.rdd.getNumPartitions() < 2 * spark.sparkContext.defaultParallelism:
        df = df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *FACT_KEYS[name])
    return df


def duckdb_sql(text: str) -> str:
    """The same text with placeholders resolved to the DuckDB views."""
    for t in TABLES:
        text = text.replace("{" + t + "}", t)
    return text


def raw_listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw marketplace listing rows (crawler field names, text values)."""
    return spark.sql(RAW_LISTING_SQL, lineitem=table(spark, sf_dir, "lineitem"),
                     part=table(spark, sf_dir, "part"), supplier=table(spark, sf_dir, "supplier"))


# ---------------------------------------------------------------- payload landing
#
# One landing row per (order, platform): a fetched page whose items are that
# order's lineitems for the platform (at most 7, in ITEM_ORDER), so no payload
# grows with the data.  Rules below decide page layout and edge cases; the oracle SQL states
# the rows the flatteners must recover from them.

EPOCH_DATE = "2024-01-01"
PLATFORM_OFFSET = {"Tiki": 0, "Lazada": 20, "Shopee": 40}
TIKI_BUCKETS, TIKI_EMPTY, TIKI_PAGES = 29, 5, 23
LAZADA_BUCKETS, LAZADA_EMPTY, LAZADA_PAGES = 23, 9, 23
LAZADA_HTML_MOD, LAZADA_HTML_REM = 37, 3
LAZADA_BAD_MOD, LAZADA_BAD_REM = 41, 4
SHOPEE_KEY, SHOPEE_PAGE_DIV, SHOPEE_PAGES = "may-anh", 7, 30
ODD_MOD, ODD_REM = 8, 3  # pages whose item array also holds text, a number, NULL (and, for Tiki, {})
TIKI_TEXT_MOD, TIKI_OBJECT_MOD, SHOPEE_OBJECT_MOD, TRAILING_MOD = 43, 47, 53, 59  # extra pages that hold no list, or more than an object
SECOND_MOD = 61  # extra pages with a second object, a bracket or text that ends in "}" behind the first
TIKI_TEXT_BODY = '{"listings":"blocked"}'
TIKI_OBJECT_BODY = '{"listings":{"id":1}}'
SHOPEE_OBJECT_BODY = '{"items":{"itemid":1}}'
HTML_BODY = "<html><body>Traffic Error</body></html>"
TIKI_EMPTY_BODY = '{"listings":[],"data":[]}'
LAZADA_EMPTY_BODY = '{"mods":{"listItems":[]}}'


# Order of items inside a page: every lineitem field an item is built from, so
# two items tie only when they are identical.
ITEM_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount"]


# Tasks that write payloads for a split of lineitems: their rows grow to many times their length, and are sorted.
PAGE_TASKS = 8
# What items are built from, besides the columns of ITEM_ORDER.
ITEM_PARTS = ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice", "s_name", "s_nationkey"]


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns items are built from, an order's rows in one task: they are shuffled before their payloads are
    written out, which are many times as long."""
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    pa = table(spark, sf_dir, "part")
    su = table(spark, sf_dir, "supplier")
    rows = li.join(pa, li.l_partkey == pa.p_partkey).join(su, li.l_suppkey == su.s_suppkey)
    return rows.select("l_orderkey", *ITEM_ORDER, *ITEM_PARTS).repartition(PAGE_TASKS * li.rdd.getNumPartitions(), "l_orderkey")


def _payload_items(base: DataFrame, platform_rem: int, item) -> DataFrame:
    from pyspark.sql import functions as F
    return (base.where(F.col("l_suppkey") % 3 == platform_rem)
            .groupBy("l_orderkey")
            .agg(F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in ITEM_ORDER], item.alias("it"))))
                 .alias("arr"))
            .select("l_orderkey", F.transform("arr", lambda x: x["it"]).alias("items")))


def _stamp(platform: str):
    """Fetch time 2024-01-01 00:00 + (orderkey minutes + platform offset seconds),
    built from calendar fields so it reads the same in every session time zone."""
    from pyspark.sql import functions as F
    secs = F.col("l_orderkey") * 60 + PLATFORM_OFFSET[platform]
    day = F.date_add(F.lit(EPOCH_DATE).cast("date"), (secs / 86400).cast("int"))
    sod = secs % 86400
    return F.make_timestamp(F.year(day), F.month(day), F.dayofmonth(day), (sod / 3600).cast("int"),
                            ((sod % 3600) / 60).cast("int"), (sod % 60).cast("decimal(16,6)"))


def _keyed(bucket, keys: list[str], extra_prefix: str):
    from pyspark.sql import functions as F
    arr = F.array(*[F.lit(k) for k in keys])
    return F.when(bucket < len(keys), F.element_at(arr, (bucket + 1).cast("int"))).otherwise(
        F.concat(F.lit(extra_prefix), bucket.cast("string")))


def _plain(body):
    """Text fields written as "@...@" become bare JSON values (a number where others have text, and so on)."""
    from pyspark.sql import functions as F
    return F.regexp_replace(body, '"@([^@"]*)@"', "$1")


def _pages(df: DataFrame, *extra) -> DataFrame:
    """Every row as page 0, and again as page 1, 2, ... where that condition holds (column ``_page``)."""
    from pyspark.sql import functions as F
    which = F.array(F.lit(0), *[F.when(cond, F.lit(k)) for k, cond in enumerate(extra, 1)])
    return df.select("*", F.explode_outer(which).alias("_page")).where(F.col("_page").isNotNull())


def _by_page(first, *extra):
    """The value of ``_page`` 0, 1, 2, ..."""
    from pyspark.sql import functions as F
    value = F.when(F.col("_page") == 0, first)
    for k, v in enumerate(extra, 1):
        value = value.when(F.col("_page") == k, v)
    return value


def _odd(body, key: str, odd: str):
    """On some pages the item array starts with elements that are no items."""
    from pyspark.sql import functions as F
    return F.when(F.col("l_orderkey") % ODD_MOD == ODD_REM, F.replace(body, F.lit(f'"{key}":[{{'), F.lit(f'"{key}":[{odd},{{'))).otherwise(body)


def landing_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing table ``platform, url_key, page, fetched_at, body`` of JSON pages."""
    from pyspark.sql import functions as F

    from souk.sources.categories import LAZADA_CATEGORIES, TIKI_CATEGORIES

    b = _base(spark, sf_dir)
    o, ln = F.col("l_orderkey"), F.col("l_linenumber")
    rnd = lambda c: F.round(c).cast("bigint")
    s = lambda c: c.cast("string")

    tiki_item = F.struct(
        F.col("l_partkey").alias("id"), F.col("p_name").alias("name"),
        rnd(F.col("l_extendedprice")).alias("price"),
        F.when(ln == 2, F.lit(0).cast("bigint")).otherwise(rnd(F.col("p_retailprice") * 1100)).alias("list_price"),
        rnd(F.col("p_retailprice") * 1000).alias("original_price"),
        rnd(F.col("l_discount") * 100).alias("discount_rate"),
        ((F.col("p_size") % 50).cast("double") / 10).alias("rating_average"),
        ((o * 31 + ln) % 1200).alias("review_count"),
        F.when(ln != 5, F.struct(s(rnd(F.col("l_quantity") * 10)).alias("value"),
                                 F.concat(F.lit("Đã bán "), s(rnd(F.col("l_quantity") * 10))).alias("text"))
               ).otherwise(F.struct(F.lit(None).cast("string").alias("value"), F.lit("scalar").alias("text"))).alias("quantity_sold"),
        F.when(ln != 3, F.struct(F.col("p_brand").alias("name"))).alias("brand"),
        F.struct(F.col("s_name").alias("name")).alias("current_seller"),
        F.when(ln % 3 == 0, F.array(F.struct(F.lit("Freeship").alias("text")),
                                    F.struct(F.col("p_brand").alias("text"))))
         .when(ln % 3 == 1, F.array(F.struct(F.lit(None).cast("string").alias("text")),
                                    F.struct(F.lit("").alias("text")))).alias("badges"),
        F.concat(F.lit("https://img.example/"), s(F.col("p_partkey")), F.lit(".jpg")).alias("thumbnail_url"),
        F.when(ln != 4, F.concat(F.lit("/p"), s(F.col("p_partkey")), F.lit("-s"), s(F.col("l_suppkey")),
                                 F.lit(".html"))).alias("url_path"),
    )
    tk = _payload_items(b, 1, tiki_item)
    tb = o % TIKI_BUCKETS
    tiki_keys = [k for _, k, _ in TIKI_CATEGORIES]
    tiki_page = F.expr(f"CAST((l_orderkey div {TIKI_BUCKETS}) % {TIKI_PAGES} + 1 AS INT)")
    items, body = F.col("items"), F.col("body")
    # one projection a step: a step that reads the body twice does not write it twice
    tk = tk.withColumn("items", F.when(o % 6 == 1, F.array_append(items, F.lit(None))).otherwise(items))
    tk = tk.withColumn("body", F.when(o % 4 == 0, F.to_json(F.struct(F.slice(items, 1, 0).alias("listings"), items.alias("data")))
                                      ).otherwise(F.to_json(F.struct(items.alias("listings")))))
    # a bare number where others have an object
    tk = tk.withColumn("body", F.replace(body, F.lit('"quantity_sold":{"text":"scalar"}'), F.lit('"quantity_sold":7')))
    for key in ("listings", "data"):
        tk = tk.withColumn("body", _odd(body, key, '"junk",{},null,7'))
    # items of the TIKI_EMPTY bucket are filed under an unknown key; their
    # category only ever returns empty pages (no item is left out)
    tiki_item_key = F.when(tb == TIKI_EMPTY, F.concat(F.lit("tiki-extra-"), tb.cast("string"))).otherwise(
        _keyed(tb, tiki_keys, "tiki-extra-"))
    tiki = _pages(tk.drop("items"), tb == TIKI_EMPTY, o % TIKI_TEXT_MOD == 1, o % TIKI_OBJECT_MOD == 1).select(
        F.lit("Tiki").alias("platform"),
        _by_page(tiki_item_key, _keyed(tb, tiki_keys, "tiki-extra-"), tiki_item_key, tiki_item_key).alias("url_key"),
        tiki_page.alias("page"), _stamp("Tiki").alias("fetched_at"),
        _by_page(body, F.lit(TIKI_EMPTY_BODY), F.lit(TIKI_TEXT_BODY), F.lit(TIKI_OBJECT_BODY)).alias("body"))

    q = rnd(F.col("l_quantity"))
    lazada_item = F.struct(
        (F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("itemId"),
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name")).alias("name"),
        F.when(ln % 3 == 0, F.lit("")).otherwise(F.concat(s(rnd(F.col("l_extendedprice"))), F.lit("đ"))
                                                  ).alias("priceShow"),
        rnd(F.col("l_extendedprice")).alias("price"),
        rnd(F.col("p_retailprice") * 1100).alias("originalPrice"),
        F.concat(F.lit("-"), s(rnd(F.col("l_discount") * 100)), F.lit("%")).alias("discount"),
        (((F.col("p_partkey") * 7 + F.col("l_suppkey")) % 51).cast("double") / 10).alias("ratingScore"),
        ((o * 31 + ln) % 1200).alias("review"),
        F.when(ln % 4 == 0, F.concat(F.lit(" "), s(q), F.lit("."), s(ln), F.lit("k sold ")))
         .when(ln % 4 == 1, F.concat(s(q), F.lit(" sold")))
         .when(ln % 4 == 2, F.lit("")).alias("itemSoldCntShow"),
        F.col("p_brand").alias("brandName"),
        F.concat(F.lit("Kho "), s(F.col("s_nationkey"))).alias("location"),
        F.col("s_name").alias("sellerName"),
        F.when(ln != 6, F.concat(F.lit("//www.lazada.vn/products/i"), s(F.col("p_partkey")), F.lit("-s"),
                                 s(F.col("l_suppkey")), F.lit(".html"))).alias("itemUrl"),
        F.concat(F.lit("https://img.example/lz/"), s(F.col("p_partkey")), F.lit(".jpg")).alias("image"),
    )
    lz = _payload_items(b, 0, lazada_item)
    lb = o % LAZADA_BUCKETS
    lazada_keys = [k for _, k in LAZADA_CATEGORIES]
    lazada_page = F.expr(f"CAST((l_orderkey div {LAZADA_BUCKETS}) % {LAZADA_PAGES} + 1 AS INT)")
    lz = lz.withColumn("body", F.to_json(F.struct(F.struct(items.alias("listItems")).alias("mods"))))
    lz = lz.withColumn("body", _odd(body, "listItems", '"junk",null,7'))
    lazada_item_key = F.when(lb == LAZADA_EMPTY, F.concat(F.lit("lazada-extra-"), lb.cast("string"))).otherwise(
        _keyed(lb, lazada_keys, "lazada-extra-"))

    # every page arrives once intact; some fetches also failed before the retry
    # (an HTML block page, a truncated body) and some categories only return
    # empty pages - those come as extra landing rows
    behind = (F.concat(F.lit(" "), body), F.concat(F.lit(", "), body), F.lit(" x}"), F.concat(F.lit("], ["), body))
    lazada = _pages(lz.drop("items"), lb == LAZADA_EMPTY, o % LAZADA_HTML_MOD == LAZADA_HTML_REM, o % LAZADA_BAD_MOD == LAZADA_BAD_REM,
                    o % TRAILING_MOD == 1, *[o % SECOND_MOD == k for k in range(1, len(behind) + 1)]).select(
        F.lit("Lazada").alias("platform"),
        F.when(F.col("_page") == 1, _keyed(lb, lazada_keys, "lazada-extra-")).otherwise(lazada_item_key).alias("url_key"),
        lazada_page.alias("page"), _stamp("Lazada").alias("fetched_at"),
        _by_page(body, F.lit(LAZADA_EMPTY_BODY), F.lit(HTML_BODY), F.regexp_replace(body, "}$", ""), F.concat(body, F.lit(" <html>")),
                 *[F.concat(body, x) for x in behind]).alias("body"))

    wrap = (o + ln) % 2 == 0
    basic_fields = [
        F.when(ln == 6, F.lit(0).cast("bigint")).when(ln != 5, F.col("l_partkey")).alias("itemid"),
        F.when(ln == 5, F.col("l_partkey")).alias("item_id"),
        F.when(ln != 7, F.col("l_suppkey")).alias("shopid"),
        F.when(ln != 4, F.col("p_name")).alias("name"),
        # a price with a fraction, counts and ratings in quotes on some items
        F.concat(F.lit("@"), s(rnd(F.col("l_extendedprice") * 100000)), F.when(ln == 1, F.lit(".5")).otherwise(F.lit("")), F.lit("@")).alias("price"),
        F.when(ln == 2, s(rnd(F.col("l_quantity") * 37))).otherwise(
            F.concat(F.lit("@"), s(rnd(F.col("l_quantity") * 37)), F.lit("@"))).alias("historical_sold"),
        (o % 500).alias("liked_count"),
        F.struct(F.when(ln == 1, s(F.col("p_retailprice") / 400)).otherwise(
            F.concat(F.lit("@"), s(F.col("p_retailprice") / 400), F.lit("@"))).alias("rating_star")).alias("item_rating"),
        F.when(ln != 3, F.concat(s(rnd(F.col("l_discount") * 100)), F.lit("%"))).alias("discount"),
        F.concat(F.lit("Kho "), s(F.col("s_nationkey"))).alias("shop_location"),
        F.when(ln != 2, F.concat(F.lit("img"), s(F.col("p_partkey")))).alias("image"),
    ]
    names = ["itemid", "item_id", "shopid", "name", "price", "historical_sold", "liked_count",
             "item_rating", "discount", "shop_location", "image"]
    basic = F.struct(*basic_fields)
    shopee_item = F.struct(F.when(wrap, basic).alias("item_basic"),
                           *[F.when(~wrap, f).alias(n) for f, n in zip(basic_fields, names)])
    sp = _payload_items(b, 2, shopee_item)
    sp = sp.withColumn("body", F.when(o % 3 == 0, F.to_json(F.struct(F.struct(items.alias("items")).alias("data")))
                                      ).otherwise(F.to_json(F.struct(items.alias("items")))))
    sp = sp.withColumn("body", _plain(body))
    sp = sp.withColumn("body", _odd(body, "items", '"junk",null,7'))
    shopee = _pages(sp.drop("items"), o % SHOPEE_OBJECT_MOD == 1).select(
        F.lit("Shopee").alias("platform"), F.lit(SHOPEE_KEY).alias("url_key"),
        F.expr(f"CAST((l_orderkey div {SHOPEE_PAGE_DIV}) % {SHOPEE_PAGES} + 1 AS INT)").alias("page"),
        _stamp("Shopee").alias("fetched_at"), _by_page(body, F.lit(SHOPEE_OBJECT_BODY)).alias("body"))
    return tiki.unionByName(lazada).unionByName(shopee)
