"""Marketplace API payloads -> flat raw listing rows (Tiki, Lazada, Shopee).

Input is a landing table, one row per fetched page:
``platform, url_key, page, fetched_at, body`` (body = response text).  The
item array is read as an array of raw JSON texts and exploded; then each element
that is an object is parsed on its own, all its values as text.  So an odd
element (text, number, null) costs that element and not the page, and an odd
type (a price with decimals, a rating in quotes) is not turned into NULL.  The
plan is narrow: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.functions.numbers import first_truthy, is_truthy, rating_trunc, scaled_price, to_count, to_number
from souk.functions.text import nullif_empty, sold_text_count, strip_ws

# Link prefixes the platforms' item paths are joined to.
TIKI_HOST = "https://tiki.vn"
LAZADA_HOST = "https://www.lazada.vn"
SHOPEE_IMAGE_PREFIX = "https://down-vn.img.susercontent.com/file/"
SHOPEE_PRODUCT_PREFIX = "https://shopee.vn/product/"
SHOPEE_MISSING_TEXT = "N/A"

LANDING_DDL = "platform STRING, url_key STRING, page INT, fetched_at TIMESTAMP, body STRING"

# Payload field names.  Every value is read as text.
TIKI_ITEM = ("id STRING, name STRING, price STRING, list_price STRING, original_price STRING, discount_rate STRING, "
             "rating_average STRING, review_count STRING, quantity_sold STRUCT<value:STRING,text:STRING>, "
             "brand STRUCT<name:STRING>, current_seller STRUCT<name:STRING>, badges ARRAY<STRUCT<text:STRING>>, "
             "thumbnail_url STRING, url_path STRING")
LAZADA_ITEM = ("itemId STRING, name STRING, priceShow STRING, price STRING, originalPriceShow STRING, originalPrice STRING, "
               "discount STRING, ratingScore STRING, review STRING, itemSoldCntShow STRING, brandName STRING, "
               "location STRING, sellerName STRING, itemUrl STRING, image STRING")
SHOPEE_ITEM = ("itemid STRING, item_id STRING, shopid STRING, shop_id STRING, name STRING, price STRING, "
               "historical_sold STRING, liked_count STRING, item_rating STRUCT<rating_star:STRING>, discount STRING, "
               "shop_location STRING, image STRING")
# Where the payloads hold their items.
PLACES = "listings STRING, data STRING, mods STRING, items STRING"
TOP = f"{PLACES}, _corrupt_record STRING"

LINEAGE = ["url_key", "page", "fetched_at", "item_pos"]


def _given(text: Column) -> Column:
    """Whether a JSON value read as text is truthy (not missing, null, false, 0 or empty)."""
    return F.coalesce(~text.rlike(r"^\s*(null|false|0|\[\s*\]|\{\s*\})?\s*$"), F.lit(False))


def _settled(df: DataFrame, *names: str) -> DataFrame:
    """The same rows, with the named columns behind a generator of one row each.

    Spark pushes a filter through projections by putting the columns' expressions
    in their place, once per mention; it does not push one that reads a generator's
    output.  So what is parsed once stays parsed once.
    """
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.inline_outer(F.array(F.struct(*names))))


def _with_whole_object(landing: DataFrame) -> DataFrame:
    """Adds ``_top``: the body's fields if it is one JSON object and nothing else, else NULL.

    The body is read as the first of two elements of an array; the second holds a
    mark made from the body.  Anything behind the object (a second object, text,
    a bracket that ends the array early) leaves another number of elements, or
    no mark in second place.
    """
    body, both, mark = F.col("body"), F.col("_both"), F.col("_mark")
    df = landing.withColumn("_mark", F.xxhash64(body).cast("string"))
    df = df.withColumn("_both", F.from_json(F.concat(F.lit("["), body, F.lit(',{"_end":"'), mark, F.lit('"}]')),
                                            f"ARRAY<STRUCT<{PLACES.replace(' STRING', ':STRING')}, _end:STRING>>", {"allowSingleQuotes": "false"}))
    whole = (F.size(both) == 2) & (F.get(both, F.lit(1))["_end"] == mark)
    return df.withColumn("_top", F.when(whole, F.get(both, F.lit(0)))).drop("_mark", "_both")


def _with_items(landing: DataFrame) -> DataFrame:
    """Adds ``_items`` (the value at the platform's place for items, as JSON text), ``_holder`` (what it stands in)
    and ``_broken`` (the body is not one whole JSON object; such a body has no items).

    Tiki: ``listings``, or ``data`` when that is missing or empty.  Lazada:
    ``mods.listItems``.  Shopee: ``items``, or ``data.items``.
    """
    df = _with_whole_object(landing)
    top = F.col("_top")
    platform = F.col("platform")
    df = df.withColumn("_holder", F.when(platform == "Lazada", top["mods"]).when((platform == "Shopee") & ~_given(top["items"]), top["data"]))
    df = df.withColumn("_inner", F.from_json("_holder", "listItems STRING, items STRING"))
    inner = F.col("_inner")
    items = (F.when(platform == "Tiki", F.when(_given(top["listings"]), top["listings"]).otherwise(top["data"]))
             .when(platform == "Lazada", inner["listItems"])
             .when(platform == "Shopee", F.when(_given(top["items"]), top["items"]).otherwise(inner["items"])))
    return df.withColumns({"_items": items, "_broken": top.isNull()}).drop("_top", "_inner")


def split_malformed(landing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a landing table into (parseable pages, quarantine).

    Quarantined rows carry ``reason``: ``not_json`` when the trimmed body does
    not start with "{" (e.g. an HTML block page), ``malformed`` when it does not
    begin with a valid JSON object, ``trailing_text`` when anything follows the
    object (text, a bracket, a second object), ``not_a_list`` when something
    other than an array stands where the platform's items should be.  Good pages
    keep the items' text in ``_items``.
    """
    items, holder = F.col("_items"), F.col("_holder")
    odd = (_given(items) & ~F.ltrim(items).startswith("[")) | ((F.col("platform") == "Lazada") & _given(holder) & ~F.ltrim(holder).startswith("{"))
    first = F.from_json("body", TOP, {"allowSingleQuotes": "false"})  # evaluated for broken bodies only
    broken = F.when(first.isNull() | first["_corrupt_record"].isNotNull(), F.lit("malformed")).otherwise(F.lit("trailing_text"))
    reason = (F.when(~F.coalesce(strip_ws(F.col("body")).startswith("{"), F.lit(False)), F.lit("not_json"))
              .when(F.col("_broken"), broken)
              .when(F.coalesce(odd, F.lit(False)), F.lit("not_a_list")))
    tagged = _settled(_with_items(landing).withColumn("reason", reason).drop("_holder", "_broken"), "_items", "reason")
    good = tagged.where(F.col("reason").isNull()).drop("reason")
    bad = tagged.where(F.col("reason").isNotNull()).drop("_items")
    return good, bad


def _crawl_date() -> Column:
    return F.date_format("fetched_at", "yyyy-MM-dd")


def _explode_items(landing: DataFrame, platform: str, item: str, empty: bool = True) -> DataFrame:
    """One row per element that is an object (and, unless ``empty``, not an empty one): ``raw`` is its JSON text, ``it`` the parsed item."""
    df = landing.where(F.col("platform") == platform)
    if "_items" not in df.columns:
        df = _with_items(df)
    keep = ["platform", "url_key", "page", "fetched_at"]
    pattern = r"^\s*\{" if empty else r"^\s*\{\s*[^\s}]"
    objects = F.filter(F.from_json("_items", "ARRAY<STRING>"), lambda x: x.rlike(pattern))
    # the outer generator asks for no test of the array below it, which would parse the array again
    rows = df.select(*keep, F.posexplode_outer(objects).alias("item_pos", "raw")).where(F.col("raw").isNotNull())
    return _settled(rows.withColumn("it", F.from_json("raw", item)), "it")


def flatten_tiki(landing: DataFrame) -> DataFrame:
    """Tiki listing pages -> one row per product.

    Items come from ``listings``, or from ``data`` when ``listings`` is missing
    or empty; elements that are NULL, empty or no object are skipped.  Badge
    texts that are non-empty are joined with ", ".
    """
    x = _explode_items(landing, "Tiki", TIKI_ITEM, empty=False)
    it = F.col("it")
    badge_texts = F.filter(F.transform(it["badges"], lambda b: b["text"]),
                           lambda t: t.isNotNull() & (t != ""))
    return x.select(
        _crawl_date().alias("crawl_date"), F.lit("Tiki").alias("platform"),
        it["id"].alias("id"), it["name"].alias("name"), it["price"].alias("price"),
        first_truthy(it["list_price"], it["original_price"]).alias("original_price"),
        it["discount_rate"].alias("discount_rate"), it["rating_average"].alias("rating_average"),
        it["review_count"].alias("review_count"),
        it["quantity_sold"]["value"].alias("quantity_sold_value"),
        it["quantity_sold"]["text"].alias("quantity_sold_text"),
        it["brand"]["name"].alias("brand"), it["current_seller"]["name"].alias("seller_name"),
        it["thumbnail_url"].alias("thumbnail_url"),
        F.concat(F.lit(TIKI_HOST), F.coalesce(it["url_path"], F.lit(""))).alias("url"),
        F.concat_ws(", ", F.coalesce(badge_texts, F.array().cast("array<string>"))).alias("badges"),
        *LINEAGE,
    )


def lazada_sold_fields(df: DataFrame, text_col: str = "sold_text", value_col: str = "sold_value",
                       mode: str = "parity") -> DataFrame:
    """Sold-count text of a Lazada listing -> (sold_value, sold_text).

    The text is trimmed, '' becomes NULL, and the count is parsed from it.
    """
    t = nullif_empty(strip_ws(F.col(text_col)))
    return df.withColumns({text_col: t, value_col: sold_text_count(t, mode=mode)})


def flatten_lazada(landing: DataFrame, sold_mode: str = "parity") -> DataFrame:
    """Lazada catalogue pages -> one row per product.

    The shown price wins over the raw price when present; sold counts are
    parsed from the display text; item links are made absolute.
    """
    x = _explode_items(landing, "Lazada", LAZADA_ITEM)
    it = F.col("it")
    rows = x.select(
        _crawl_date().alias("crawl_date"), F.lit("Lazada").alias("platform"),
        it["itemId"].alias("id"), it["name"].alias("name"),
        first_truthy(it["priceShow"], it["price"]).alias("price"),
        first_truthy(it["originalPriceShow"], it["originalPrice"]).alias("original_price"),
        it["discount"].alias("discount"), it["ratingScore"].alias("rating"),
        it["review"].alias("review_count"), it["itemSoldCntShow"].alias("sold_text"),
        it["brandName"].alias("brand"), it["location"].alias("location"),
        it["sellerName"].alias("seller_name"),
        F.when(is_truthy(it["itemUrl"]), F.concat(F.lit(LAZADA_HOST), it["itemUrl"])).alias("url"),
        it["image"].alias("image"),
        *LINEAGE,
    )
    rows = lazada_sold_fields(rows, mode=sold_mode)
    cols = ["crawl_date", "platform", "id", "name", "price", "original_price", "discount", "rating",
            "review_count", "sold_value", "sold_text", "brand", "location", "seller_name", "url", "image",
            *LINEAGE]
    return rows.select(*cols)


def flatten_shopee(landing: DataFrame) -> DataFrame:
    """Shopee search responses -> one row per item.

    Items are at ``items`` or ``data.items``; an item is ``item_basic`` when
    present, else the item itself.  Items without a (truthy) item id or shop id
    are dropped.  Prices are scaled from minor units, ratings truncated to one
    decimal, image and product links built.
    """
    x = _explode_items(landing, "Shopee", f"{SHOPEE_ITEM}, item_basic STRUCT<{SHOPEE_ITEM.replace(' STRUCT', ':STRUCT').replace(' STRING', ':STRING')}>")
    it = F.col("it")
    basic = it["item_basic"]
    has_basic = basic.isNotNull()

    def fld(name: str) -> Column:
        return F.when(has_basic, basic[name]).otherwise(it[name])

    itemid = first_truthy(fld("itemid"), fld("item_id"))
    shopid = first_truthy(fld("shopid"), fld("shop_id"))
    img = fld("image")
    rows = x.select(
        itemid.alias("itemid"), shopid.alias("shopid"),
        F.coalesce(fld("name"), F.lit(SHOPEE_MISSING_TEXT)).alias("name"),
        scaled_price(to_number(fld("price"))).alias("price"),
        to_count(fld("historical_sold")).alias("historical_sold"),
        to_count(fld("liked_count")).alias("liked_count"),
        rating_trunc(to_number(fld("item_rating")["rating_star"])).alias("rating_star"),
        F.coalesce(fld("discount"), F.lit("")).alias("discount"),
        F.coalesce(fld("shop_location"), F.lit(SHOPEE_MISSING_TEXT)).alias("location"),
        F.when(is_truthy(img), F.concat(F.lit(SHOPEE_IMAGE_PREFIX), img)).otherwise(F.lit("")).alias("image"),
        F.concat(F.lit(SHOPEE_PRODUCT_PREFIX), shopid, F.lit("/"), itemid).alias("url"),
        *LINEAGE,
    )
    return rows.where(F.col("itemid").isNotNull() & F.col("shopid").isNotNull())


def shopee_as_listing(rows: DataFrame) -> DataFrame:
    """Shopee rows under the listing column names the clean stage maps:
    historical_sold -> sold_value, rating_star -> rating, itemid -> id,
    plus platform and crawl date."""
    return rows.select(
        _crawl_date().alias("crawl_date"), F.lit("Shopee").alias("platform"),
        F.col("itemid").alias("id"), "shopid", "name", F.col("price").cast("string").alias("price"),
        F.col("historical_sold").cast("string").alias("sold_value"),
        F.col("rating_star").cast("string").alias("rating"), "discount", "location", "image", "url",
        "liked_count", *LINEAGE)


def attach_category(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Category name of each row from the (platform, url_key) dimension.

    The dimension has one row per category of a platform; Spark broadcasts it
    or not by its measured size.  Unknown keys get a NULL category.
    """
    return rows.join(dim.select("platform", "url_key", "category_name"), ["platform", "url_key"], "left")


def empty_categories(dim: DataFrame, rows: DataFrame) -> DataFrame:
    """Dimension categories that produced no rows (anti join on the key)."""
    keys = rows.select("platform", "url_key").distinct()
    return dim.join(keys, ["platform", "url_key"], "left_anti")


def cap_pages(landing: DataFrame, max_pages: int = 20) -> DataFrame:
    """Keep pages 1..max_pages (a partition filter when landing is partitioned by page)."""
    return landing.where(F.col("page").between(1, max_pages))

