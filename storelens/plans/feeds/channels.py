"""Feeds of the advertising channels, each a projection of the base feed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from storelens.functions.text import null_text

NULL_MARK = "\\N"


def _whole(c: str) -> Column:
    return F.col(c).try_cast("double").cast("bigint")


def money(c: str, cfg) -> Column:
    return F.concat(_whole(c).cast("string"), F.lit(" " + cfg.currency_code))


def sale_money(cfg) -> Column:
    """Sale price, NULL when it equals the price."""
    same = F.coalesce(_whole("sale_price_in_tax") == _whole("price_in_tax"), F.lit(False))
    return F.when(~same, money("sale_price_in_tax", cfg))


def plain_description(also_mark: bool) -> Column:
    """Description without tags, or the main attributes joined by slashes."""
    text = F.col("description")
    missing = text.isNull() | (text == "")
    if also_mark:
        missing = missing | (text == NULL_MARK)
    made = F.concat_ws("/", "title", "brand", "gender", "size", "material")
    return F.when(missing, made).otherwise(F.regexp_replace(text, "<[^>]*>", ""))


def _iso(c: str, cfg) -> Column:
    at = F.try_to_timestamp(c, F.lit("yyyyMMddHHmmss"))
    return F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(cfg.timezone_offset))


def sale_period(cfg) -> Column:
    return F.concat(_iso("sale_start_datetime", cfg), F.lit("/"), _iso("sale_end_datetime", cfg))


def availability(pre_order: str) -> Column:
    return F.when(F.col("availability") == "pre_order", pre_order).otherwise(F.col("availability"))


def _select(base: DataFrame, columns: dict[str, Column | str | None]) -> DataFrame:
    """Projection; a text names a base column, None is an empty column."""
    out = []
    for name, value in columns.items():
        if value is None:
            out.append(null_text().alias(name))
        else:
            out.append((F.col(value) if isinstance(value, str) else value).alias(name))
    return base.select(*out)


def _in_stock(cfg) -> Column:
    return F.col("stock_quantity").cast("bigint") > cfg.minimum_stock


def feed_google_merchant(base: DataFrame, cfg) -> DataFrame:
    gender = F.col("gender")
    category = F.col("google_product_category")
    threshold = cfg.free_shipping_threshold
    free = (_whole("sale_price_in_tax") >= threshold) | (_whole("price_in_tax") >= threshold)
    day = F.col("availability_date").cast("string")
    rows = base.filter(
        _in_stock(cfg)
        & category.isNotNull()
        & ~category.isin(NULL_MARK, "")
        & (_whole("price_in_tax") != 0)
    )
    return _select(
        rows,
        {
            "id": "ec_sku_code",
            "title": "title",
            "description": plain_description(True),
            "google_product_category": F.replace(category, F.lit(">"), F.lit(" > ")),
            "product_type": "product_type",
            "link": "link",
            "mobile_link": "link",
            "image_link": "image_link",
            "additional_image_link": None,
            "condition": F.lit(cfg.condition),
            "availability": availability("preorder"),
            "availability_date": F.when(
                day != NULL_MARK,
                F.concat(
                    F.substring(day, 1, 4),
                    F.lit("-"),
                    F.substring(day, 5, 2),
                    F.lit("-"),
                    F.substring(day, 7, 2),
                    F.lit("T00:00:00" + cfg.timezone_offset),
                ),
            ),
            "price": money("price_in_tax", cfg),
            "sale_price": money("sale_price_in_tax", cfg),
            "sale_price_effective_date": sale_period(cfg),
            "gtin": None,
            "mpn": "ec_sku_code",
            "brand": "brand",
            "identifier_exists": None,
            "item_group_id": "id",
            "color": "color",
            "gender": F.when(gender.isNull() | (gender == ""), cfg.default_gender)
            .when(gender == NULL_MARK, "unisex")
            .otherwise(gender),
            "age_group": F.lit(cfg.age_group),
            "material": "material",
            "pattern": None,
            "size": "size",
            "size_type": F.when(
                F.col("title").contains(cfg.size_type_keyword), cfg.matched_size_type
            ).otherwise(cfg.default_size_type),
            "size_system": F.lit(cfg.size_system),
            "shipping": F.lit(cfg.shipping_value),
            "shipping_weight": None,
            "shipping_label": F.when(free, cfg.free_shipping_label),
            "multipack": None,
            "is_bundle": None,
            "adult": None,
            "ads_redirect": None,
            "custom_label_0": F.col("stock_quantity").cast("string"),
            "custom_label_1": "season",
            "custom_label_2": "year",
            "custom_label_3": None,
            "custom_label_4": None,
            "excluded_destination": None,
            "expiration_date": None,
            "loyalty_points": None,
            "product_detail": None,
            "product_highlight": None,
        },
    )


def _meta(rows: DataFrame, cfg, channel: str, item_id: Column) -> DataFrame:
    tags = cfg.utm[channel]
    gender = F.col("gender")
    link = F.concat(
        F.col("link"),
        F.lit(f"?utm_source={tags.source}&utm_medium={tags.medium}&utm_campaign="),
        F.col("brand_abb"),
        F.lit(f"_{tags.campaign_suffix}"),
    )
    price = sale_money(cfg)
    return _select(
        rows,
        {
            "id": item_id,
            "availability": availability("out of stock"),
            "condition": F.lit(cfg.condition),
            "description": plain_description(True),
            "image_link": "image_link",
            "link": link,
            "title": "title",
            "price": money("price_in_tax", cfg),
            "brand": "brand",
            "gtin": None,
            "mpn": "ec_sku_code",
            "additional_image_link": None,
            "age_group": F.lit("adult"),
            "color": "color",
            "expiration_date": None,
            "gender": F.when(gender.isNull() | (gender == ""), cfg.default_gender).otherwise(gender),
            "item_group_id": "id",
            "google_product_category": "google_product_category",
            "material": "material",
            "pattern": None,
            "product_type": "product_type",
            "sale_price": price,
            "sale_price_effective_date": F.when(
                ~F.coalesce(_whole("sale_price_in_tax") == _whole("price_in_tax"), F.lit(False)),
                sale_period(cfg),
            ),
            "shipping": F.lit(cfg.shipping_value),
            "shipping_weight": None,
            "size": "size",
            "custom_label_0": F.col("availability_date").cast("string"),
            "custom_label_1": "product_code",
            "custom_label_2": F.col("stock_quantity").cast("string"),
            "custom_label_3": None,
            "custom_label_4": None,
        },
    )


def feed_meta_organic(base: DataFrame, cfg) -> DataFrame:
    rows = base.filter(
        (F.col("year").try_cast("int") >= cfg.organic_min_year)
        & (F.col("stock_quantity").cast("bigint") > 0)
    )
    return _meta(rows, cfg, "meta_organic", F.col("ec_sku_code"))


def feed_meta_dynamic(base: DataFrame, cfg) -> DataFrame:
    rows = base.filter(
        _in_stock(cfg) & (F.col("sale_start_datetime") >= cfg.dynamic_start_datetime)
    )
    return _meta(rows, cfg, "meta_dynamic", F.col("ec_sku_code"))


def feed_meta_collection(base: DataFrame, cfg) -> DataFrame:
    rows = base.filter(F.col("year").try_cast("int") >= cfg.collection_min_year)
    item_id = F.concat("ec_sku_code", F.lit("_ad_"), "brand_abb", F.lit("_catalog"))
    return _meta(rows, cfg, "meta_collection", item_id)


def _linked(base: DataFrame, cfg) -> DataFrame:
    return base.filter(
        _in_stock(cfg) & F.col("link").isNotNull() & F.col("image_link").isNotNull()
    )


def feed_criteo_catalog(base: DataFrame, cfg) -> DataFrame:
    return _select(
        _linked(base, cfg),
        {
            "id": "ec_sku_code",
            "title": "title",
            "description": plain_description(False),
            "brand": "brand",
            "category": "product_type",
            "link": "link",
            "image_link": "image_link",
            "availability": availability("preorder"),
            "price": money("price_in_tax", cfg),
            "sale_price": sale_money(cfg),
            "gtin": None,
            "mpn": "ec_sku_code",
            "item_group_id": "id",
            "color": "color",
            "size": "size",
            "country": F.lit(cfg.country_code),
            "condition": F.lit(cfg.condition),
            "custom_label_0": F.col("stock_quantity").cast("string"),
        },
    )


def feed_rtb_house(base: DataFrame, cfg) -> DataFrame:
    return _select(
        _linked(base, cfg),
        {
            "id": "ec_sku_code",
            "title": "title",
            "description": plain_description(False),
            "link": "link",
            "image_link": "image_link",
            "brand": "brand",
            "category": "product_type",
            "color": "color",
            "size": "size",
            "price": money("price_in_tax", cfg),
            "availability": availability("preorder"),
            "condition": F.lit(cfg.condition),
            "stock_quantity": F.col("stock_quantity").cast("string"),
            "shipping_cost": None,
            "sale_price": None,
            "custom_label_0": None,
        },
    )


def feed_yahoo_shopping(base: DataFrame, cfg) -> DataFrame:
    return _select(
        _linked(base, cfg),
        {
            "item_id": "ec_sku_code",
            "item_name": "title",
            "item_description": plain_description(False),
            "item_url": "link",
            "image_url": "image_link",
            "brand": "brand",
            "category": "product_type",
            "color": "color",
            "size": "size",
            "price": money("price_in_tax", cfg),
            "availability": availability("preorder"),
            "condition": F.lit(cfg.condition),
            "stock_quantity": F.col("stock_quantity").cast("string"),
            "sale_price": None,
            "gtin": None,
            "jan_code": None,
        },
    )


CHANNELS: dict[str, Callable[[DataFrame, object], DataFrame]] = {
    "google_merchant": feed_google_merchant,
    "meta_organic": feed_meta_organic,
    "meta_dynamic": feed_meta_dynamic,
    "meta_collection": feed_meta_collection,
    "criteo_catalog": feed_criteo_catalog,
    "rtb_house": feed_rtb_house,
    "yahoo_shopping": feed_yahoo_shopping,
}

# Fields each channel wants from the base, by need.
_META_FIELDS = {
    "required": "id title link image_link availability price",
    "recommended": "description brand condition sale_price item_group_id product_type",
    "attribute": "color size material gender age_group",
}
CHANNEL_FIELDS = {
    "google_merchant": {
        "required": "id title description link image_link availability price",
        "recommended": "brand google_product_category product_type condition sale_price "
        "sale_price_effective_date",
        "attribute": "item_group_id color size material gender age_group size_type size_system "
        "shipping",
    },
    "meta_organic": _META_FIELDS,
    "meta_dynamic": _META_FIELDS,
    "meta_collection": _META_FIELDS,
    "criteo_catalog": {
        "required": "id title description category link image_link price availability brand",
        "recommended": "sale_price gtin mpn item_group_id color size country condition",
    },
    "rtb_house": {
        "required": "id title description link image_link price availability category",
        "recommended": "brand color size stock_quantity sale_price shipping_cost condition",
    },
    "yahoo_shopping": {
        "required": "item_id item_name item_description item_url image_url price availability",
        "recommended": "brand category color size stock_quantity sale_price gtin jan_code",
    },
}


def channel_field_matrix(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [
            (channel, need, field)
            for channel, needs in CHANNEL_FIELDS.items()
            for need, fields in needs.items()
            for field in fields.split()
        ],
        "channel string, need string, field string",
    )


def missing_fields(feeds: dict[str, DataFrame]) -> DataFrame:
    """Per channel and wanted field: rows of the feed, and rows where the field is empty.

    A field the feed has no column for is empty in all rows.
    """
    parts = []
    for channel, feed in feeds.items():
        wanted = [
            (need, field)
            for need, fields in CHANNEL_FIELDS[channel].items()
            for field in fields.split()
        ]
        counts = feed.agg(
            F.count("*").alias("_rows"),
            *[
                (
                    F.count_if(F.coalesce(F.col(f).cast("string"), F.lit("")) == "")
                    if f in feed.columns
                    else F.count("*")
                ).alias(f)
                for _, f in wanted
            ],
        )
        entries = F.array(
            *[
                F.struct(
                    F.lit(channel).alias("channel"),
                    F.lit(need).alias("need"),
                    F.lit(f).alias("field"),
                    F.col("_rows").alias("row_count"),
                    F.col(f).alias("missing_rows"),
                )
                for need, f in wanted
            ]
        )
        parts.append(counts.select(F.explode(entries).alias("e")).select("e.*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
