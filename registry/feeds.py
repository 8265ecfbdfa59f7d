"""Product feed queries and their oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from registry.common import AS_OF, views, with_views
from storelens.config import FeedConfig
from storelens.operators.staging import stage, staging_path
from storelens.plans.feeds import base, channels, run

CFG = FeedConfig()
MASTERS = tuple(
    "feed_" + n
    for n in "sku product description sales stock stock_limit public_brand display_brand category".split()
)


def _base(spark, sf):
    return base.base_feed(views(spark, sf, *MASTERS), CFG, AS_OF)


def _channel(name):
    return lambda spark, sf: channels.CHANNELS[name](_base(spark, sf), CFG)


def validation(spark, sf):
    return base.validate_feed(_base(spark, sf))


def cardinality(spark, sf):
    return base.join_cardinality_report(base.feed_masters(views(spark, sf, *MASTERS), CFG))


def gaps(spark, sf):
    rows = stage(_base(spark, sf))
    return channels.missing_fields({n: fn(rows, CFG) for n, fn in channels.CHANNELS.items()})


def feed_run(spark, sf):
    """Rows and distinct first columns of every export of a whole run, read back."""
    paths = run.run_feeds(views(spark, sf, *MASTERS), CFG, AS_OF, staging_path(spark, "feeds"))
    parts = []
    for name, path in paths.items():
        back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
        first = back.columns[0]
        parts.append(
            back.agg(
                F.lit(name).alias("channel"),
                F.lit(path.rsplit("/", 1)[1]).alias("export"),
                F.count("*").alias("row_count"),
                F.count_distinct(first).alias("keys"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


QUERIES = {
    "N1_base_feed": _base,
    "N2_validate_feed": validation,
    "N3a_feed_google_merchant": _channel("google_merchant"),
    "N3b_feed_meta_organic": _channel("meta_organic"),
    "N3c_feed_meta_dynamic": _channel("meta_dynamic"),
    "N3d_feed_meta_collection": _channel("meta_collection"),
    "N3e_feed_criteo_catalog": _channel("criteo_catalog"),
    "N3f_feed_rtb_house": _channel("rtb_house"),
    "N3g_feed_yahoo_shopping": _channel("yahoo_shopping"),
    "N4_join_cardinality_report": cardinality,
    "N10_channel_field_matrix": gaps,
    "P3_feed_run": feed_run,
}

# ---------------------------------------------------------------- oracles


def _newest(table: str, key: str, where: str = "true") -> str:
    return f"""(select * from {table} where {where}
                qualify row_number() over (partition by {key} order by imported_at desc) = 1)"""


SKU = _newest("feed_sku", "item_code", "status = 'ACTIVE'")
ITEM = _newest("feed_product", "item_code")
SALES = _newest(
    "feed_sales", "item_id", "store_id = 'store-1' and sales_status = 'ACTIVE' and publish_flag = '1'"
)
STOCK = _newest("feed_stock", "item_id", "location_id = 'loc-1'")
LIMIT = _newest("feed_stock_limit", "item_id")
DESCRIPTION = _newest("feed_description", "item_id")
PUBLIC = _newest("feed_public_brand", "brand_id")
DISPLAY = _newest("feed_display_brand", "display_brand_id")
CATEGORY = _newest("feed_category", "category_id")

BASE = f"""
    with j as (
        select i.merchant_item_code as product_code, i.item_code as id,
               i.item_code[6:7] as year, i.item_code[8:8] as season,
               retail_price_out_tax as price_out_tax, retail_price_in_tax as price_in_tax,
               sale_price_out_tax, sale_price_in_tax, sales_end_datetime as sale_end_datetime,
               sales_start_datetime as sale_start_datetime, variation_name1 as color,
               variation_name2 as size, item_name as title, i.brand_id as brand_code,
               coalesce(display_brand_name, brand_name) as brand, brand_url_key as brand_abb,
               cast(null as varchar) as material, cast(null as varchar) as origin,
               cast(null as varchar) as gender,
               case when cast(retail_price_in_tax as double) = 0 then 0
                    else round(round((1 - cast(sale_price_in_tax as double)
                                          / cast(retail_price_in_tax as double)) * 100, 9) / 10) * 10
               end as discount_rate,
               translate(description, chr(13) || chr(10), '') as description,
               'https://shop.example.com/item/' || i.item_code as link,
               if(reserve_flag = '1', reserve_shipment_date, null) as availability_date,
               'https://img.example.com/item/' || i.item_code || '/' || variation_id1 || '.jpg'
                   as image_link,
               coalesce(if(allocate_div = 'LIMITED', sales_limit_amount, allocatable_stock), 0)
                   as stock_quantity,
               case when reserve_flag = '1' then 'pre_order' when stock_quantity >= 1 then 'in_stock'
               end as availability,
               k.item_id as ec_sku_code, google_product_category, product_type,
               strftime(try_strptime(register_date_time, '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S.%g')
                   as release_date,
               publish_start_datetime, publish_end_datetime
        from {SKU} k join {ITEM} i on k.parent_item_id = i.item_id
             left join {DESCRIPTION} d on d.item_id = i.item_id
             left join {SALES} s on s.item_id = k.item_id
             left join {STOCK} st on st.item_id = k.item_id
             left join {LIMIT} l on l.item_id = k.item_id
             left join {PUBLIC} pb on pb.brand_id = i.public_brand_id
             left join {DISPLAY} db on db.display_brand_id = i.brand_id
             left join {CATEGORY} c on c.category_id = i.category_id
        where item_name is not null and sales_start_datetime is not null
          and sales_end_datetime is not null)
    select * exclude (publish_start_datetime, publish_end_datetime),
           cast(null as varchar) as novelty_flg,
           if(row_number() over (partition by id order by stock_quantity desc, ec_sku_code) = 1, 1, 0)
               as is_max_stock_quality
    from j
    where (availability = 'in_stock'
           and '20240131090000' between sale_start_datetime and sale_end_datetime
           and '20240131090000' between publish_start_datetime and publish_end_datetime)
       or (availability = 'pre_order'
           and availability_date between left(sale_start_datetime, 8) and left(sale_end_datetime, 8))"""

TEXT = """if(coalesce(description, '') in ('', '\\N'),
             concat_ws('/', title, brand, gender, size, material),
             regexp_replace(description, '<[^>]*>', '', 'g'))"""
PRICE = "cast(cast(price_in_tax as bigint) as varchar) || ' JPY'"
SALE = "cast(cast(sale_price_in_tax as bigint) as varchar) || ' JPY'"
SALE_IF = f"if(sale_price_in_tax = price_in_tax, null, {SALE})"


def _iso(c: str) -> str:
    return f"strftime(strptime({c}, '%Y%m%d%H%M%S'), '%Y-%m-%dT%H:%M:%S') || '+09:00'"


PERIOD = f"{_iso('sale_start_datetime')} || '/' || {_iso('sale_end_datetime')}"


def _nulls(*names: str) -> str:
    return ", ".join(f"cast(null as varchar) as {n}" for n in names)


def _on_hand(word: str) -> str:
    return f"if(availability = 'pre_order', '{word}', availability)"


GOOGLE = f"""
    select ec_sku_code as id, title, {TEXT} as description,
           replace(google_product_category, '>', ' > ') as google_product_category, product_type,
           link, link as mobile_link, image_link, 'new' as condition,
           {_on_hand("preorder")} as availability,
           strftime(strptime(availability_date, '%Y%m%d'), '%Y-%m-%dT00:00:00+09:00')
               as availability_date,
           {PRICE} as price, {SALE} as sale_price, {PERIOD} as sale_price_effective_date,
           ec_sku_code as mpn, brand, id as item_group_id, color,
           'unisex' as gender, 'adult' as age_group, material, size,
           if(contains(title, 'small'), 'petite', 'regular') as size_type, 'JP' as size_system,
           'JP:::0 JPY' as shipping,
           if(greatest(cast(price_in_tax as bigint), cast(sale_price_in_tax as bigint)) >= 5000,
              'free', null) as shipping_label,
           cast(stock_quantity as varchar) as custom_label_0, season as custom_label_1,
           year as custom_label_2,
           {_nulls("additional_image_link", "gtin", "identifier_exists", "pattern",
                   "shipping_weight", "multipack", "is_bundle", "adult", "ads_redirect",
                   "custom_label_3", "custom_label_4", "excluded_destination", "expiration_date",
                   "loyalty_points", "product_detail", "product_highlight")}
    from ({BASE}) b
    where stock_quantity > 0 and google_product_category <> '' and price_in_tax <> '0'"""


def _meta(item_id: str, medium: str, suffix: str, where: str) -> str:
    return f"""
        select {item_id} as id, {_on_hand("out of stock")} as availability, 'new' as condition,
               {TEXT} as description, image_link,
               link || '?utm_source=meta&utm_medium={medium}&utm_campaign=' || brand_abb || '_{suffix}'
                   as link,
               title, {PRICE} as price, brand, ec_sku_code as mpn, 'adult' as age_group, color,
               'unisex' as gender, id as item_group_id, google_product_category, material,
               product_type, {SALE_IF} as sale_price,
               if(sale_price_in_tax = price_in_tax, null, {PERIOD}) as sale_price_effective_date,
               'JP:::0 JPY' as shipping, size, availability_date as custom_label_0,
               product_code as custom_label_1, cast(stock_quantity as varchar) as custom_label_2,
               {_nulls("gtin", "additional_image_link", "expiration_date", "pattern",
                       "shipping_weight", "custom_label_3", "custom_label_4")}
        from ({BASE}) b where {where}"""


LINKED = "stock_quantity > 0 and link is not null and image_link is not null"
CRITEO = f"""
    select ec_sku_code as id, title, {TEXT} as description, brand, product_type as category, link,
           image_link, {_on_hand("preorder")} as availability, {PRICE} as price,
           {SALE_IF} as sale_price, ec_sku_code as mpn, id as item_group_id, color, size,
           'JP' as country, 'new' as condition, cast(stock_quantity as varchar) as custom_label_0,
           {_nulls("gtin")}
    from ({BASE}) b where {LINKED}"""
RTB = f"""
    select ec_sku_code as id, title, {TEXT} as description, link, image_link, brand,
           product_type as category, color, size, {PRICE} as price,
           {_on_hand("preorder")} as availability, 'new' as condition,
           cast(stock_quantity as varchar) as stock_quantity,
           {_nulls("shipping_cost", "sale_price", "custom_label_0")}
    from ({BASE}) b where {LINKED}"""
YAHOO = f"""
    select ec_sku_code as item_id, title as item_name, {TEXT} as item_description,
           link as item_url, image_link as image_url, brand, product_type as category, color, size,
           {PRICE} as price, {_on_hand("preorder")} as availability, 'new' as condition,
           cast(stock_quantity as varchar) as stock_quantity,
           {_nulls("sale_price", "gtin", "jan_code")}
    from ({BASE}) b where {LINKED}"""
FEEDS = {
    "google_merchant": GOOGLE,
    "meta_organic": _meta(
        "ec_sku_code", "organic", "org", "cast(year as int) >= 20 and stock_quantity > 0"
    ),
    "meta_dynamic": _meta(
        "ec_sku_code",
        "cpc",
        "dyn",
        "stock_quantity > 0 and sale_start_datetime >= '20230101000000'",
    ),
    "meta_collection": _meta(
        "ec_sku_code || '_ad_' || brand_abb || '_catalog'", "cpc", "col", "cast(year as int) >= 20"
    ),
    "criteo_catalog": CRITEO,
    "rtb_house": RTB,
    "yahoo_shopping": YAHOO,
}


def _join_counts(name: str, left: str, lkey: str, right: str, rkey: str) -> str:
    return f"""
        select '{name}' as join_name, (select count(*) from {left} a) as rows_before,
               (select count(*) from {left} a left join {right} b on a.{lkey} = b.{rkey}) as rows_after,
               (select count(*) from (select {rkey} from {right} b group by 1 having count(*) > 1) r)
                   as repeated_keys,
               (select count(*) from {left} a where not exists
                   (select 1 from {right} b where b.{rkey} = a.{lkey})) as unmatched"""


COUNTS = " union all ".join(
    _join_counts(*s)
    for s in [
        ("item", SKU, "parent_item_id", ITEM, "item_id"),
        ("sales", SKU, "item_id", SALES, "item_id"),
        ("stock", SKU, "item_id", STOCK, "item_id"),
        ("stock_limit", SKU, "item_id", LIMIT, "item_id"),
        ("description", ITEM, "item_id", DESCRIPTION, "item_id"),
        ("public_brand", ITEM, "public_brand_id", PUBLIC, "brand_id"),
        ("display_brand", ITEM, "brand_id", DISPLAY, "display_brand_id"),
        ("category", ITEM, "category_id", CATEGORY, "category_id"),
    ]
)
VALIDATION = f"""
    select count(*) as row_count, count(*) filter (coalesce(id, '') = '') as missing_id,
           count(*) filter (coalesce(ec_sku_code, '') = '') as missing_sku,
           count(*) filter (price_in_tax is null) as missing_price,
           count(*) filter (coalesce(link, '') = '') as missing_link
    from ({BASE}) b"""


def _gaps(channel: str, feed: str) -> str:
    parts = [
        f"""select '{channel}' as channel, '{need}' as need, '{f}' as field, count(*) as row_count,
                   count(*) filter (coalesce(cast({f} as varchar), '') = '') as missing_rows
            from f"""
        for need, fields in channels.CHANNEL_FIELDS[channel].items()
        for f in fields.split()
    ]
    return f"select * from (with f as materialized ({feed}) {' union all '.join(parts)}) g"


ORACLES = {
    "N1_base_feed": BASE,
    "N2_validate_feed": VALIDATION,
    **{k: FEEDS[k.split("_feed_")[1]] for k in QUERIES if k.startswith("N3")},
    "N4_join_cardinality_report": COUNTS,
    "P3_feed_run": " union all ".join(
        f"""select '{c}' as channel, '{c}_20240131' as export, count(*) as row_count,
                   count(distinct {'item_id' if c == 'yahoo_shopping' else 'id'}) as keys from ({f}) f"""
        for c, f in FEEDS.items()
    ),
    "N10_channel_field_matrix": " union all ".join(_gaps(c, f) for c, f in FEEDS.items()),
}
ORACLES = {k: with_views(v) for k, v in ORACLES.items()}
