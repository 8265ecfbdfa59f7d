"""The base product feed from versioned master tables, its validation and reports."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from storelens.functions.text import not_blank, null_text
from storelens.functions.timewin import local_text
from storelens.operators.ranking import latest_by

BASE_COLUMNS = [
    "product_code",
    "id",
    "year",
    "season",
    "price_out_tax",
    "price_in_tax",
    "sale_price_out_tax",
    "sale_price_in_tax",
    "sale_end_datetime",
    "sale_start_datetime",
    "color",
    "size",
    "title",
    "brand_code",
    "brand",
    "brand_abb",
    "material",
    "origin",
    "gender",
    "discount_rate",
    "description",
    "link",
    "availability_date",
    "image_link",
    "availability",
    "stock_quantity",
    "ec_sku_code",
    "google_product_category",
    "product_type",
    "release_date",
    "novelty_flg",
    "is_max_stock_quality",
]


def latest_version(df: DataFrame, key: str, tie: str | None = None) -> DataFrame:
    """The row imported last per key."""
    order = [F.desc("imported_at")] + ([F.desc(tie)] if tie else [])
    return latest_by(df.filter(F.col(key).isNotNull()), [key], order).drop("imported_at")


def feed_masters(t: dict, cfg) -> dict[str, DataFrame]:
    """Latest rows of the nine master tables, after their own filters."""
    sales = t["feed_sales"].filter(
        (F.col("store_id") == cfg.store_id)
        & (F.col("sales_status") == "ACTIVE")
        & (F.col("publish_flag") == "1")
    )
    stock = t["feed_stock"].filter(F.col("location_id") == cfg.stock_location_id)
    sku = t["feed_sku"].filter(F.col("status") == "ACTIVE")
    return {
        "sku": latest_version(sku, "item_code"),
        "item": latest_version(t["feed_product"], "item_code"),
        "description": latest_version(t["feed_description"], "item_id"),
        "sales": latest_version(sales, "item_id"),
        "stock": latest_version(stock, "item_id"),
        "stock_limit": latest_version(t["feed_stock_limit"], "item_id"),
        "public_brand": latest_version(t["feed_public_brand"], "brand_id"),
        "display_brand": latest_version(t["feed_display_brand"], "display_brand_id"),
        "category": latest_version(t["feed_category"], "category_id"),
    }


def join_masters(m: dict[str, DataFrame]) -> DataFrame:
    """SKU rows with everything known about them.

    The sales row is required (its dates must be there), so that join is inner.
    """
    sku = m["sku"].select(
        F.col("item_id").alias("sku_item_id"),
        "parent_item_id",
        "retail_price_out_tax",
        "retail_price_in_tax",
        "variation_name1",
        "variation_name2",
        "variation_id1",
        "register_date_time",
        "allocate_div",
    )
    item = m["item"].filter(F.col("item_name").isNotNull()).select(
        F.col("item_id").alias("parent_item_id"),
        "item_code",
        "item_name",
        "merchant_item_code",
        "brand_id",
        "public_brand_id",
        "category_id",
    )
    sales = m["sales"].filter(
        F.col("sales_start_datetime").isNotNull() & F.col("sales_end_datetime").isNotNull()
    )

    def of_sku(df: DataFrame) -> DataFrame:
        return df.withColumnRenamed("item_id", "sku_item_id")

    return (
        sku.join(of_sku(sales), "sku_item_id")
        .join(of_sku(m["stock"]), "sku_item_id", "left")
        .join(of_sku(m["stock_limit"]), "sku_item_id", "left")
        .join(item, "parent_item_id")
        .join(
            m["description"].withColumnRenamed("item_id", "parent_item_id"),
            "parent_item_id",
            "left",
        )
        .join(m["public_brand"].withColumnRenamed("brand_id", "public_brand_id"), "public_brand_id", "left")
        .join(
            m["display_brand"].withColumnRenamed("display_brand_id", "brand_id"), "brand_id", "left"
        )
        .join(m["category"], "category_id", "left")
    )


def discount_rate() -> Column:
    """Discount in per cent, rounded to tens; 0 for a price of zero."""
    price = F.col("retail_price_in_tax").try_cast("double")
    sale = F.col("sale_price_in_tax").try_cast("double")
    # cut the noise of the division first, so that 45 % is 45 and rounds up
    rate = F.round((F.lit(1.0) - F.try_divide(sale, price)) * 100, 9)
    return F.when(price == 0, F.lit(0.0)).otherwise(F.round(rate, -1))


def base_feed(t: dict, cfg, as_of: datetime) -> DataFrame:
    """Visible products with price, availability, links and labels."""
    now = F.lit(local_text(as_of, "%Y%m%d%H%M%S", cfg.tz))
    rows = join_masters(feed_masters(t, cfg))
    stock = F.coalesce(
        F.when(F.col("allocate_div") == "LIMITED", F.col("sales_limit_amount"))
        .otherwise(F.col("allocatable_stock"))
        .try_cast("bigint"),
        F.lit(0),
    )
    reserved = F.coalesce(F.col("reserve_flag") == "1", F.lit(False))
    released = F.try_to_timestamp("register_date_time", F.lit("yyyyMMddHHmmss"))
    rows = rows.select(
        F.col("merchant_item_code").alias("product_code"),
        F.col("item_code").alias("id"),
        F.substring("item_code", 6, 2).alias("year"),
        F.substring("item_code", 8, 1).alias("season"),
        F.col("retail_price_out_tax").alias("price_out_tax"),
        F.col("retail_price_in_tax").alias("price_in_tax"),
        "sale_price_out_tax",
        "sale_price_in_tax",
        F.col("sales_end_datetime").alias("sale_end_datetime"),
        F.col("sales_start_datetime").alias("sale_start_datetime"),
        F.col("variation_name1").alias("color"),
        F.col("variation_name2").alias("size"),
        F.col("item_name").alias("title"),
        F.col("brand_id").alias("brand_code"),
        F.coalesce("display_brand_name", "brand_name").alias("brand"),
        F.col("brand_url_key").alias("brand_abb"),
        null_text().alias("material"),
        null_text().alias("origin"),
        null_text().alias("gender"),
        discount_rate().alias("discount_rate"),
        F.regexp_replace("description", r"[\r\n]", "").alias("description"),
        F.concat(F.lit(f"{cfg.product_url_prefix}/item/"), "item_code").alias("link"),
        F.when(reserved, F.col("reserve_shipment_date")).alias("availability_date"),
        F.concat(
            F.lit(f"{cfg.image_url_prefix}/item/"),
            "item_code",
            F.lit("/"),
            "variation_id1",
            F.lit(".jpg"),
        ).alias("image_link"),
        F.when(reserved, "pre_order")
        .when(stock >= cfg.normal_minimum_stock, "in_stock")
        .alias("availability"),
        stock.alias("stock_quantity"),
        F.col("sku_item_id").alias("ec_sku_code"),
        "google_product_category",
        "product_type",
        F.date_format(released, "yyyy-MM-dd HH:mm:ss.SSS").alias("release_date"),
        null_text().alias("novelty_flg"),
        "publish_start_datetime",
        "publish_end_datetime",
    )
    on_sale = now.between(F.col("sale_start_datetime"), F.col("sale_end_datetime"))
    published = now.between(F.col("publish_start_datetime"), F.col("publish_end_datetime"))
    ships_in_time = F.col("availability_date").between(
        F.substring("sale_start_datetime", 1, 8), F.substring("sale_end_datetime", 1, 8)
    )
    visible = rows.filter(
        ((F.col("availability") == "in_stock") & on_sale & published)
        | ((F.col("availability") == "pre_order") & ships_in_time)
    )
    return mark_best_stocked(visible).select(*BASE_COLUMNS)


def mark_best_stocked(rows: DataFrame) -> DataFrame:
    """``is_max_stock_quality`` is 1 on one SKU per product: most stock, smallest code.

    The best SKU comes from an aggregate, not from sorting a product's SKUs.
    """
    best = rows.groupBy("id").agg(
        F.min(F.struct(-F.col("stock_quantity"), F.col("ec_sku_code"))).alias("_best")
    )
    joined = rows.join(best.select("id", F.col("_best.ec_sku_code").alias("_best_sku")), "id", "left")
    is_best = F.coalesce(F.col("ec_sku_code") == F.col("_best_sku"), F.lit(False))
    return joined.withColumn("is_max_stock_quality", is_best.cast("int")).drop("_best_sku")


class FeedValidationError(ValueError):
    """A feed must not be exported."""


def validate_feed(base: DataFrame) -> DataFrame:
    """Row count and missing keys, in one pass."""
    return base.agg(
        F.count("*").alias("row_count"),
        F.count_if(~not_blank("id")).alias("missing_id"),
        F.count_if(~not_blank("ec_sku_code")).alias("missing_sku"),
        F.count_if(F.col("price_in_tax").isNull()).alias("missing_price"),
        F.count_if(~not_blank("link")).alias("missing_link"),
    )


def require_valid(
    report: DataFrame, gates: tuple[str, ...] = ("row_count", "missing_id", "missing_sku")
) -> None:
    """Raises unless there are rows and the gated columns have no gaps."""
    row = report.first().asDict()
    if "row_count" in gates and row["row_count"] == 0:
        raise FeedValidationError("the feed has no rows")
    gaps = {g: row[g] for g in gates if g != "row_count" and row[g] > 0}
    if gaps:
        raise FeedValidationError(f"the feed has gaps: {gaps}")


def require_rows(feed: DataFrame, name: str) -> None:
    if feed.isEmpty():
        raise FeedValidationError(f"the {name} feed has no rows")


def join_cardinality_report(m: dict[str, DataFrame]) -> DataFrame:
    """Per join of the base feed: rows before and after, repeated keys, rows without match."""
    sku, item = m["sku"], m["item"]
    steps = [
        ("item", sku, "parent_item_id", item, "item_id"),
        ("sales", sku, "item_id", m["sales"], "item_id"),
        ("stock", sku, "item_id", m["stock"], "item_id"),
        ("stock_limit", sku, "item_id", m["stock_limit"], "item_id"),
        ("description", item, "item_id", m["description"], "item_id"),
        ("public_brand", item, "public_brand_id", m["public_brand"], "brand_id"),
        ("display_brand", item, "brand_id", m["display_brand"], "display_brand_id"),
        ("category", item, "category_id", m["category"], "category_id"),
    ]
    parts = []
    for name, left, lkey, right, rkey in steps:
        # counts per key on both sides give the joined size without joining rows
        lefts = left.groupBy(F.col(lkey).alias("k")).agg(F.count("*").alias("l"))
        rights = right.groupBy(F.col(rkey).alias("k")).agg(F.count("*").alias("r"))
        both = lefts.join(rights, "k", "full")
        parts.append(
            both.agg(
                F.lit(name).alias("join_name"),
                F.coalesce(F.sum("l"), F.lit(0)).alias("rows_before"),
                F.coalesce(F.sum(F.col("l") * F.coalesce("r", F.lit(1))), F.lit(0)).alias("rows_after"),
                F.count_if(F.col("r") > 1).alias("repeated_keys"),
                F.coalesce(F.sum(F.when(F.col("r").isNull(), F.col("l"))), F.lit(0)).alias("unmatched"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
